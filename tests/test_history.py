"""Type-2 history: every trap of the closed form, and one-pass == snapshot loop."""

import datetime as dt
import random

import pytest

from vireo.operators.history import (cutoff_dates, dress_scd2, history_summary, scd2_apply,
                                     scd2_history, state_as_of)
from vireo.operators.keys import row_number_key

FIELDS = ["line", "crit", "state"]
KW = dict(key="k", base_date="installed", date="d", field="field", value="value", fields=FIELDS)
BASE_SCHEMA = "k string, line string, crit string, state string, installed date"
LOG_SCHEMA = "k string, d date, field string, value string"


def D(s):
    return dt.date.fromisoformat(s)


def base(spark, rows):
    return spark.createDataFrame(rows, BASE_SCHEMA)


def log(spark, rows):
    return spark.createDataFrame(rows, LOG_SCHEMA)


def versions(df):
    return sorted((r.k, str(r.valid_from)[:10], None if r.valid_to is None else str(r.valid_to)[:10],
                   r.line, r.crit, r.state) for r in df.collect())


@pytest.fixture
def fleet(spark):
    b = base(spark, [("M1", "L1", "high", "op", D("2024-01-01")),
                     ("M2", "L2", "low", "op", D("2024-01-01")),
                     ("M3", "L3", "mid", "op", D("2024-06-01")),
                     ("M4", "L4", "mid", "op", D("2024-01-01"))])
    l = log(spark, [
        ("M1", D("2024-03-04"), "line", "L9"),          # on the first change date of the fleet
        ("M2", D("2024-05-01"), "crit", "high"),         # two fields on one day
        ("M2", D("2024-05-01"), "state", "refurb"),
        ("M2", D("2024-07-01"), "crit", "high"),         # change to the value already held
        ("M3", D("2024-04-01"), "line", "L7"),           # before installation
        ("M3", D("2024-08-01"), "crit", "low"),          # after installation
        ("M4", D("2024-09-09"), "line", "LA"),           # tie on (key, field, date)
        ("M4", D("2024-09-09"), "line", "LB"),
    ])
    return b, l


def test_closed_form_traps(spark, fleet):
    b, l = fleet
    got = versions(scd2_history(b, l, **KW))
    assert got == [
        ("M1", "2024-01-01", "2024-03-04", "L1", "high", "op"),
        ("M1", "2024-03-04", None, "L9", "high", "op"),
        ("M2", "2024-01-01", "2024-05-01", "L2", "low", "op"),
        ("M2", "2024-05-01", "2024-07-01", "L2", "high", "refurb"),
        ("M2", "2024-07-01", None, "L2", "high", "refurb"),
        ("M3", "2024-06-01", "2024-08-01", "L3", "mid", "op"),
        ("M3", "2024-08-01", None, "L7", "low", "op"),
        ("M4", "2024-01-01", "2024-09-09", "L4", "mid", "op"),
        ("M4", "2024-09-09", None, "LB", "mid", "op"),
    ]


def test_state_as_of_cutoff(spark, fleet):
    b, l = fleet
    st = {r.k: r for r in state_as_of(b, l, "2024-05-01", **KW).collect()}
    assert (st["M2"].crit, st["M2"].state, str(st["M2"].updated_at)[:10]) == ("high", "refurb", "2024-05-01")
    assert (st["M3"].line, str(st["M3"].updated_at)[:10]) == ("L7", "2024-04-01")
    assert (st["M4"].line, str(st["M4"].updated_at)[:10]) == ("L4", "2024-01-01")


def test_cutoff_dates_include_baseline(spark, fleet):
    _, l = fleet
    got = [str(r.cutoff) for r in cutoff_dates(l, "d").collect()]
    assert got[0] == "2024-03-03"
    assert got == sorted(set(got)) and len(got) == 1 + 6


def _loop(spark, b, l):
    target = None
    for r in cutoff_dates(l, "d").collect():
        st = state_as_of(b, l, r.cutoff, **KW)
        target = scd2_apply(target, st, key="k")
        target = spark.createDataFrame(target.collect(), target.schema)  # cut lineage in the test loop
    return target


def test_one_pass_equals_snapshot_loop(spark, fleet):
    b, l = fleet
    assert versions(scd2_history(b, l, **KW)) == versions(_loop(spark, b, l))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_one_pass_equals_loop_random(spark, seed):
    rnd = random.Random(seed)
    keys = [f"K{i}" for i in range(6)]
    brow = [(k, f"L{rnd.randint(0, 3)}", rnd.choice(["a", "b"]), "op", D("2024-01-10") + dt.timedelta(days=rnd.randint(0, 20)))
            for k in keys]
    lrow = [(rnd.choice(keys), D("2024-01-01") + dt.timedelta(days=rnd.randint(0, 40)), rnd.choice(FIELDS),
             rnd.choice(["x", "y", "z"])) for _ in range(25)]
    b, l = base(spark, brow), log(spark, lrow)
    assert versions(scd2_history(b, l, **KW)) == versions(_loop(spark, b, l))


def test_dress_and_summary(spark, fleet):
    b, l = fleet
    h = scd2_history(b, l, **KW)
    d = dress_scd2(h, key="k", sk="sk", sk_fn=row_number_key).orderBy("sk").collect()
    assert [r.version for r in d if r.k == "M2"] == [1, 2, 3]
    first = [r for r in d if r.version == 1]
    assert all(str(r.valid_from).startswith("0001-01-01") for r in first)
    cur = [r for r in d if r.is_current]
    assert len(cur) == 4 and all(str(r.valid_to).startswith("9999-12-31") for r in cur)
    s = history_summary(h, "k").collect()[0]
    assert (s.versions, s.keys, s.current_versions, s.keys_with_past) == (9, 4, 4, 4)


def test_apply_ignores_older_state(spark, fleet):
    b, l = fleet
    t1 = scd2_apply(None, state_as_of(b, l, "2024-12-31", **KW), key="k")
    t2 = scd2_apply(t1, state_as_of(b, l, "2024-05-01", **KW), key="k")
    assert versions(t1) == versions(t2)


def test_rebuild_is_reproducible(spark, fleet):
    """H5: the history is rebuilt from scratch on every run, so two runs agree."""
    b, l = fleet
    first = versions(scd2_history(b, l, **KW))
    second = versions(scd2_history(b.orderBy("k", ascending=False), l.orderBy("d", ascending=False), **KW))
    assert first == second
