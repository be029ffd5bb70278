"""Readings kept by quarter: only what changed files touch is made again, and the result is that of a whole build."""

import datetime as dt
import os

import pyarrow.parquet as pq
import pytest

from tests.conftest import SF_SMALL
from vireo.plans import staging
from vireo.plans.refresh import ReadingMart
from vireo.plans.star import MARTS_DIR, Star
from vireo.sources.tables import Sources


@pytest.fixture()
def source(tmp_path):
    """Lines by ship year, one name with a blank, and orders in two files."""
    lines, orders = pq.read_table(f"{SF_SMALL}/lineitem.parquet"), pq.read_table(f"{SF_SMALL}/orders.parquet")
    years = [d.year for d in lines["l_shipdate"].to_pylist()]
    os.makedirs(tmp_path / "in/lineitem.parquet")
    os.makedirs(tmp_path / "in/orders.parquet")
    for year in sorted(set(years)):
        pq.write_table(lines.filter([y == year for y in years]), tmp_path / f"in/lineitem.parquet/year {year}.parquet")
    half = len(orders) // 2
    pq.write_table(orders.slice(0, half), tmp_path / "in/orders.parquet/a.parquet")
    pq.write_table(orders.slice(half), tmp_path / "in/orders.parquet/b.parquet")
    return tmp_path / "in"


@pytest.fixture()
def kept(spark, source, tmp_path):
    return ReadingMart(spark, str(source), str(tmp_path / "mart"))


def rows(frame):
    return sorted(map(repr, frame.collect()))


def whole(spark, source):
    """All readings, by one plan over the whole input."""
    src = Sources(spark, {t: (lambda t=t: spark.read.parquet(str(source / f"{t}.parquet"))) for t in ("lineitem", "orders")})
    return rows(staging.stg_readings(src))


def quarters(mart):
    return mart.commits.latest()[1]["quarters"]


def test_nothing_changed_nothing_written(spark, source, kept):
    assert kept.readings() is None
    assert len(kept.refresh()) == len(quarters(kept)) > 20
    assert rows(kept.readings()) == whole(spark, source)
    assert kept.refresh() == [] and kept.commits.numbers() == [0]


def test_an_added_file_touches_its_quarters_only(spark, source, kept):
    kept.refresh()
    before = quarters(kept)
    lines = pq.read_table(source / "lineitem.parquet/year 1995.parquet")
    late = lines.slice(0, 1).to_pylist()[0] | {"l_linenumber": 99, "l_shipdate": dt.datetime(1999, 11, 5)}
    pq.write_table(type(lines).from_pylist([late], lines.schema), source / "lineitem.parquet/late.parquet")
    touched = kept.refresh()
    assert touched == [1999 * 4 + 4]
    assert rows(kept.readings()) == whole(spark, source)
    after = quarters(kept)
    assert {q: p for q, p in after.items() if int(q) not in touched} == {q: p for q, p in before.items() if int(q) not in touched}
    assert all(after[str(q)] != before.get(str(q)) for q in touched)
    assert len(rows(kept.readings(as_of=0))) == len(rows(kept.readings())) - 1
    assert kept.vacuum() == 0  # the first part still holds the other quarters


def test_a_copy_steps_in_for_a_line_whose_file_went(spark, source, kept):
    lines = pq.read_table(source / "lineitem.parquet/year 1996.parquet")
    first = lines.slice(0, 1).to_pylist()[0]
    early, later = ({**first, "l_linenumber": 77, "l_shipdate": dt.datetime(y, 2, 3)} for y in (1990, 2010))
    pq.write_table(type(lines).from_pylist([early], lines.schema), source / "lineitem.parquet/early copy.parquet")
    pq.write_table(type(lines).from_pylist([later], lines.schema), source / "lineitem.parquet/later copy.parquet")
    kept.refresh()
    assert str(1990 * 4 + 1) in quarters(kept) and str(2010 * 4 + 1) not in quarters(kept)
    os.remove(source / "lineitem.parquet/early copy.parquet")
    assert {1990 * 4 + 1, 2010 * 4 + 1} <= set(kept.refresh())
    assert str(1990 * 4 + 1) not in quarters(kept) and str(2010 * 4 + 1) in quarters(kept)
    assert rows(kept.readings()) == whole(spark, source)


def test_orders_that_change_and_go(spark, source, kept):
    kept.refresh()
    b = source / "orders.parquet/b.parquet"
    orders = pq.read_table(b)
    moved = orders.slice(0, 1).to_pylist()[0] | {"o_custkey": 424_242}
    pq.write_table(type(orders).from_pylist([moved] + orders.slice(1, 40).to_pylist(), orders.schema), b)
    kept.refresh()
    assert rows(kept.readings()) == whole(spark, source)
    os.remove(b)
    os.remove(source / "orders.parquet/a.parquet")
    assert kept.refresh() and kept.readings() is None
    assert kept.refresh() == []


def test_the_second_of_two_refreshes_starts_over(spark, source, kept, monkeypatch):
    kept.refresh()
    other, add, raced = ReadingMart(spark, str(source), kept.root), kept.commits.add, []

    def late(number, content):
        if not raced:
            raced.append(number)
            other.refresh()
        return add(number, content)
    monkeypatch.setattr(kept.commits, "add", late)
    os.remove(source / "lineitem.parquet/year 1997.parquet")
    assert kept.refresh() == [] and raced == [1] and kept.commits.numbers() == [0, 1]
    assert rows(kept.readings()) == whole(spark, source)


def test_a_star_over_refreshed_readings(spark, source, tmp_path):
    for t in ("region", "nation", "customer", "supplier", "part", "events"):
        os.symlink(f"{SF_SMALL}/{t}.parquet", source / f"{t}.parquet")
    spark.conf.set(MARTS_DIR, str(tmp_path / "marts"))
    try:
        got = Star.refreshed(spark, str(source)).fct_readings
        assert rows(got) == rows(Star.from_dir(spark, str(source)).fct_readings)
    finally:
        spark.conf.unset(MARTS_DIR)


def test_without_lines(spark, tmp_path):
    assert ReadingMart(spark, str(tmp_path / "none"), str(tmp_path / "mart")).readings() is None
