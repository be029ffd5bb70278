"""Dedup, keys, unknown members, valid-at join, unpivot, quality thresholds."""

import datetime as dt

from pyspark.sql import functions as F

from vireo.operators.dedup import duplicate_count, keep_first, keep_first_agg
from vireo.operators.joins import lookup, valid_at_join
from vireo.operators.keys import dense_key, row_number_key, with_unknown_member
from vireo.operators.quality import Rule, evaluate, singular
from vireo.operators.unpivot import dominant_code, unpivot_flags

T = dt.datetime


def test_keep_first_earliest_load_then_code_then_instant(spark):
    rows = [(1, T(2024, 1, 2), "M2", T(2024, 3, 1)), (1, T(2024, 1, 1), "M9", T(2024, 3, 1)),
            (2, T(2024, 1, 1), "M1", T(2024, 3, 1)), (2, T(2024, 1, 1), "M1", T(2024, 3, 1)),
            (3, T(2024, 1, 1), "M1", T(2024, 3, 2)), (3, T(2024, 1, 1), "M1", T(2024, 3, 1))]
    df = spark.createDataFrame(rows, "udi int, loaded timestamp, code string, at timestamp")
    got = sorted(tuple(r) for r in keep_first(df, ["udi"], ["loaded", "code", "at"]).collect())
    assert [(r[0], r[2], r[3].day) for r in got] == [(1, "M9", 1), (2, "M1", 1), (3, "M1", 1)]
    agg = sorted(tuple(r) for r in keep_first_agg(df, ["udi"], ["loaded", "code", "at"]).collect())
    assert got == agg
    dc = duplicate_count(df, ["udi"]).collect()[0]
    assert (dc.excess_rows, dc.duplicated_keys) == (3, 3)


def test_dense_key_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 37).alias("a"), (F.col("id") * 7 % 1009).alias("b")).distinct()
    a = {(r.a, r.b): r.sk for r in dense_key(df.repartition(5), ["a", "b"], "sk").collect()}
    b = {(r.a, r.b): r.sk for r in row_number_key(df, ["a", "b"], "sk").collect()}
    assert a == b and sorted(a.values()) == list(range(1, len(a) + 1))


def test_unknown_member_typed(spark):
    dim = spark.createDataFrame([(1, "L1", 62.5)], "sk bigint, code string, rate double")
    out = with_unknown_member(dim, "sk", {"code": "UNKNOWN"}).orderBy("sk").collect()
    assert tuple(out[0]) == (-1, "UNKNOWN", None) and out[1].sk == 1


def test_valid_at_join_boundaries(spark):
    dim = spark.createDataFrame(
        [(1, "M1", T(1, 1, 1), T(2024, 5, 5)), (2, "M1", T(2024, 5, 5), T(9999, 12, 31))],
        "sk bigint, code string, vf timestamp_ntz, vt timestamp_ntz")
    ev = spark.createDataFrame([("e1", "M1", T(2024, 5, 5)), ("e2", "M1", T(2020, 1, 1)), ("e3", "M9", T(2024, 6, 1))],
                               "id string, code string, ts timestamp_ntz")
    j = valid_at_join(ev, dim.withColumnRenamed("code", "dcode"), "code", "dcode", "ts", "vf", "vt").drop("vf", "vt")
    got = {r.id: r.sk for r in j.collect()}
    assert got == {"e1": 2, "e2": 1, "e3": None}
    lk = lookup(ev, dim.filter("sk = 2").drop("vf", "vt"), "code", "code", "sk").collect()
    assert sorted((r.id, r.sk) for r in lk) == [("e1", 2), ("e2", 2), ("e3", -1)]


def test_unpivot_and_dominant(spark):
    flags = [("TWF", "twf"), ("OSF", "osf"), ("HDF", "hdf")]
    df = spark.createDataFrame([(1, False, False, False), (2, True, False, False), (3, False, True, True),
                                (4, True, True, True)], "u int, twf boolean, osf boolean, hdf boolean")
    long = unpivot_flags(df, flags, "mode", none_code="INDET").groupBy("u").agg(F.count("*").alias("n")).collect()
    assert {r.u: r.n for r in long} == {1: 1, 2: 1, 3: 2, 4: 3}
    dom = {r.u: r.m for r in df.select("u", dominant_code(flags, "INDET").alias("m")).collect()}
    assert dom == {1: "INDET", 2: "TWF", 3: "OSF", 4: "TWF"}


def test_quality_thresholds(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (2, "b", -1.0), (2, None, 3.0), (None, "z", 11.0)],
                               "id int, cat string, v double")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    rules = [Rule("u", "t", "unique", column="id"),
             Rule("nn", "t", "not_null", column="id"),
             Rule("av", "t", "accepted_values", column="cat", values=("a", "b")),
             Rule("rg", "t", "accepted_range", column="v", min_value=0, max_value=10),
             Rule("ex", "t", "expression_is_true", expr="v >= 0", severity="error", warn_after=0, error_after=1),
             Rule("ex2", "t", "expression_is_true", expr="v >= 0", severity="error", warn_after=0, error_after=0),
             Rule("rel", "t", "relationships", column="id", to_table="p", to_column="id"),
             Rule("rel_null", "t", "relationships", column="id", to_table="p", to_column="id",
                  nulls_are_violations=True),
             Rule("w", "t", "not_null", column="cat", severity="warn")]
    rep = {r.test: (r.violations, r.status) for r in evaluate(spark, {"t": df, "p": parent}, rules).collect()}
    assert rep == {"u": (1, "error"), "nn": (1, "error"), "av": (1, "error"), "rg": (2, "error"),
                   "ex": (1, "warn"), "ex2": (1, "error"), "rel": (0, "pass"), "rel_null": (1, "error"),
                   "w": (1, "warn")}
    s = singular("s", "t", df.filter("v < 0"), severity="error", warn_after=1, error_after=1).collect()[0]
    assert (s.violations, s.status) == (1, "pass")
