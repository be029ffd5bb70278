"""Physical-plan shape: the scale properties the operators promise."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vireo.operators.dedup import keep_first
from vireo.operators.joins import valid_at_join
from vireo.plans.star import Star


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_before_shuffle(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    p = plan(keep_first(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_valid_at_join_is_equi_keyed_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "k bigint, ts timestamp_ntz")
        dim = spark.createDataFrame([(1, 7, dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31))],
                                    "dk bigint, sk bigint, vf timestamp_ntz, vt timestamp_ntz")
        p = plan(valid_at_join(ev, dim, "k", "dk", "ts", "vf", "vt"))
        assert "SortMergeJoin" in p and "NestedLoop" not in p and "Cartesian" not in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_history_window_runs_after_combine_and_no_single_partition(spark):
    s = Star.from_dir(spark, SF_SMALL)
    p = s.history._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in p
    assert "partial_max" in p  # the (key, date) pivot combines map-side before the per-key window


def test_history_is_linear_in_the_versions_of_a_key(spark):
    p = plan(Star.from_dir(spark, SF_SMALL).history)
    assert "lead(" in p and "specifiedwindowframe(RangeFrame" not in p.lower() and "unboundedfollowing" not in p.replace(" ", "").lower()


def test_dim_asset_shuffles_its_history_once(spark, tmp_path):
    from vireo.operators.history import dress_scd2
    Star.from_dir(spark, SF_SMALL).history.write.parquet(str(tmp_path / "h"))
    history = spark.read.parquet(str(tmp_path / "h"))
    seen = []
    dress_scd2(history, key="asset_code", sk="sk", sk_fn=lambda df, order, name: seen.append(plan(df)) or df.withColumn(name, F.lit(1)))
    assert seen[0].count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in seen[0]


def test_valid_at_join_tests_an_event_against_one_quarter(spark):
    days = 3000
    dim = spark.range(days).select(F.lit(1).alias("dk"), F.col("id").alias("v"),
                                   (F.lit(dt.datetime(2016, 1, 1)).cast("timestamp_ntz") + F.make_interval(days=F.col("id").cast("int"))).alias("vf"),
                                   (F.lit(dt.datetime(2016, 1, 1)).cast("timestamp_ntz") + F.make_interval(days=(F.col("id") + 1).cast("int"))).alias("vt"))
    ev = spark.range(days * 10).select(F.lit(1).alias("k"), (F.lit(dt.datetime(2016, 1, 1)).cast("timestamp_ntz")
                                                             + F.make_interval(hours=(F.col("id") * 24 / 10).cast("int"))).alias("ts"))
    joined = valid_at_join(ev, dim, "k", "dk", "ts", "vf", "vt")
    assert "_at_quarter" in plan(joined) and joined.count() == days * 10
    assert joined.where(F.datediff("ts", F.lit("2016-01-01").cast("date")) != F.col("v")).count() == 0


def test_stitching_reads_the_fact_once(spark):
    from vireo.plans import reports
    s = Star.from_dir(spark, SF_SMALL)
    s.__dict__["fct_work_orders"] = s.fct_work_orders
    scans = plan(reports.quarter_pairs(s, "asset_code", "asset_sk")).count("orders.parquet")
    assert scans == plan(reports.quarter_pairs(s)).count("orders.parquet")


def test_audits_reduce_facts_before_joining(spark):
    from vireo.operators.quality import Rule, evaluate
    child, parent = spark.range(1000).select((F.col("id") % 3).alias("c")), spark.range(2).select(F.col("id").alias("p"))
    report = evaluate(spark, {"c": child, "p": parent}, [Rule("r", "c", "relationships", column="c", to_table="p", to_column="p")])
    assert report.first().violations == 333
    p = plan(report)
    join = next(j for j in ("LeftOuter", "LeftAnti") if j in p)
    assert join == "LeftOuter" and p.index(join) < p.index("partial_count(1)")


def test_scan_pushdown_and_pruning(spark):
    s = Star.from_dir(spark, SF_SMALL)
    p = s.changes._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(o_orderpriority" in p
    assert "o_totalprice" not in p and "o_orderstatus" not in p


def test_hot_machine_is_split_by_aqe(spark):
    """One machine holds a third of all events: the valid-at join stays exact
    and AQE splits the hot machine's partition (no broadcast, tiny skew
    thresholds so the local data counts as skewed)."""
    from pyspark.sql import functions as F
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        ev = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("k"),
            (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_interval(
                days=(F.col("id") % 300).cast("int"))).alias("ts"), F.col("id"))
        dim = spark.range(998).select(F.col("id").alias("dk"),
                                      F.lit(dt.datetime(1, 1, 1)).cast("timestamp_ntz").alias("vf"),
                                      F.lit(dt.datetime(2024, 6, 1)).cast("timestamp_ntz").alias("vt"),
                                      F.lit(1).alias("version")).unionByName(
            spark.range(998).select(F.col("id").alias("dk"),
                                    F.lit(dt.datetime(2024, 6, 1)).cast("timestamp_ntz").alias("vf"),
                                    F.lit(dt.datetime(9999, 12, 31)).cast("timestamp_ntz").alias("vt"),
                                    F.lit(2).alias("version")))
        j = valid_at_join(ev, dim, "k", "dk", "ts", "vf", "vt")
        rows = j.collect()
        assert len(rows) == n and all(r.version == (2 if r.ts >= dt.datetime(2024, 6, 1) else 1) for r in rows)
        final = j._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final, final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
