"""Mutation checks (Q22): breaking a step on purpose must make its test fail."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vireo import constants as C
from vireo.operators.quality import Rule, evaluate
from vireo.operators.unpivot import unpivot_flags
from vireo.plans import checks
from vireo.plans.catalog import _state
from vireo.plans.staging import MODE_FLAGS
from vireo.plans.star import Star


def _violations(df, test):
    return {r.test: r.violations for r in df.collect()}[test]


def test_dedup_off_breaks_uniqueness(spark):
    good = Star.from_dir(spark, SF_SMALL)
    assert _violations(checks.quality_report(good), "unique_reading") == 0
    bad = Star.from_dir(spark, SF_SMALL)
    bad.__dict__["lines"] = bad.src["lineitem"]
    assert _violations(checks.quality_report(bad), "unique_reading") > 0


def test_inner_join_failures_break_agreement(spark):
    s = Star.from_dir(spark, SF_SMALL)
    assert _violations(checks.facts_agree(s), "failing_reading_without_mode_row") == 0
    failing = s.fct_readings.filter("has_failure")
    long = unpivot_flags(failing, MODE_FLAGS, "mode_code")           # no INDETERMINATE branch
    s.__dict__["fct_failures"] = long.join(s.dim_mode.select("failure_mode_sk", "mode_code"), "mode_code") \
        .select("asset_sk", "location_sk", "date_sk", "shift_sk", "failure_mode_sk", "reading_order",
                "reading_line", "read_at")
    assert _violations(checks.facts_agree(s), "failing_reading_without_mode_row") > 0


def test_open_ended_versions_overlap(spark):
    s = Star.from_dir(spark, SF_SMALL)
    assert _violations(checks.overlap_check(s), "no_overlapping_versions") == 0
    s.__dict__["dim_asset"] = s.dim_asset.withColumn(
        "valid_to", F.lit(C.END_OF_TIME).cast("timestamp_ntz"))
    assert _violations(checks.overlap_check(s), "no_overlapping_versions") > 0


def test_skipping_the_history_loses_versions(spark):
    s = Star.from_dir(spark, SF_SMALL)
    normal = checks.history_complete(s).collect()[0]
    final = _state(s, C.DEFAULT_CUTOFF).withColumn("valid_from", F.col("updated_at")) \
        .withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
    s.__dict__["history"] = final
    broken = checks.history_complete(s).collect()[0]
    assert broken.versions < normal.versions and broken.violations > normal.violations


def test_known_baseline_warns_growth_errors(spark):
    df = spark.createDataFrame([(1,), (-1,), (-2,)], "v int")
    rule = lambda n: Rule("neg", "t", "expression_is_true", expr="v >= 0", warn_after=0, error_after=n)
    assert evaluate(spark, {"t": df}, [rule(2)]).collect()[0].status == "warn"
    assert evaluate(spark, {"t": df}, [rule(1)]).collect()[0].status == "error"


def test_growth_of_audited_dirt_is_an_error(spark, monkeypatch):
    s = Star.from_dir(spark, SF_SMALL)
    known = {r.test: r for r in checks.quality_report(s).collect()}
    dirty = ("conclusion_not_before_opening", "charge_not_above_price")
    assert all(known[t].violations > 0 and known[t].status == "warn" for t in dirty)
    version = checks.content_version(s.src["orders"])
    monkeypatch.setitem(C.AUDITED, version, {t: known[t].violations - 1 for t in dirty})
    worse = {r.test: r.status for r in checks.quality_report(s).collect()}
    assert all(worse[t] == "error" for t in dirty)


def test_a_data_set_without_an_audit_allows_no_dirt():
    assert checks.audited("conclusion_not_before_opening", "1-2") == 0


def test_one_more_order_is_another_data_set(spark):
    """Limits belong to the audited orders: a copy of them with one row more, or one price changed, allows no dirt."""
    s = Star.from_dir(spark, SF_SMALL)
    orders = s.src["orders"]
    assert checks.content_version(orders) in C.AUDITED
    first = orders.orderBy("o_orderkey").limit(1)
    for other in (orders.unionByName(first), orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") == first.first().o_orderkey, 1.0).otherwise(F.col("o_totalprice"))),
                  orders.limit(0)):
        assert checks.content_version(other) not in C.AUDITED


def test_registered_mutations_are_noticed(spark):
    rows = checks.mutation_checks(Star.shared(spark, SF_SMALL)).collect()
    assert len(rows) == 6 and all(r.noticed for r in rows)


def test_origin_can_fail(spark):
    s = Star.from_dir(spark, SF_SMALL)
    before = checks.corrective_from_failure(s).collect()[0]
    assert before.violations > 0 and before.status == "warn"
    s.__dict__["fct_readings"] = s.fct_readings.withColumn("has_failure", F.lit(False))
    after = checks.corrective_from_failure(s).collect()[0]
    assert after.violations > before.violations and after.status == "error"


def test_only_binary_floats_reproduce_the_labels(spark):
    s = Star.from_dir(spark, SF_SMALL)
    cells = {(r.mode_code, r.arithmetic): (r.label_without_rule, r.rule_without_label) for r in checks.rules_match_labels(s).collect()}
    assert all(v == (0, 0) for k, v in cells.items() if k != ("PWF", "decimal"))
    assert sum(cells["PWF", "decimal"]) > 0
    s.__dict__["readings"] = s.readings.withColumn("tax", F.col("tax") + F.lit("0.01").cast("decimal(4,2)"))
    moved = {(r.mode_code, r.arithmetic): r.rule_without_label + r.label_without_rule for r in checks.rules_match_labels(s).collect()}
    assert moved["PWF", "binary"] > 0 and moved["OSF", "decimal"] > 0 and moved["HDF", "binary"] == 0


def test_random_failures_are_never_declared(spark):
    r = Star.from_dir(spark, SF_SMALL).readings
    assert r.filter("flag_rnf").count() > 0 and r.filter("flag_rnf AND declared_failure").count() == 0
