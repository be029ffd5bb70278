"""Report semantics on hand-made star rows (bands, pairing, exposure)."""

import datetime as dt
from decimal import Decimal

from vireo.plans import reports
from vireo.plans.star import Star

T = dt.datetime
WO_SCHEMA = ("asset_sk bigint, order_type string, opened_at timestamp_ntz, concluded_at timestamp_ntz, "
             "duration_hours decimal(8,2), total_cost decimal(12,2), failure_mode_sk int, location_sk bigint, "
             "opened_date_sk int")
DIM_SCHEMA = ("asset_sk bigint, asset_code bigint, version int, criticality string, line_code int, state string, "
              "installed_on date, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")


def star(spark, wo_rows, dim_rows, readings_rows=None):
    s = Star(spark, src=None)
    s.__dict__["fct_work_orders"] = spark.createDataFrame(wo_rows, WO_SCHEMA)
    s.__dict__["dim_asset"] = spark.createDataFrame(dim_rows, DIM_SCHEMA)
    if readings_rows is not None:
        s.__dict__["fct_readings"] = spark.createDataFrame(
            readings_rows, "asset_sk bigint, read_at timestamp_ntz, has_failure boolean")
    return s


def wo(sk, typ, opened, concluded, hours="1.00"):
    return (sk, typ, opened, concluded, Decimal(hours), Decimal("10.00"), 1, 1, 0)


DIMS = [(-1, -1, 0, "unknown", -1, "unknown", None, T(1, 1, 1), T(9999, 12, 31), True),
        (1, 100, 1, "high", 1, "operating", dt.date(2023, 1, 1), T(1, 1, 1), T(2024, 7, 1), False),
        (2, 100, 2, "high", 1, "refurbished", dt.date(2023, 1, 1), T(2024, 7, 1), T(9999, 12, 31), True)]


def test_worst_band_zero_fill_and_last_quarter(spark):
    rows = [
        wo(1, "preventive", T(2024, 1, 10), T(2024, 1, 11)),            # on time
        wo(1, "preventive", T(2024, 2, 10), T(2025, 6, 1)),             # late: worst band wins in Q1
        wo(1, "preventive", T(2024, 4, 10), None),                      # not executed, Q2
        wo(2, "preventive", T(2024, 10, 5), T(2024, 10, 1)),            # inverted dates, Q4
        wo(2, "corrective", T(2024, 8, 1), T(2024, 8, 2)),              # Q3 corrective
        wo(2, "corrective", T(2025, 1, 3), T(2025, 1, 4)),              # Q1 of next year, twice
        wo(2, "corrective", T(2025, 2, 3), T(2025, 2, 4)),
        wo(2, "preventive", T(2025, 1, 20), T(2025, 1, 21)),            # last quarter: dropped
        wo(-1, "preventive", T(2024, 1, 1), T(2024, 1, 2)),             # unknown machine: excluded
    ]
    s = star(spark, rows, DIMS)
    pairs = {(r.year, r.quarter): (r.band, r.next_correctives, r.next_is_last)
             for r in reports.quarter_pairs(s).collect()}
    assert pairs == {(2024, 1): ("late", 0, False), (2024, 2): ("not executed", 1, False),
                     (2024, 4): ("inverted dates", 2, True)}
    # split by version key, the Q2 (version 1) -> Q3 (version 2) pair loses its corrective
    sur = {(r.year, r.quarter): r.next_correctives for r in reports.quarter_pairs(s, "asset_sk").collect()}
    assert sur[(2024, 2)] == 0
    eff = {r.band: (r.pairs, r.correctives_next, r.clean_pairs) for r in reports.next_quarter_effect(s).collect()}
    assert eff["inverted dates"] == (1, 2, 0) and eff["late"] == (1, 0, 1)


def test_exposure_clipped_to_window(spark):
    rows = [wo(1, "corrective", T(2024, 3, 1), T(2024, 3, 2), "2.00"),
            wo(2, "corrective", T(2024, 9, 1), T(2024, 9, 2), "4.00"),
            wo(-1, "corrective", T(2024, 9, 1), T(2024, 9, 2), "8.00")]
    readings = [(1, T(2024, 1, 1), True), (2, T(2024, 12, 31), True), (2, T(2024, 8, 1), False)]
    s = star(spark, rows, DIMS, readings)
    out = {r.criticality: r for r in reports.mtbf_mttr_by_segment(s).collect()}
    high = out["high"]
    assert high.versions == 2 and high.exposed_days == 365.0  # 2024-01-01 .. 2024-12-31
    assert high.failures == 2 and high.mtbf_days == 182.5 and high.mttr_hours == 3.0
    unk = out["unknown"]
    assert unk.exposed_days is None and unk.correctives == 1 and unk.mttr_hours == 8.0
    periods = {(r.asset_code, r.period): r.days for r in reports.before_after_change(s).collect()}
    assert periods == {(100, "before"): 182.0, (100, "after"): 183.0}
