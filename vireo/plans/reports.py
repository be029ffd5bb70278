"""Business questions over the star.

Every report aggregates the large facts by surrogate key first (partial +
final hash aggregate) and only then joins, so joins cannot fan out. Shares of a total
(W4, W5) use a window over ``()`` only on the aggregated result, whose row
count is that of a small dimension (sectors, failure modes); a broadcast
one-row total would aggregate the fact a second time. One-row relations (the
observed window, a scalar maximum) are the only explicit broadcasts besides
the fixed-size dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo import constants as C
from vireo.functions import temporal as T
from vireo.functions.numeric import round_out
from vireo.plans.star import Star


def _ratio(num, den):
    """Ratio in double; NULL when the denominator is zero (ANSI-safe)."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return n.cast("double") / F.nullif(d, F.lit(0)).cast("double")


def observed_window(s: Star) -> DataFrame:
    """One row (start, end): first and last reading (not the calendar)."""
    return s.fct_readings.agg(F.min("read_at").alias("w_start"), F.max("read_at").alias("w_end"))


def _corrective(s: Star) -> DataFrame:
    return s.fct_work_orders.filter(F.col("order_type") == C.ORDER_CORRECTIVE)


def activity(s: Star, *by: str) -> DataFrame:
    """What readings and corrective orders add up to per group of keys, in one row:
    cycles, failures, correctives, hours, cost.

    Both facts are reduced by the keys first; the two small results are then
    added up, so no fact meets a dimension or the other fact.
    """
    read = s.fct_readings.groupBy(*by).agg(F.count(F.lit(1)).alias("cycles"), F.count(F.when(F.col("has_failure"), 1)).alias("failures"))
    done = _corrective(s).groupBy(*by).agg(F.count(F.lit(1)).alias("correctives"), F.sum("duration_hours").alias("hours"),
                                           F.sum("total_cost").alias("cost"))
    both = read.unionByName(done, allowMissingColumns=True)
    return both.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("cycles", "failures", "correctives", "hours", "cost")])


def in_window(s: Star) -> DataFrame:
    """The versions that lived in the observed window, with the days they did."""
    w = F.broadcast(observed_window(s))  # one row
    return (s.dim_asset.filter(F.col("asset_sk") != C.UNKNOWN_SK).join(w, T.overlaps("valid_from", "valid_to", "w_start", "w_end"))
            .withColumn("days", T.clipped_days("valid_from", "valid_to", "w_start", "w_end")).drop("w_start", "w_end"))


# R1 -------------------------------------------------------------------------
def mtbf_mttr_by_segment(s: Star) -> DataFrame:
    """Days in operation per failure and repair hours per corrective order, by criticality.

    The unknown machine has failures and orders but no days.
    """
    unknown = s.dim_asset.filter(F.col("asset_sk") == C.UNKNOWN_SK).withColumn("days", F.lit(None).cast("double"))
    lived = in_window(s).unionByName(unknown).join(activity(s, "asset_sk"), "asset_sk", "left")
    total = lived.groupBy("criticality").agg(
        F.count(F.lit(1)).alias("versions"),
        *[F.sum(c).alias(c) for c in ("days", "failures", "correctives", "hours")])
    none = F.lit(0)
    out = total.select(
        "criticality", "versions", round_out("days", 0).alias("exposed_days"),
        F.coalesce("failures", none).cast("bigint").alias("failures"),
        round_out(_ratio("days", "failures"), 1).alias("mtbf_days"),
        F.coalesce("correctives", none).cast("bigint").alias("correctives"),
        round_out(_ratio("hours", "correctives"), 2).alias("mttr_hours"))
    return out.orderBy(F.col("mtbf_days").asc_nulls_last(), "criticality")


# R2 -------------------------------------------------------------------------
def cost_concentration(s: Star) -> DataFrame:
    """Corrective cost and production of every sector that had corrective orders, with their shares."""
    places = s.dim_location.select("location_sk", "sector_name")
    sectors = (activity(s, "location_sk").join(places, "location_sk")
               .groupBy("sector_name").agg(*[F.sum(c).alias(c) for c in ("cycles", "correctives", "cost")])
               .filter("correctives > 0"))
    everyone = Window.partitionBy()  # over one row per sector
    out = sectors.select(
        "sector_name", F.col("cycles").cast("bigint").alias("cycles"), F.col("correctives").cast("bigint").alias("orders"),
        round_out("cost", 2).alias("cost"),
        round_out(F.lit(100) * _ratio("cost", F.sum("cost").over(everyone)), 1).alias("pct_cost"),
        round_out(F.lit(100) * _ratio("cycles", F.sum("cycles").over(everyone)), 1).alias("pct_cycles"),
        round_out(_ratio("cost", "correctives"), 2).alias("avg_cost_per_order"),
        round_out(_ratio(F.col("cost") * 1000, "cycles"), 2).alias("cost_per_1k_cycles"))
    return out.orderBy(F.col("cost").desc_nulls_last())


# R3 -------------------------------------------------------------------------
def mode_by_downtime(s: Star) -> DataFrame:
    modes = F.broadcast(s.dim_mode.select("failure_mode_sk", "mode_code", "mode_name"))
    g = (_corrective(s).groupBy("failure_mode_sk")
         .agg(F.count(F.lit(1)).alias("orders"), F.sum("duration_hours").alias("hours"),
              F.sum("total_cost").alias("cost"))
         .join(modes, "failure_mode_sk"))
    everyone = Window.partitionBy()  # over the aggregated rows: one per failure mode
    out = g.select(
        "mode_code", "mode_name", F.col("orders").cast("bigint").alias("orders"),
        round_out("hours", 1).alias("downtime_hours"),
        round_out(F.lit(100) * _ratio("hours", F.sum("hours").over(everyone)), 1).alias("pct_hours"),
        round_out(F.lit(100) * _ratio("orders", F.sum("orders").over(everyone)), 1).alias("pct_orders"),
        round_out(_ratio("hours", "orders"), 2).alias("hours_per_order"),
        round_out("cost", 2).alias("cost"))
    return out.orderBy(F.col("downtime_hours").desc_nulls_last())


# R4, R9, R11 ----------------------------------------------------------------
def _band() -> "F.Column":
    delay = F.floor(T.days_between("opened_at", "concluded_at")
                    - F.col("duration_hours").cast("double") / F.lit(24.0))
    return (F.when(F.col("concluded_at").isNull(), F.lit(C.BAND_NOT_DONE))
             .when(delay < 0, F.lit(C.BAND_INVERTED))
             .when(delay <= C.ON_TIME_DAYS, F.lit(C.BAND_ON_TIME))
             .otherwise(F.lit(C.BAND_LATE)))


def _band_rank(col) -> "F.Column":
    e = None
    for name, rank in C.BAND_RANK:
        e = F.when(col == name, F.lit(rank)) if e is None else e.when(col == name, F.lit(rank))
    return e


def _rank_band(col) -> "F.Column":
    e = None
    for name, rank in C.BAND_RANK:
        e = F.when(col == rank, F.lit(name)) if e is None else e.when(col == rank, F.lit(name))
    return e


def version_quarters(s: Star) -> DataFrame:
    """One row per (machine version, quarter) with orders: worst preventive rank, number of correctives."""
    preventive = F.col("order_type") == C.ORDER_PREVENTIVE
    per = s.fct_work_orders.filter(F.col("asset_sk") != C.UNKNOWN_SK).groupBy("asset_sk", T.quarter_index("opened_at").alias("tri")).agg(
        F.max(F.when(preventive, _band_rank(_band()))).alias("rank"),
        F.count(F.when(F.col("order_type") == C.ORDER_CORRECTIVE, 1)).alias("correctives"))
    return per.join(s.dim_asset.select("asset_sk", "asset_code"), "asset_sk")


def quarter_pairs(s: Star, *series: str) -> DataFrame:
    """(series, key, quarter) with preventive work: worst band, correctives of the next quarter.

    A series follows a machine by its natural code (over all its versions) or
    by ``asset_sk`` (a series ends with its version). All series come from one
    aggregate over the fact; the next quarter is the next row of the series if
    it is one quarter on. Quarters without a later one in the data are left out.
    """
    keys = F.explode(F.array(*[F.struct(F.lit(c).alias("series"), F.col(c).alias("key")) for c in series or ("asset_code",)]))
    quarters = (version_quarters(s).select(keys.alias("k"), "tri", "rank", "correctives")
                .groupBy("k.series", "k.key", "tri").agg(F.max("rank").alias("rank"), F.sum("correctives").alias("correctives")))
    upcoming = Window.partitionBy("series", "key").orderBy("tri")  # one row per quarter
    last = F.broadcast(_corrective(s).filter(F.col("asset_sk") != C.UNKNOWN_SK).agg(F.max(T.quarter_index("opened_at")).alias("max_tri")))
    follows = F.lead("tri").over(upcoming) == F.col("tri") + 1
    pairs = quarters.withColumn("next_correctives", F.when(follows, F.lead("correctives").over(upcoming)).otherwise(0))
    return (pairs.filter(F.col("rank").isNotNull()).join(last, F.col("tri") < F.col("max_tri"))
            .select("series", "key", "tri", F.floor((F.col("tri") - 1) / 4).cast("int").alias("year"),
                    ((F.col("tri") - 1) % 4 + 1).cast("int").alias("quarter"), _rank_band(F.col("rank")).alias("band"),
                    "next_correctives", (F.col("tri") + 1 == F.col("max_tri")).alias("next_is_last")))


def next_quarter_effect(s: Star) -> DataFrame:
    p = quarter_pairs(s)
    clean = ~F.col("next_is_last")
    out = p.groupBy("band").agg(
        F.count(F.lit(1)).alias("pairs"),
        F.sum("next_correctives").cast("bigint").alias("correctives_next"),
        round_out(F.avg(F.col("next_correctives").cast("double")), 3).alias("mean_next"),
        F.count(F.when(clean, 1)).alias("clean_pairs"),
        round_out(F.avg(F.when(clean, F.col("next_correctives").cast("double"))), 3).alias("mean_clean"))
    return out.orderBy(F.col("mean_next").desc_nulls_last())


def next_quarter_by_quarter(s: Star) -> DataFrame:
    p = quarter_pairs(s)
    out = p.groupBy("year", "quarter", "band").agg(
        F.count(F.lit(1)).alias("pairs"),
        F.sum("next_correctives").cast("bigint").alias("correctives_next"))
    return out.orderBy("year", "quarter", "band")


def stitching_comparison(s: Star) -> DataFrame:
    names = F.when(F.col("series") == "asset_code", "natural_code").otherwise("surrogate_key")
    return quarter_pairs(s, "asset_code", "asset_sk").groupBy(names.alias("series_key")).agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("next_correctives").cast("bigint").alias("correctives_in_pairs"))


# R5, R8 ---------------------------------------------------------------------
def _periods(s: Star) -> DataFrame:
    """Versions of machines that were ever refurbished, before and after, with their corrective work."""
    after = F.col("state") == C.STATE_REFURBISHED
    ever = s.dim_asset.groupBy("asset_code").agg(F.bool_or(after).alias("ever")).filter("ever").select("asset_code")
    lived = in_window(s).join(ever, "asset_code", "left_semi")
    work = _corrective(s).groupBy("asset_sk").agg(F.count(F.lit(1)).alias("correctives"), F.sum("total_cost").alias("cost"))
    return lived.withColumn("period", F.when(after, "after").otherwise("before")).join(work, "asset_sk", "left")


def before_after_change(s: Star) -> DataFrame:
    v = _periods(s)
    cost = F.coalesce(F.sum("cost"), F.lit(0))
    out = v.groupBy("asset_code", "period").agg(
        round_out(F.sum("days"), 0).alias("days"),
        F.coalesce(F.sum("correctives"), F.lit(0)).cast("bigint").alias("correctives"),
        round_out(cost, 2).alias("cost"),
        round_out(_ratio(cost * 30, F.sum("days")), 2).alias("cost_per_month"),
        round_out(_ratio(F.sum("days"), F.sum("correctives")), 0).alias("days_between_correctives"))
    return out.orderBy("asset_code", F.col("period").desc())


def before_after_totals(s: Star) -> DataFrame:
    v = _periods(s)
    before = F.col("period") == "before"
    after = F.col("period") == "after"
    return v.groupBy("asset_code").agg(
        F.coalesce(F.sum(F.when(before, F.col("correctives"))), F.lit(0)).cast("bigint").alias("correctives_before"),
        F.coalesce(F.sum(F.when(after, F.col("correctives"))), F.lit(0)).cast("bigint").alias("correctives_after"),
        round_out(F.coalesce(F.sum(F.when(before, F.col("cost"))), F.lit(0)), 2).alias("cost_before"),
        round_out(F.coalesce(F.sum(F.when(after, F.col("cost"))), F.lit(0)), 2).alias("cost_after"))


# R6, R7 ---------------------------------------------------------------------
def versions_side_by_side(s: Star) -> DataFrame:
    """Every version of every machine with its corrective work."""
    per_sk = _corrective(s).groupBy("asset_sk").agg(
        F.count(F.lit(1)).alias("correctives"), F.sum("total_cost").alias("cost"),
        F.sum("duration_hours").alias("hours"))
    d = s.dim_asset.filter(F.col("asset_sk") != C.UNKNOWN_SK)
    out = d.join(per_sk, "asset_sk", "left").select(
        "asset_code", "version", "state",
        F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"),
        F.date_format("valid_to", "yyyy-MM-dd").alias("valid_to"),
        F.coalesce(F.col("correctives"), F.lit(0)).cast("bigint").alias("correctives"),
        round_out("cost", 2).alias("corrective_cost"),
        round_out("hours", 1).alias("downtime_hours"))
    return out.orderBy("asset_code", "version")


def scd1_view(s: Star) -> DataFrame:
    """The same totals under a current-only (type 1) view of the machine."""
    current = s.dim_asset.filter(F.col("is_current") & (F.col("asset_sk") != C.UNKNOWN_SK)) \
        .select("asset_code", F.col("state").alias("current_state"))
    codes = s.dim_asset.select("asset_sk", "asset_code")
    per_sk = _corrective(s).groupBy("asset_sk").agg(F.count(F.lit(1)).alias("correctives"), F.sum("total_cost").alias("cost"),
                                                    F.sum("duration_hours").alias("hours"))
    per_code = per_sk.join(codes, "asset_sk").groupBy("asset_code").agg(*[F.sum(c).alias(c) for c in ("correctives", "cost", "hours")])
    return current.join(per_code, "asset_code", "inner").select(
        "asset_code", "current_state", F.col("correctives").cast("bigint").alias("correctives"),
        round_out("cost", 2).alias("corrective_cost"), round_out("hours", 1).alias("downtime_hours"))


# R10 ------------------------------------------------------------------------
def wrong_join_audit(s: Star) -> DataFrame:
    """Rows per machine under the validity join against the natural-code join.

    The natural-code join would emit every (reading, version) pair of a
    machine; its row count is computed as readings x versions from two
    aggregates instead of materialising the fan-out.
    """
    readings = s.readings.groupBy("asset_code").agg(F.count(F.lit(1)).alias("readings"))
    versions = s.dim_asset.filter(F.col("asset_sk") != C.UNKNOWN_SK).groupBy("asset_code") \
        .agg(F.count(F.lit(1)).alias("versions"))
    per_sk = s.fct_readings.groupBy("asset_sk").agg(F.count(F.lit(1)).alias("n"))
    valid = per_sk.join(s.dim_asset.select("asset_sk", "asset_code"), "asset_sk") \
        .groupBy("asset_code").agg(F.sum("n").alias("valid_join_rows"))
    return (readings.join(versions, "asset_code", "inner").join(valid, "asset_code", "left")
            .select("asset_code", "versions", F.col("readings").cast("bigint").alias("readings"),
                    F.coalesce(F.col("valid_join_rows"), F.lit(0)).cast("bigint").alias("valid_join_rows"),
                    (F.col("readings") * F.col("versions")).cast("bigint").alias("natural_join_rows")))


# R12 ------------------------------------------------------------------------
def failure_rate_by_segment_and_region(s: Star) -> DataFrame:
    per_sk = s.fct_readings.groupBy("asset_sk", "location_sk").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("has_failure"), 1)).alias("f"))
    a = per_sk.join(s.dim_asset.select("asset_sk", "criticality"), "asset_sk")
    by_seg = a.groupBy(F.col("criticality").alias("member")).agg(F.sum("n").alias("cycles"), F.sum("f").alias("failures")) \
        .withColumn("dimension", F.lit("criticality"))
    l = per_sk.join(s.dim_location.select("location_sk", "sector_name"), "location_sk")
    by_reg = l.groupBy(F.col("sector_name").alias("member")).agg(F.sum("n").alias("cycles"), F.sum("f").alias("failures")) \
        .withColumn("dimension", F.lit("sector"))
    u = by_seg.unionByName(by_reg)
    return u.select("dimension", "member", F.col("cycles").cast("bigint").alias("cycles"),
                    F.col("failures").cast("bigint").alias("failures"),
                    round_out(F.lit(100) * _ratio("failures", "cycles"), 2).alias("failure_pct"))


def mode_rate_by_segment(s: Star) -> DataFrame:
    """Share of readings carrying each mode flag, per criticality of the
    version at reading time (the per-type mode rates of R12)."""
    flags = C.MODE_FLAGS
    per = s.fct_readings.groupBy("asset_sk").agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.col(c), 1)).alias(k) for k, c in flags])
    g = per.join(s.dim_asset.select("asset_sk", "criticality"), "asset_sk").groupBy("criticality").agg(
        F.sum("n").alias("n"), *[F.sum(k).alias(k) for k, _ in flags])
    long = g.select("criticality", "n", F.explode(F.array(*[F.struct(F.lit(k).alias("mode_code"),
                                                                       F.col(k).alias("k")) for k, _ in flags])).alias("x"))
    out = long.select("criticality", "x.mode_code", F.col("n").cast("bigint").alias("readings"),
                      F.col("x.k").cast("bigint").alias("flagged"),
                      round_out(F.lit(100) * _ratio("x.k", "n"), 2).alias("flagged_pct"))
    return out.orderBy("criticality", "mode_code")


def segment_share_by_sector(s: Star) -> DataFrame:
    """For every sector, the share of its readings that come from each
    criticality (the per-sector type mix of R12)."""
    per = s.fct_readings.groupBy("asset_sk", "location_sk").agg(F.count(F.lit(1)).alias("n"))
    j = per.join(s.dim_asset.select("asset_sk", "criticality"), "asset_sk") \
        .join(s.dim_location.select("location_sk", "sector_name"), "location_sk")
    g = j.groupBy("sector_name", "criticality").agg(F.sum("n").alias("n"))
    sector = Window.partitionBy("sector_name")
    out = g.select("sector_name", "criticality", F.col("n").cast("bigint").alias("readings"),
                   round_out(F.lit(100) * _ratio("n", F.sum("n").over(sector)), 2).alias("share_pct"))
    return out.orderBy("sector_name", "criticality")


# R13, R14, R15, R16 ---------------------------------------------------------
def mode_reconciliation(s: Star) -> DataFrame:
    fact = s.fct_failures.groupBy("failure_mode_sk").agg(F.count(F.lit(1)).alias("fact_rows"))
    r = s.readings.filter(F.col("declared_failure") | F.col("any_mode"))
    src = r.agg(*[F.count(F.when(F.col(c), 1)).alias(code) for code, c in C.MODE_FLAGS],
                F.count(F.when(~F.col("any_mode"), 1)).alias(C.INDETERMINATE))
    src_long = src.select(F.explode(F.array(*[F.struct(F.lit(k).alias("mode_code"), F.col(k).alias("source_flags"))
                                              for k in [*dict(C.MODE_FLAGS), C.INDETERMINATE]])).alias("x")).select("x.*")
    modes = s.dim_mode.select("failure_mode_sk", "mode_code")
    return (modes.join(fact, "failure_mode_sk", "left").join(src_long, "mode_code", "inner")
            .select("mode_code", F.coalesce(F.col("fact_rows"), F.lit(0)).cast("bigint").alias("fact_rows"),
                    F.col("source_flags").cast("bigint").alias("source_flags")))


def mode_count_histogram(s: Star) -> DataFrame:
    n = sum(F.col(c).cast("int") for _, c in C.MODE_FLAGS)
    return s.readings.groupBy(n.alias("modes")).agg(F.count(F.lit(1)).alias("readings"))


def source_incoherence(s: Star) -> DataFrame:
    r = s.readings
    return r.agg(
        F.count(F.when(F.col("declared_failure") & ~F.col("any_mode"), 1)).alias("declared_without_mode"),
        F.count(F.when(~F.col("declared_failure") & F.col("any_mode"), 1)).alias("mode_without_declared"))


def source_profile(s: Star) -> DataFrame:
    """min, max, mean, distinct and null count per measure.

    Readings become (measure, value) pairs that are counted map-side; all
    figures come from the counted pairs, so no column is expanded for its
    distinct count.
    """
    cols = ["quantity", "price", "discount", "tax"]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("decimal(12,2)").alias("value")) for c in cols]))
    counted = s.readings.select(pairs.alias("p")).groupBy("p.measure", "p.value").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("value").isNotNull()
    total = counted.groupBy("measure").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.sum(F.col("value") * F.col("n")).alias("all"),
        F.sum(F.when(known, F.col("n"))).alias("k"), F.count("value").alias("distinct_values"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).cast("bigint").alias("null_values"))
    return total.select("measure", F.col("lo").cast("double").alias("min_value"), F.col("hi").cast("double").alias("max_value"),
                        round_out(_ratio("all", "k"), 4).alias("mean_value"), "distinct_values", "null_values")


# R17, R18, R20 --------------------------------------------------------------
def failure_rate_by_quarter(s: Star) -> DataFrame:
    per_day = s.fct_readings.groupBy("date_sk").agg(F.count(F.lit(1)).alias("n"),
                                                     F.count(F.when(F.col("has_failure"), 1)).alias("f"))
    d = per_day.join(s.dim_date.select("date_sk", "year", "quarter"), "date_sk")
    g = d.groupBy("year", "quarter").agg(F.sum("n").alias("readings"), F.sum("f").alias("failures"))
    out = g.select("year", "quarter", F.col("readings").cast("bigint").alias("readings"),
                    F.col("failures").cast("bigint").alias("failures"),
                    round_out(F.lit(100) * _ratio("failures", "readings"), 2).alias("failure_pct"))
    return out.orderBy("year", "quarter")


def id_time_correlation(s: Star) -> DataFrame:
    e = s.events
    return e.agg(F.count(F.lit(1)).alias("events"),
                 round_out(F.corr(F.col("event_id").cast("double"),
                                  F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                                   F.col("event_at")).cast("double")), 6)
                 .alias("id_time_corr"))


def load_concentration(s: Star) -> DataFrame:
    """Readings per machine: spread, and the share held by the busiest 20%.

    Exact without ranking every machine in one partition: machines are
    first counted per reading-count value (a histogram bounded by the largest
    count), and the top-20% boundary is found by a running sum over that
    small histogram; the boundary bucket contributes only the machines that
    fit.
    """
    return _concentration(s.events.groupBy("asset_code").agg(F.count(F.lit(1)).alias("n")))


def reading_load_concentration(s: Star) -> DataFrame:
    """The same spread and top-20% share over readings per machine."""
    return _concentration(s.readings.groupBy("asset_code").agg(F.count(F.lit(1)).alias("n")))


def _concentration(per_machine: DataFrame) -> DataFrame:
    hist = per_machine.groupBy("n").agg(F.count(F.lit(1)).alias("machines"))
    tot = hist.agg(F.sum("machines").alias("total_machines"), F.sum(F.col("n") * F.col("machines")).alias("total_events"),
                   F.min("n").alias("min_events"), F.max("n").alias("max_events"))
    top = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    h = (hist.crossJoin(F.broadcast(tot))
         .withColumn("k", F.ceil(F.col("total_machines") * F.lit(0.2)))
         .withColumn("before", F.coalesce(F.sum("machines").over(top), F.lit(0)))
         .withColumn("take", F.greatest(F.lit(0), F.least(F.col("machines"), F.col("k") - F.col("before")))))
    return h.groupBy("total_machines", "total_events", "min_events", "max_events").agg(
        F.sum(F.col("take") * F.col("n")).alias("top20_events")).select(
        F.col("total_machines").cast("bigint").alias("machines"),
        F.col("total_events").cast("bigint").alias("events"),
        F.col("min_events").cast("bigint").alias("min_events"),
        F.col("max_events").cast("bigint").alias("max_events"),
        round_out(F.lit(100) * _ratio("top20_events", "total_events"), 1).alias("top20_share_pct"))


def corrective_by_quarter(s: Star) -> DataFrame:
    per_day = _corrective(s).groupBy("opened_date_sk").agg(F.count(F.lit(1)).alias("n"))
    d = per_day.join(s.dim_date.select("date_sk", "year", "quarter"), F.col("opened_date_sk") == F.col("date_sk"))
    out = d.groupBy("year", "quarter").agg(F.sum("n").cast("bigint").alias("corrective_orders"))
    return out.orderBy("year", "quarter")


def shift_load(s: Star) -> DataFrame:
    """Events per shift of the fixed shift table (K6 applied to event times)."""
    per = s.events.groupBy(T.shift_of_hour("event_at").alias("shift_sk")).agg(
        F.count(F.lit(1)).alias("events"), F.count(F.when(F.col("is_failure"), 1)).alias("failures"))
    return F.broadcast(s.dim_shift).join(per, "shift_sk", "left").select(
        "shift_sk", "shift_name", "start_hour", "end_hour", "wraps_midnight",
        F.coalesce(F.col("events"), F.lit(0)).cast("bigint").alias("events"),
        F.coalesce(F.col("failures"), F.lit(0)).cast("bigint").alias("failures"))


def open_close_quarters(s: Star) -> DataFrame:
    """Work orders by opening and conclusion quarter: the date dimension
    plays two roles (J12); never-concluded orders land on the -1 member."""
    per = s.fct_work_orders.groupBy("opened_date_sk", "concluded_date_sk").agg(F.count(F.lit(1)).alias("n"))
    d = s.dim_date.select("date_sk", "year", "quarter")
    opened = d.select(F.col("date_sk").alias("opened_date_sk"), F.col("year").alias("open_year"),
                      F.col("quarter").alias("open_quarter"))
    closed = d.select(F.col("date_sk").alias("concluded_date_sk"), F.col("year").alias("close_year"),
                      F.col("quarter").alias("close_quarter"))
    return (per.join(opened, "opened_date_sk").join(closed, "concluded_date_sk")
            .groupBy("open_year", "open_quarter", "close_year", "close_quarter")
            .agg(F.sum("n").cast("bigint").alias("orders"))
            .orderBy("open_year", "open_quarter", F.col("close_year").asc_nulls_last(), "close_quarter"))


# O1, O5, S15 -------------------------------------------------------------------
def out_of_order(df: DataFrame, key: str) -> DataFrame:
    """(n, misplaced, first_key, last_key): how many rows do not follow on the row before them, as the rows come out.

    Rows are compared inside their partition, and the least key of every
    partition with the greatest of those before it (a row per partition), so
    a sorted table of any size is checked without bringing it together.
    """
    placed = df.select(F.col(key).alias("k"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    before = F.lag("k").over(Window.partitionBy("part").orderBy("place"))
    parts = placed.withColumn("wrong", (before >= F.col("k")).cast("int")).groupBy("part").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("wrong"), F.lit(0)).alias("wrong"), F.min("k").alias("low"), F.max("k").alias("high"))
    upto = F.max("high").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("cut", F.coalesce((upto >= F.col("low")).cast("int"), F.lit(0)))
    return parts.agg(F.sum("n").alias("n"), F.sum(F.col("wrong") + F.col("cut")).alias("misplaced"), F.min("low").alias("first_key"), F.max("high").alias("last_key"))


def sorted_tables(s: Star) -> DataFrame:
    """Dimensions by key and generated tables by date, as their rows come out of a sort."""
    date_text = lambda df, c: df.withColumn(c, F.date_format(c, "yyyy-MM-dd"))
    tables = [("dim_asset by key", s.dim_asset.orderBy("asset_sk"), "asset_sk"),
              ("dim_technician by key", s.dim_technician.orderBy("technician_sk"), "technician_sk"),
              ("dim_date by date", date_text(s.dim_date.where("date_sk <> -1").orderBy("date"), "date"), "date"),
              ("change days by date", date_text(s.changes.select("changed_on").distinct().orderBy("changed_on"), "changed_on"), "changed_on")]
    out = None
    for name, df, key in tables:
        row = out_of_order(df, key).select(F.lit(name).alias("table_name"), "n", "misplaced",
                                           F.col("first_key").cast("string").alias("first_key"), F.col("last_key").cast("string").alias("last_key"))
        out = row if out is None else out.unionByName(row)
    return out


# O1-O3, O5, S15 ----------------------------------------------------------------
def row_order(s: Star) -> DataFrame:
    """The rows of three sorted reports, numbered as they come out.

    Each report has a few rows (segments, modes, pairs of quarters), so one
    partition holds it; numbering reads the order the sort left, it does not
    sort again.
    """
    def numbered(name: str, report: DataFrame, *labels: str) -> DataFrame:
        label = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in labels])
        return report.coalesce(1).select(F.lit(name).alias("report"), F.monotonically_increasing_id().alias("row_no"), label.alias("label"))

    mixed = open_close_quarters(s).orderBy(F.col("orders").desc(), F.col("close_year").asc_nulls_last(), F.col("close_quarter").asc_nulls_last(),
                                           F.col("open_year").desc(), F.col("open_quarter").desc())
    return (numbered("mtbf_nulls_last", mtbf_mttr_by_segment(s), "criticality")
            .unionByName(numbered("downtime_descending", mode_by_downtime(s), "mode_code"))
            .unionByName(numbered("quarters_mixed", mixed, "open_year", "open_quarter", "close_year", "close_quarter")))
