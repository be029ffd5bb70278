"""Registered queries: name -> (Spark plan builder, oracle SQL).

Each Spark builder takes a ``Star`` and returns a lazy DataFrame over the
whole driver tables. ``normalize`` gives results a comparable shape (decimals
as text at their scale, dates and timestamps as ISO text with microseconds);
the SQL side does the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo import constants as C
from vireo.functions.temporal import quarter_index
from vireo.operators import history as H
from vireo.operators.keys import dense_key, hash_key
from vireo.plans import checks, expressions, reports
from vireo.plans.oracle import DAY, FOR_PERIODS, TS, _r, _ratio, clipped, pairs_sql, q, shift_case
from vireo.plans.refresh import ReadingMart
from vireo.plans.star import Star
from vireo.session import scratch_path
from vireo.sources import storage
from vireo.streaming.history_stream import HistorySink

STATE_CUTOFF = "1998-01-01"
FIRST_BATCH_CUTOFF = "1997-06-30"
SINK_CUTS = ("1994-07-01", "1996-10-15")
LATE_CUTS = ("1997-01-01", "1998-01-01")
#: Ship year whose lines arrive wrong and are delivered again.
CORRECTED_YEAR = 1996


def normalize(df: DataFrame) -> DataFrame:
    cols = []
    for name, typ in df.dtypes:
        c = F.col(f"`{name}`")
        if typ.startswith("decimal"):
            c = c.cast("string")
        elif typ == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif typ.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        cols.append(c.alias(name))
    return df.select(*cols)


def _hist_kw():
    from vireo.plans.staging import HISTORY_FIELDS
    return dict(key="asset_code", base_date="installed_on", date="changed_on", field="field",
                value="new_value", fields=HISTORY_FIELDS)


def _state(s: Star, cutoff) -> DataFrame:
    return H.state_as_of(s.assets, s.changes, cutoff, **_hist_kw())


def _two_batches(s: Star) -> DataFrame:
    t1 = H.scd2_apply(None, _state(s, FIRST_BATCH_CUTOFF), key="asset_code")
    return H.scd2_apply(t1, _state(s, C.DEFAULT_CUTOFF), key="asset_code")


def _dense_orders(s: Star) -> DataFrame:
    o = s.src["orders"].select(F.col("o_orderkey").alias("order_no"), F.col("o_orderdate").alias("opened_at"))
    return dense_key(o, ["opened_at", "order_no"], "order_sk").select("order_no", "order_sk")


def _hash_versions(s: Star) -> DataFrame:
    """A key for every version of a machine from what never changes: its code and its start."""
    start = F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    v = s.history.select("asset_code", start.alias("valid_from"))
    return v.select("asset_code", "valid_from", hash_key(["asset_code", "valid_from"]).alias("version_hash"))


def _sink(s: Star, late: str = "rewrite", cuts: tuple[str, str] = SINK_CUTS) -> tuple[HistorySink, DataFrame, DataFrame, DataFrame]:
    """A fresh durable sink, and the change log in three parts by date."""
    sink = HistorySink(s.spark, s.assets, scratch_path(s.spark, "history-sink"), **_hist_kw(), late=late)
    day = F.col("changed_on")
    first, last = (F.lit(c).cast("date") for c in cuts)
    return sink, s.changes.where(day < first), s.changes.where((day >= first) & (day < last)), s.changes.where(day >= last)


def _sink_batches(s: Star) -> DataFrame:
    """Two writers, the latest dates first, one batch retried; equals the
    one-pass history."""
    sink, early, middle, late = _sink(s)
    sink.apply(late, 0)
    sink.append(early)
    sink.apply(late, 0)
    sink.apply(middle, 1)
    return sink.history()


def _sink_compacted(s: Star) -> DataFrame:
    """Two batches stored as one, a third merged on read; equals the one-pass
    history."""
    sink, early, middle, late = _sink(s)
    sink.append(middle)
    sink.append(late)
    sink.compact()
    sink.append(early)
    return sink.history()


def _sink_late_ignored(s: Star) -> DataFrame:
    """The early changes come last: those of keys with later ones are left
    out, as the timestamp strategy does."""
    sink, early, middle, late = _sink(s, "ignore", LATE_CUTS)
    sink.append(middle)
    sink.append(late)
    sink.append(early)
    return sink.history()


def _sink_before_last(s: Star) -> DataFrame:
    """The history as it was before the last batch (H5), read after that
    batch and its compaction."""
    sink, early, middle, late = _sink(s)
    sink.append(early)
    sink.append(middle)
    before = sink.commits.latest()[0]
    sink.append(late)
    sink.compact()
    return sink.history(as_of=before)


def _readings_refreshed(s: Star) -> DataFrame:
    """Readings by quarter after a refresh: the lines of one year come with
    twice their price, then their files are replaced by the right ones."""
    spark, lines, price = s.spark, s.src["lineitem"], "l_extendedprice"
    source = scratch_path(spark, "refresh-input")
    corrected = F.coalesce(F.year("l_shipdate") == CORRECTED_YEAR, F.lit(False))
    doubled = (F.col(price) * 2).cast(lines.schema[price].dataType)
    s.src["orders"].write.parquet(f"{source}/orders.parquet")
    lines.where(~corrected).write.parquet(f"{source}/lineitem.parquet/others")
    lines.where(corrected).withColumn(price, doubled).write.parquet(f"{source}/lineitem.parquet/wrong")
    kept = ReadingMart(spark, source, scratch_path(spark, "refresh-mart"))
    kept.refresh()
    lines.where(corrected).write.parquet(f"{source}/lineitem.parquet/right")
    storage.delete(spark, f"{source}/lineitem.parquet/wrong")
    touched = kept.refresh()
    return (kept.readings().groupBy(quarter_index("read_at").alias("quarter_no"))
            .agg(F.count("*").alias("n_readings"), F.sum("quantity").cast("decimal(22,2)").alias("quantity"), F.sum("price").cast("decimal(22,2)").alias("price"))
            .withColumn("rebuilt", F.col("quarter_no").isin(touched)))


SPARK: dict[str, Callable[[Star], DataFrame]] = {
    "dedup_lineitem": lambda s: s.lines,
    "change_log": lambda s: s.changes,
    "work_orders_staging": lambda s: s.work_orders,
    "date_dimension": lambda s: s.dim_date,
    "location_dimension": lambda s: s.dim_location,
    "technician_dimension": lambda s: s.dim_technician,
    "shift_load": reports.shift_load,
    "dense_key_two_pass": _dense_orders,
    "hash_key": _hash_versions,
    "cutoff_dates": lambda s: H.cutoff_dates(s.changes, "changed_on"),
    "state_as_of": lambda s: _state(s, STATE_CUTOFF),
    "scd2_history": lambda s: s.history,
    "scd2_dimension": lambda s: s.dim_asset.orderBy("asset_sk"),
    "scd2_apply_two_batches": _two_batches,
    "scd2_sink_batches": _sink_batches,
    "scd2_sink_compacted": _sink_compacted,
    "scd2_sink_late_ignored": _sink_late_ignored,
    "scd2_sink_before_last": _sink_before_last,
    "readings_refreshed": _readings_refreshed,
    "history_summary": lambda s: H.history_summary(s.history, "asset_code"),
    "fact_readings": lambda s: s.fct_readings,
    "fact_failures": lambda s: s.fct_failures,
    "fact_work_orders": lambda s: s.fct_work_orders,
    "wrong_join_audit": reports.wrong_join_audit,
    "mtbf_mttr_by_segment": reports.mtbf_mttr_by_segment,
    "cost_concentration": reports.cost_concentration,
    "mode_by_downtime": reports.mode_by_downtime,
    "next_quarter_effect": reports.next_quarter_effect,
    "next_quarter_by_quarter": reports.next_quarter_by_quarter,
    "stitching_comparison": reports.stitching_comparison,
    "before_after_change": reports.before_after_change,
    "before_after_totals": reports.before_after_totals,
    "versions_side_by_side": reports.versions_side_by_side,
    "scd1_view": reports.scd1_view,
    "failure_rate_by_segment_and_region": reports.failure_rate_by_segment_and_region,
    "mode_reconciliation": reports.mode_reconciliation,
    "mode_count_histogram": reports.mode_count_histogram,
    "source_incoherence": reports.source_incoherence,
    "source_profile": reports.source_profile,
    "failure_rate_by_quarter": reports.failure_rate_by_quarter,
    "id_time_correlation": reports.id_time_correlation,
    "load_concentration": reports.load_concentration,
    "corrective_by_quarter": reports.corrective_by_quarter,
    "quality_report": checks.quality_report,
    "dirt_inventory": checks.dirt_inventory,
    "overlap_check": checks.overlap_check,
    "history_complete": checks.history_complete,
    "change_before_install": checks.change_before_install,
    "reading_before_install": checks.reading_before_install,
    "corrective_from_failure": checks.corrective_from_failure,
    "facts_agree": checks.facts_agree,
    "no_not_applicable": checks.no_not_applicable,
    "rules_match_labels": checks.rules_match_labels,
    "scalar_matrix": expressions.scalar_matrix,
    "filter_matrix": expressions.filter_matrix,
    "basic_aggregates": expressions.basic_aggregates,
    "csv_text_load": expressions.csv_text_load,
    "csv_manifest_load": expressions.csv_manifest_load,
    "row_order": reports.row_order,
    "sorted_tables": reports.sorted_tables,
    "mutation_checks": checks.mutation_checks,
    "event_readings": expressions.event_readings,
    "open_close_quarters": reports.open_close_quarters,
    "mode_rate_by_segment": reports.mode_rate_by_segment,
    "reading_load_concentration": reports.reading_load_concentration,
    "segment_share_by_sector": reports.segment_share_by_sector,
}


def _state_sql(name: str, cutoff: str) -> str:
    return f"""
, {name}_lt AS (
  SELECT asset_code, field, max(changed_on) AS d FROM changes
  WHERE changed_on <= DATE '{cutoff}' GROUP BY asset_code, field
),
{name}_lv AS (
  SELECT c.asset_code, c.field, c.changed_on, max(c.new_value) AS v
  FROM changes c JOIN {name}_lt t ON c.asset_code = t.asset_code AND c.field = t.field AND c.changed_on = t.d
  GROUP BY c.asset_code, c.field, c.changed_on
),
{name}_ap AS (
  SELECT asset_code,
         max(CASE WHEN field = 'criticality' THEN v END) AS criticality,
         max(CASE WHEN field = 'line_code' THEN v END) AS line_code,
         max(CASE WHEN field = 'state' THEN v END) AS state,
         max(changed_on) AS last_change
  FROM {name}_lv GROUP BY asset_code
),
{name} AS (
  SELECT a.asset_code, coalesce(p.criticality, a.criticality) AS criticality,
         coalesce(p.line_code, CAST(a.line_code AS VARCHAR)) AS line_code,
         coalesce(p.state, a.state) AS state, a.installed_on,
         CAST(coalesce(p.last_change, a.installed_on) AS TIMESTAMP) AS updated_at
  FROM assets a LEFT JOIN {name}_ap p USING (asset_code)
)
"""


def _fmt_state(alias: str) -> str:
    return (f"{alias}.asset_code, {alias}.criticality, {alias}.line_code, {alias}.state, "
            f"strftime({alias}.installed_on, {DAY}) AS installed_on, strftime({alias}.updated_at, {TS}) AS updated_at")


SQL: dict[str, str] = {
    "dedup_lineitem": q(f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, strftime(l_shipdate, {TS}) AS l_shipdate FROM lines"""),
    "change_log": q(f"""
SELECT asset_code, strftime(changed_on, {DAY}) AS changed_on, field, new_value, reason FROM changes"""),
    "work_orders_staging": q(f"""
SELECT order_no, asset_code, order_type, failure_mode, origin_line,
       strftime(opened_at, {TS}) AS opened_at, strftime(concluded_at, {TS}) AS concluded_at, technician_id,
       CAST(duration_hours AS VARCHAR) AS duration_hours, CAST(labour_cost AS VARCHAR) AS labour_cost,
       CAST(parts_cost AS VARCHAR) AS parts_cost
FROM work_orders"""),
    "date_dimension": q(f"""
SELECT date_sk, strftime(date, {DAY}) AS date, year, month, quarter, day_of_month, year_month, month_name,
       day_of_week, day_name, is_workday, season FROM dim_date"""),
    "location_dimension": q("SELECT * FROM dim_location"),
    "technician_dimension": q("""
SELECT technician_sk, technician_id, name, nation_key, CAST(hourly_rate AS VARCHAR) AS hourly_rate FROM dim_technician"""),
    "shift_load": q(f"""
, per AS (
  SELECT {shift_case('event_at')} AS shift_sk, count(*) AS events, count(*) FILTER (WHERE is_failure) AS failures
  FROM events_x GROUP BY 1
)
SELECT s.shift_sk, s.shift_name, s.start_hour, s.end_hour, s.end_hour < s.start_hour AS wraps_midnight,
       coalesce(p.events, 0) AS events, coalesce(p.failures, 0) AS failures
FROM dim_shift s LEFT JOIN per p USING (shift_sk)"""),
    "dense_key_two_pass": """
SELECT o_orderkey AS order_no, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_sk FROM orders""",
    "cutoff_dates": q(f"""
SELECT strftime(cutoff, {DAY}) AS cutoff FROM (
  SELECT min(changed_on) - 1 AS cutoff FROM changes
  UNION
  SELECT DISTINCT changed_on FROM changes)"""),
    "state_as_of": q(_state_sql("st", STATE_CUTOFF) + f"SELECT {_fmt_state('st')} FROM st"),
    "scd2_history": q(f"""
SELECT asset_code, criticality, line_code, state, strftime(installed_on, {DAY}) AS installed_on,
       strftime(updated_at, {TS}) AS updated_at, strftime(valid_from, {TS}) AS valid_from,
       strftime(valid_to, {TS}) AS valid_to FROM history"""),
    "scd2_dimension": q(f"""
SELECT asset_sk, asset_code, version, criticality, line_code, state, strftime(installed_on, {DAY}) AS installed_on,
       strftime(valid_from, {TS}) AS valid_from, strftime(valid_to, {TS}) AS valid_to, is_current FROM dim_asset"""),
    "scd2_apply_two_batches": q(_state_sql("s1", FIRST_BATCH_CUTOFF) + _state_sql("s2", str(C.DEFAULT_CUTOFF)) + f"""
SELECT {_fmt_state('s1')}, strftime(s1.updated_at, {TS}) AS valid_from,
       strftime(CASE WHEN s2.updated_at > s1.updated_at THEN s2.updated_at END, {TS}) AS valid_to
FROM s1 JOIN s2 USING (asset_code)
UNION ALL
SELECT {_fmt_state('s2')}, strftime(s2.updated_at, {TS}) AS valid_from, NULL AS valid_to
FROM s2 JOIN s1 USING (asset_code) WHERE s2.updated_at > s1.updated_at"""),
    "history_summary": q("""
SELECT count(*) AS versions, count(DISTINCT asset_code) AS keys,
       count(*) FILTER (WHERE valid_to IS NULL) AS current_versions,
       count(DISTINCT asset_code) FILTER (WHERE valid_to IS NOT NULL) AS keys_with_past
FROM history"""),
    "fact_readings": q(f"""
SELECT asset_sk, location_sk, date_sk, shift_sk, reading_order, reading_line, part_key,
       strftime(read_at, {TS}) AS read_at, CAST(quantity AS VARCHAR) AS quantity, CAST(price AS VARCHAR) AS price,
       CAST(discount AS VARCHAR) AS discount, CAST(tax AS VARCHAR) AS tax, CAST(net_price AS VARCHAR) AS net_price,
       CAST(charge AS VARCHAR) AS charge, flag_twf, flag_osf, flag_hdf, flag_pwf, flag_rnf, has_failure, declared_failure
FROM fct_readings"""),
    "fact_failures": q(f"""
SELECT asset_sk, location_sk, date_sk, shift_sk, failure_mode_sk, reading_order, reading_line,
       strftime(read_at, {TS}) AS read_at FROM fct_failures"""),
    "fact_work_orders": q(f"""
SELECT asset_sk, location_sk, technician_sk, failure_mode_sk, opened_date_sk, concluded_date_sk, order_no,
       order_type, origin_line, strftime(opened_at, {TS}) AS opened_at, strftime(concluded_at, {TS}) AS concluded_at,
       CAST(duration_hours AS VARCHAR) AS duration_hours, CAST(labour_cost AS VARCHAR) AS labour_cost,
       CAST(parts_cost AS VARCHAR) AS parts_cost, CAST(total_cost AS VARCHAR) AS total_cost
FROM fct_work_orders"""),
    "wrong_join_audit": q("""
, rd AS (SELECT asset_code, count(*) AS readings FROM readings GROUP BY asset_code),
vs AS (SELECT asset_code, count(*) AS versions FROM dim_asset WHERE asset_sk <> -1 GROUP BY asset_code),
vj AS (SELECT a.asset_code, count(*) AS valid_join_rows FROM fct_readings f JOIN dim_asset a USING (asset_sk)
       GROUP BY a.asset_code),
nj AS (SELECT r.asset_code, count(*) AS natural_join_rows FROM readings r JOIN dim_asset a
       ON a.asset_code = r.asset_code AND a.asset_sk <> -1 GROUP BY r.asset_code)
SELECT rd.asset_code, vs.versions, rd.readings, coalesce(vj.valid_join_rows, 0) AS valid_join_rows, nj.natural_join_rows
FROM rd JOIN vs USING (asset_code) LEFT JOIN vj USING (asset_code) JOIN nj USING (asset_code)"""),
    "mtbf_mttr_by_segment": q(f"""
, seen AS (
  SELECT asset_sk, criticality, CASE WHEN asset_sk <> -1 THEN (SELECT {clipped('valid_from', 'valid_to')} FROM obs) END AS days
  FROM dim_asset WHERE asset_sk = -1 OR (SELECT valid_from < w_end AND valid_to > w_start FROM obs)
),
segment AS (
  SELECT g.criticality,
         (SELECT count(*) FROM seen v WHERE v.criticality = g.criticality) AS versions,
         (SELECT sum(v.days) FROM seen v WHERE v.criticality = g.criticality) AS days,
         (SELECT count(*) FROM fct_readings f WHERE f.has_failure
           AND f.asset_sk IN (SELECT v.asset_sk FROM seen v WHERE v.criticality = g.criticality)) AS failures,
         (SELECT count(*) FROM corrective o
           WHERE o.asset_sk IN (SELECT v.asset_sk FROM seen v WHERE v.criticality = g.criticality)) AS correctives,
         (SELECT sum(o.duration_hours) FROM corrective o
           WHERE o.asset_sk IN (SELECT v.asset_sk FROM seen v WHERE v.criticality = g.criticality)) AS hours
  FROM (SELECT DISTINCT criticality FROM seen) g
)
SELECT criticality, versions, {_r('days', 0)} AS exposed_days, failures, {_r(_ratio('days', 'failures'), 1)} AS mtbf_days,
       correctives, {_r(_ratio('hours', 'correctives'), 2)} AS mttr_hours
FROM segment"""),
    "cost_concentration": q(f"""
, place AS (
  SELECT s.sector_name,
         (SELECT count(*) FROM fct_readings f WHERE f.location_sk IN (SELECT l.location_sk FROM dim_location l WHERE l.sector_name = s.sector_name)) AS cycles,
         (SELECT count(*) FROM corrective o WHERE o.location_sk IN (SELECT l.location_sk FROM dim_location l WHERE l.sector_name = s.sector_name)) AS orders,
         (SELECT sum(o.total_cost) FROM corrective o
           WHERE o.location_sk IN (SELECT l.location_sk FROM dim_location l WHERE l.sector_name = s.sector_name)) AS cost
  FROM (SELECT DISTINCT sector_name FROM dim_location) s
),
spending AS (SELECT sector_name, nullif(cycles, 0) AS cycles, orders, cost FROM place WHERE orders > 0)
SELECT sector_name, cycles, orders, {_r('cost', 2)} AS cost,
       {_r('100 * ' + _ratio('cost', '(SELECT sum(t.cost) FROM spending t)'), 1)} AS pct_cost,
       {_r('100 * ' + _ratio('cycles', '(SELECT sum(t.cycles) FROM spending t)'), 1)} AS pct_cycles,
       {_r(_ratio('cost', 'orders'), 2)} AS avg_cost_per_order,
       {_r(_ratio('cost * 1000', 'cycles'), 2)} AS cost_per_1k_cycles
FROM spending"""),
    "mode_by_downtime": q(f"""
SELECT m.mode_code, m.mode_name, count(*) AS orders, {_r('sum(o.duration_hours)', 1)} AS downtime_hours,
       {_r('100 * ' + _ratio('sum(o.duration_hours)', 'sum(sum(o.duration_hours)) OVER ()'), 1)} AS pct_hours,
       {_r('100 * ' + _ratio('count(*)', 'sum(count(*)) OVER ()'), 1)} AS pct_orders,
       {_r(_ratio('sum(o.duration_hours)', 'count(*)'), 2)} AS hours_per_order,
       {_r('sum(o.total_cost)', 2)} AS cost
FROM corrective o JOIN dim_mode m USING (failure_mode_sk)
GROUP BY m.mode_code, m.mode_name"""),
    "next_quarter_effect": q(pairs_sql("asset_code") + f"""
SELECT band, count(*) AS pairs, CAST(sum(next_correctives) AS BIGINT) AS correctives_next,
       {_r('avg(CAST(next_correctives AS DOUBLE))', 3)} AS mean_next,
       count(*) FILTER (WHERE NOT next_is_last) AS clean_pairs,
       {_r('avg(CAST(next_correctives AS DOUBLE)) FILTER (WHERE NOT next_is_last)', 3)} AS mean_clean
FROM pairs GROUP BY band"""),
    "next_quarter_by_quarter": q(pairs_sql("asset_code") + """
SELECT year, quarter, band, count(*) AS pairs, CAST(sum(next_correctives) AS BIGINT) AS correctives_next
FROM pairs GROUP BY year, quarter, band"""),
    "before_after_change": q(FOR_PERIODS + f"""
SELECT asset_code, period, {_r('sum(days)', 0)} AS days,
       CAST(coalesce(sum(correctives), 0) AS BIGINT) AS correctives,
       {_r('coalesce(sum(cost), 0)', 2)} AS cost,
       {_r(_ratio('coalesce(sum(cost), 0) * 30', 'sum(days)'), 2)} AS cost_per_month,
       {_r(_ratio('sum(days)', 'sum(correctives)'), 0)} AS days_between_correctives
FROM pv GROUP BY asset_code, period"""),
    "before_after_totals": q(FOR_PERIODS + f"""
SELECT asset_code,
       CAST(coalesce(sum(correctives) FILTER (WHERE period = 'before'), 0) AS BIGINT) AS correctives_before,
       CAST(coalesce(sum(correctives) FILTER (WHERE period = 'after'), 0) AS BIGINT) AS correctives_after,
       {_r("coalesce(sum(cost) FILTER (WHERE period = 'before'), 0)", 2)} AS cost_before,
       {_r("coalesce(sum(cost) FILTER (WHERE period = 'after'), 0)", 2)} AS cost_after
FROM pv GROUP BY asset_code"""),
    "versions_side_by_side": q(f"""
, per_sk AS (SELECT asset_sk, count(*) AS correctives, sum(total_cost) AS cost, sum(duration_hours) AS hours
             FROM corrective GROUP BY asset_sk)
SELECT a.asset_code, a.version, a.state, strftime(a.valid_from, {DAY}) AS valid_from,
       strftime(a.valid_to, {DAY}) AS valid_to, coalesce(p.correctives, 0) AS correctives,
       {_r('p.cost', 2)} AS corrective_cost, {_r('p.hours', 1)} AS downtime_hours
FROM dim_asset a LEFT JOIN per_sk p USING (asset_sk) WHERE a.asset_sk <> -1"""),
    "scd1_view": q(f"""
, cur AS (SELECT asset_code, state AS current_state FROM dim_asset WHERE is_current AND asset_sk <> -1),
per_code AS (SELECT a.asset_code, count(*) AS correctives, sum(o.total_cost) AS cost, sum(o.duration_hours) AS hours
             FROM corrective o JOIN dim_asset a USING (asset_sk) GROUP BY a.asset_code)
SELECT c.asset_code, c.current_state, p.correctives, {_r('p.cost', 2)} AS corrective_cost,
       {_r('p.hours', 1)} AS downtime_hours
FROM cur c JOIN per_code p USING (asset_code)"""),
    "failure_rate_by_segment_and_region": q(f"""
, u AS (
  SELECT 'criticality' AS dimension, a.criticality AS member, count(*) AS cycles,
         count(*) FILTER (WHERE f.has_failure) AS failures
  FROM fct_readings f JOIN dim_asset a USING (asset_sk) GROUP BY a.criticality
  UNION ALL
  SELECT 'sector', l.sector_name, count(*), count(*) FILTER (WHERE f.has_failure)
  FROM fct_readings f JOIN dim_location l USING (location_sk) GROUP BY l.sector_name
)
SELECT dimension, member, cycles, failures, {_r('100 * ' + _ratio('failures', 'cycles'), 2)} AS failure_pct FROM u"""),
    "mode_reconciliation": q("""
, fact AS (SELECT failure_mode_sk, count(*) AS fact_rows FROM fct_failures GROUP BY 1),
r AS (SELECT * FROM readings_x WHERE declared_failure OR any_mode),
src AS (
  SELECT 'TWF' AS mode_code, count(*) FILTER (WHERE flag_twf) AS source_flags FROM r
  UNION ALL SELECT 'OSF', count(*) FILTER (WHERE flag_osf) FROM r
  UNION ALL SELECT 'HDF', count(*) FILTER (WHERE flag_hdf) FROM r
  UNION ALL SELECT 'PWF', count(*) FILTER (WHERE flag_pwf) FROM r
  UNION ALL SELECT 'RNF', count(*) FILTER (WHERE flag_rnf) FROM r
  UNION ALL SELECT 'INDETERMINATE', count(*) FILTER (WHERE NOT any_mode) FROM r
)
SELECT m.mode_code, coalesce(f.fact_rows, 0) AS fact_rows, s.source_flags
FROM dim_mode m LEFT JOIN fact f USING (failure_mode_sk) JOIN src s USING (mode_code)"""),
    "mode_count_histogram": q("""
SELECT CAST(flag_twf AS INTEGER) + CAST(flag_osf AS INTEGER) + CAST(flag_hdf AS INTEGER) + CAST(flag_pwf AS INTEGER)
       + CAST(flag_rnf AS INTEGER) AS modes,
       count(*) AS readings
FROM readings GROUP BY 1"""),
    "source_incoherence": q("""
SELECT count(*) FILTER (WHERE declared_failure AND NOT any_mode) AS declared_without_mode,
       count(*) FILTER (WHERE NOT declared_failure AND any_mode) AS mode_without_declared
FROM readings_x"""),
    "source_profile": q(" " + " UNION ALL ".join(f"""
SELECT '{c}' AS measure, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value,
       {_r(_ratio(f'sum({c})', f'count({c})'), 4)} AS mean_value, count(DISTINCT {c}) AS distinct_values,
       count(*) FILTER (WHERE {c} IS NULL) AS null_values FROM readings""" for c in ["quantity", "price", "discount", "tax"])),
    "failure_rate_by_quarter": q(f"""
SELECT d.year, d.quarter, count(*) AS readings, count(*) FILTER (WHERE f.has_failure) AS failures,
       {_r('100 * ' + _ratio('count(*) FILTER (WHERE f.has_failure)', 'count(*)'), 2)} AS failure_pct
FROM fct_readings f JOIN dim_date d USING (date_sk) GROUP BY d.year, d.quarter"""),
    "id_time_correlation": q(f"""
SELECT count(*) AS events, {_r('corr(CAST(event_id AS DOUBLE), CAST(epoch_us(event_at) AS DOUBLE))', 6)} AS id_time_corr
FROM events_x"""),
    "load_concentration": q(f"""
, per AS (SELECT asset_code, count(*) AS n FROM events_x GROUP BY asset_code),
ranked AS (SELECT n, row_number() OVER (ORDER BY n DESC, asset_code) AS rk, count(*) OVER () AS total FROM per)
SELECT CAST(max(total) AS BIGINT) AS machines, CAST(sum(n) AS BIGINT) AS events, CAST(min(n) AS BIGINT) AS min_events,
       CAST(max(n) AS BIGINT) AS max_events,
       {_r('100 * ' + _ratio('sum(n) FILTER (WHERE rk <= ceil(total * 0.2))', 'sum(n)'), 1)} AS top20_share_pct
FROM ranked"""),
    "corrective_by_quarter": q("""
SELECT d.year, d.quarter, count(*) AS corrective_orders
FROM corrective o JOIN dim_date d ON d.date_sk = o.opened_date_sk GROUP BY d.year, d.quarter"""),
}

# natural-code and version-key series each need their own pair CTEs
SQL["stitching_comparison"] = (
    "SELECT * FROM (" + q(pairs_sql("asset_code") + """
SELECT 'natural_code' AS series_key, count(*) AS pairs, CAST(sum(next_correctives) AS BIGINT) AS correctives_in_pairs
FROM pairs""") + ") UNION ALL SELECT * FROM (" + q(pairs_sql("asset_sk") + """
SELECT 'surrogate_key' AS series_key, count(*) AS pairs, CAST(sum(next_correctives) AS BIGINT) AS correctives_in_pairs
FROM pairs""") + ")")

SQL.update(checks.SQL)

_SPAN = "(CAST(date_diff('microsecond', opened_at, concluded_at) AS DOUBLE) / 86400e6)"
SQL.update({
    "reading_load_concentration": q(f"""
, per AS (SELECT asset_code, count(*) AS n FROM readings GROUP BY asset_code),
ranked AS (SELECT n, row_number() OVER (ORDER BY n DESC, asset_code) AS rk, count(*) OVER () AS total FROM per)
SELECT CAST(max(total) AS BIGINT) AS machines, CAST(sum(n) AS BIGINT) AS events, CAST(min(n) AS BIGINT) AS min_events,
       CAST(max(n) AS BIGINT) AS max_events,
       {_r('100 * ' + _ratio('sum(n) FILTER (WHERE rk <= ceil(total * 0.2))', 'sum(n)'), 1)} AS top20_share_pct
FROM ranked"""),
    "mode_rate_by_segment": q(" " + " UNION ALL ".join(f"""
SELECT a.criticality, '{code}' AS mode_code, count(*) AS readings, count(*) FILTER (WHERE f.{col}) AS flagged,
       {_r('100 * ' + _ratio(f'count(*) FILTER (WHERE f.{col})', 'count(*)'), 2)} AS flagged_pct
FROM fct_readings f JOIN dim_asset a USING (asset_sk) GROUP BY a.criticality"""
        for code, col in [("TWF", "flag_twf"), ("OSF", "flag_osf"), ("HDF", "flag_hdf"), ("PWF", "flag_pwf"), ("RNF", "flag_rnf")])),
    "segment_share_by_sector": q(f"""
, g AS (
  SELECT l.sector_name, a.criticality, count(*) AS n
  FROM fct_readings f JOIN dim_asset a USING (asset_sk) JOIN dim_location l USING (location_sk)
  GROUP BY l.sector_name, a.criticality
)
SELECT sector_name, criticality, n AS readings,
       {_r('100 * ' + _ratio('n', 'sum(n) OVER (PARTITION BY sector_name)'), 2)} AS share_pct
FROM g"""),
    "hash_key": q("""
SELECT asset_code, valid_from,
       sha256(length(CAST(asset_code AS VARCHAR)) || ':' || asset_code || '|' || length(valid_from) || ':' || valid_from) AS version_hash
FROM (SELECT asset_code, strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f') AS valid_from FROM history)"""),
    "open_close_quarters": q("""
SELECT o.year AS open_year, o.quarter AS open_quarter, c.year AS close_year, c.quarter AS close_quarter,
       count(*) AS orders
FROM fct_work_orders w JOIN dim_date o ON o.date_sk = w.opened_date_sk
JOIN dim_date c ON c.date_sk = w.concluded_date_sk
GROUP BY o.year, o.quarter, c.year, c.quarter"""),
    "scalar_matrix": q(f"""
SELECT order_no, CAST(NULL AS VARCHAR) AS no_date,
       strftime(coalesce(concluded_at, opened_at), {TS}) AS concluded_or_opened,
       CAST(nullif(duration_hours, 0) AS DOUBLE) AS hours_or_null,
       strftime(least(opened_at, concluded_at), {TS}) AS first_event,
       strftime(greatest(opened_at, concluded_at), {TS}) AS last_event,
       CASE order_type WHEN 'corrective' THEN 'C' ELSE 'P' END AS type_code,
       CASE WHEN total_cost < 1000 THEN 'low' WHEN total_cost < 100000 THEN 'mid' ELSE 'high' END AS cost_band,
       {_r(_SPAN, 4)} AS span_days,
       CAST(floor({_SPAN} - CAST(duration_hours AS DOUBLE) / 24.0) AS BIGINT) AS wait_days,
       {_r('total_cost / 1000', 1)} AS cost_k,
       {_r('CAST(duration_hours AS DOUBLE) * 2 * pi() / 60', 2)} AS hours_angle,
       (order_type = 'corrective' AND concluded_at > opened_at) AS corrective_concluded_later
FROM fct_work_orders"""),
    "filter_matrix": q("""
SELECT 'changes_up_to_cutoff' AS predicate, count(*) FILTER (WHERE changed_on <= DATE '1998-01-01') AS rows FROM changes
UNION ALL SELECT 'failing_readings', count(*) FILTER (WHERE has_failure) FROM fct_readings
UNION ALL SELECT 'healthy_readings', count(*) FILTER (WHERE NOT has_failure) FROM fct_readings
UNION ALL SELECT 'failure_criterion', count(*) FILTER (WHERE declared_failure OR flag_twf OR flag_osf OR flag_hdf OR flag_pwf OR flag_rnf) FROM fct_readings
UNION ALL SELECT 'not_1998_q3', count(*) FILTER (WHERE NOT (year(read_at) = 1998 AND quarter(read_at) = 3)) FROM fct_readings
UNION ALL SELECT 'quantity_out_of_band', count(*) FILTER (WHERE quantity < 5 OR quantity > 45) FROM fct_readings
UNION ALL SELECT 'low_discount_and_tax', count(*) FILTER (WHERE discount < 0.02 AND tax < 0.02) FROM fct_readings
UNION ALL SELECT 'orders_known_machine', count(*) FILTER (WHERE asset_sk <> -1) FROM fct_work_orders
UNION ALL SELECT 'corrective_orders', count(*) FILTER (WHERE order_type = 'corrective') FROM fct_work_orders
UNION ALL SELECT 'not_concluded', count(*) FILTER (WHERE concluded_at IS NULL) FROM fct_work_orders
UNION ALL SELECT 'concluded', count(*) FILTER (WHERE concluded_at IS NOT NULL) FROM fct_work_orders
UNION ALL SELECT 'conclusion_not_before_opening', count(*) FILTER (WHERE concluded_at IS NULL OR concluded_at >= opened_at) FROM fct_work_orders
UNION ALL SELECT 'versions_overlapping_window', count(*) FILTER (WHERE greatest(valid_from, w_start) < least(valid_to, w_end))
  FROM dim_asset CROSS JOIN obs"""),
    "basic_aggregates": q(f"""
SELECT a.criticality, l.sector_name, count(*) AS orders, {_r('sum(o.total_cost)', 2)} AS total_cost,
       strftime(min(o.opened_at), {TS}) AS first_opened, strftime(max(o.opened_at), {TS}) AS last_opened,
       {_r(_ratio('sum(o.duration_hours)', 'count(*)'), 3)} AS mean_hours
FROM fct_work_orders o JOIN dim_asset a USING (asset_sk) JOIN dim_location l USING (location_sk)
GROUP BY a.criticality, l.sector_name"""),
    "csv_text_load": """
SELECT c_custkey, c_name, c_nationkey, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS c_acctbal, c_mktsegment,
       c_name || ', said "' || c_mktsegment || '"' || chr(10) || 'and left' AS note, CASE c_custkey % 7 WHEN 0 THEN '=' WHEN 1 THEN 'null' ELSE '=x' END AS mark,
       true AS has_source_file, true AS has_load_time
FROM customer""",
    "event_readings": q(f"""
SELECT e.event_id, coalesce(v.asset_sk, -1) AS asset_sk, CAST(strftime(e.event_at, '%Y%m%d') AS INTEGER) AS date_sk,
       {shift_case('e.event_at')} AS shift_sk, e.event_type, e.is_failure
FROM events_x e LEFT JOIN dim_asset v ON v.asset_sk <> -1 AND v.asset_code = e.asset_code
     AND e.event_at >= v.valid_from AND e.event_at < v.valid_to"""),
})


def _history_sql(changes: str) -> str:
    """The history of some of the changes (a condition on ``all_changes``)."""
    whole = SQL["scd2_history"]
    log, rest = whole.split("changes AS (", 1)[1].split("\n),", 1)
    return whole.split("changes AS (", 1)[0] + f"all_changes AS ({log}\n),\nchanges AS (SELECT * FROM all_changes WHERE {changes}\n)," + rest


SQL["scd2_sink_batches"] = SQL["scd2_sink_compacted"] = SQL["scd2_history"]
SQL["scd2_sink_late_ignored"] = _history_sql(
    f"changed_on >= DATE '{LATE_CUTS[0]}' OR asset_code NOT IN (SELECT asset_code FROM all_changes WHERE changed_on >= DATE '{LATE_CUTS[0]}')")
SQL["scd2_sink_before_last"] = _history_sql(f"changed_on < DATE '{SINK_CUTS[1]}'")
SQL["readings_refreshed"] = q(f"""
SELECT CAST(year(read_at) * 4 + quarter(read_at) AS INTEGER) AS quarter_no, count(*) AS n_readings, CAST(CAST(sum(quantity) AS DECIMAL(22,2)) AS VARCHAR) AS quantity,
       CAST(CAST(sum(price) AS DECIMAL(22,2)) AS VARCHAR) AS price, bool_or((reading_order, reading_line) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE year(l_shipdate) = {CORRECTED_YEAR})) AS rebuilt
FROM readings GROUP BY 1""")
SQL["sorted_tables"] = q("""
SELECT 'dim_asset by key' AS table_name, count(*) AS n, CAST(0 AS BIGINT) AS misplaced, CAST(min(asset_sk) AS VARCHAR) AS first_key, CAST(max(asset_sk) AS VARCHAR) AS last_key
FROM dim_asset
UNION ALL SELECT 'dim_technician by key', count(*), 0, CAST(min(technician_sk) AS VARCHAR), CAST(max(technician_sk) AS VARCHAR) FROM dim_technician
UNION ALL SELECT 'dim_date by date', count(*), 0, min(date), max(date) FROM (""" + SQL["date_dimension"] + """) WHERE date_sk <> -1
UNION ALL SELECT 'change days by date', count(DISTINCT changed_on), 0, CAST(min(changed_on) AS VARCHAR), CAST(max(changed_on) AS VARCHAR) FROM changes""")
SQL["mutation_checks"] = """
SELECT * FROM (VALUES ('duplicate lines stay', 'unique_reading', (SELECT count(*) > count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem)),
  ('failures without a flag are dropped', 'failing_reading_without_mode_row', true), ('orders without failure count as failures', 'no_not_applicable_failure', true),
  ('versions never end', 'no_overlapping_versions', true), ('only the current version is kept', 'history_complete', true),
  ('origins never failed', 'corrective_comes_from_failure', true)) AS t(mutation, test, noticed)"""
SQL["csv_manifest_load"] = """
SELECT 'customer' AS table_name, count(*) AS loaded_rows, 'c_custkey' AS first_column, count(*) FILTER (WHERE c_custkey % 7 = 0) AS empty_fields,
       sum(c_custkey)::BIGINT AS key_sum, true AS audited
FROM customer
UNION ALL SELECT 'supplier', count(*), 's_suppkey', count(*) FILTER (WHERE s_suppkey % 7 = 0), sum(s_suppkey)::BIGINT, true FROM supplier"""
SQL["row_order"] = f"""
SELECT 'mtbf_nulls_last' AS report, row_number() OVER (ORDER BY mtbf_days ASC NULLS LAST, criticality) - 1 AS row_no, criticality AS label
FROM ({SQL['mtbf_mttr_by_segment']})
UNION ALL
SELECT 'downtime_descending', row_number() OVER (ORDER BY downtime_hours DESC NULLS LAST) - 1, mode_code FROM ({SQL['mode_by_downtime']})
UNION ALL
SELECT 'quarters_mixed', row_number() OVER (ORDER BY orders DESC, close_year ASC NULLS LAST, close_quarter ASC NULLS LAST, open_year DESC, open_quarter DESC) - 1,
       open_year || '/' || open_quarter || '/' || coalesce(CAST(close_year AS VARCHAR), '-') || '/' || coalesce(CAST(close_quarter AS VARCHAR), '-')
FROM ({SQL['open_close_quarters']})"""


def spark_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    build = SPARK[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalize(build(Star.shared(spark, sf_dir)))

    run.__name__ = name
    return run
