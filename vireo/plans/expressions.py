"""Scalar expressions, predicates, plain aggregates, text load and event
readings over the whole star (F2-F7, F11-F15, F21, X2-X13, P15, A1-A4, A13,
S1-S6, J2 on events)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo import constants as C
from vireo.functions import temporal as T
from vireo.functions.numeric import round_out
from vireo.operators.joins import valid_at_join, unknown_if_null
from vireo.plans.star import Star
from vireo.session import scratch_path
from vireo.sources.text_csv import load_manifest, load_text_csv, loaded_tables, read_loaded


def scalar_matrix(s: Star) -> DataFrame:
    w = s.fct_work_orders
    span = T.days_between("opened_at", "concluded_at")
    return w.select(
        "order_no",
        F.lit(None).cast("date").alias("no_date"),
        F.coalesce("concluded_at", "opened_at").alias("concluded_or_opened"),
        F.nullif(F.col("duration_hours"), F.lit(0)).cast("double").alias("hours_or_null"),
        F.least("opened_at", "concluded_at").alias("first_event"),
        F.greatest("opened_at", "concluded_at").alias("last_event"),
        F.when(F.col("order_type") == C.ORDER_CORRECTIVE, "C").otherwise("P").alias("type_code"),
        F.when(F.col("total_cost") < 1000, "low").when(F.col("total_cost") < 100000, "mid")
         .otherwise("high").alias("cost_band"),
        round_out(span, 4).alias("span_days"),
        F.floor(span - F.col("duration_hours").cast("double") / F.lit(24.0)).alias("wait_days"),
        round_out(F.col("total_cost") / 1000, 1).alias("cost_k"),
        round_out(F.col("duration_hours").cast("double") * 2 * F.pi() / 60, 2).alias("hours_angle"),
        ((F.col("order_type") == C.ORDER_CORRECTIVE) & (F.col("concluded_at") > F.col("opened_at")))
        .alias("corrective_concluded_later"))


def filter_matrix(s: Star) -> DataFrame:
    """Rows matched by each predicate shape, one aggregate per source."""
    ch = s.changes.agg(F.count(F.when(F.col("changed_on") <= F.lit("1998-01-01").cast("date"), 1)).alias("n")) \
        .select(F.lit("changes_up_to_cutoff").alias("predicate"), "n")
    r = s.fct_readings
    rd = r.agg(
        F.count(F.when(F.col("has_failure"), 1)).alias("failing_readings"),
        F.count(F.when(~F.col("has_failure"), 1)).alias("healthy_readings"),
        F.count(F.when(F.greatest("declared_failure", *[c for _, c in C.MODE_FLAGS]), 1)).alias("failure_criterion"),
        F.count(F.when(~((F.year("read_at") == 1998) & (F.quarter("read_at") == 3)), 1)).alias("not_1998_q3"),
        F.count(F.when((F.col("quantity") < 5) | (F.col("quantity") > 45), 1)).alias("quantity_out_of_band"),
        F.count(F.when((F.col("discount") < 0.02) & (F.col("tax") < 0.02), 1)).alias("low_discount_and_tax"))
    w = s.fct_work_orders
    wo = w.agg(
        F.count(F.when(F.col("asset_sk") != C.UNKNOWN_SK, 1)).alias("orders_known_machine"),
        F.count(F.when(F.col("order_type") == C.ORDER_CORRECTIVE, 1)).alias("corrective_orders"),
        F.count(F.when(F.col("concluded_at").isNull(), 1)).alias("not_concluded"),
        F.count(F.when(F.col("concluded_at").isNotNull(), 1)).alias("concluded"),
        F.count(F.when(F.col("concluded_at").isNull() | (F.col("concluded_at") >= F.col("opened_at")), 1))
        .alias("conclusion_not_before_opening"))
    win = s.fct_readings.agg(F.min("read_at").alias("a"), F.max("read_at").alias("b"))
    ov = s.dim_asset.crossJoin(F.broadcast(win)).agg(
        F.count(F.when(T.overlaps("valid_from", "valid_to", "a", "b"), 1)).alias("n")) \
        .select(F.lit("versions_overlapping_window").alias("predicate"), "n")

    def long(df, names):
        return df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("predicate"), F.col(n).alias("n"))
                                             for n in names])).alias("x")).select("x.*")
    out = ch.unionByName(long(rd, rd.columns)).unionByName(long(wo, wo.columns)).unionByName(ov)
    return out.select("predicate", F.col("n").cast("bigint").alias("rows"))


def basic_aggregates(s: Star) -> DataFrame:
    """Orders by criticality and sector of the version at opening."""
    per = s.fct_work_orders.groupBy("asset_sk", "location_sk").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_cost").alias("cost"), F.sum("duration_hours").alias("hours"),
        F.min("opened_at").alias("first_opened"), F.max("opened_at").alias("last_opened"))
    j = per.join(s.dim_asset.select("asset_sk", "criticality"), "asset_sk") \
        .join(s.dim_location.select("location_sk", "sector_name"), "location_sk")
    return j.groupBy("criticality", "sector_name").agg(
        F.sum("n").cast("bigint").alias("orders"),
        round_out(F.sum("cost"), 2).alias("total_cost"),
        F.min("first_opened").alias("first_opened"), F.max("last_opened").alias("last_opened"),
        round_out(F.sum("hours").cast("double") / F.sum("n").cast("double"), 3).alias("mean_hours"))


def csv_text_load(s: Star) -> DataFrame:
    """Customers written as CSV text to the shared folder, loaded back as
    all-text columns with audit columns, then typed (S1-S4, P2, F1). A note
    has commas, quotes and a line break; a mark is empty, missing or a letter."""
    path = scratch_path(s.spark, "customer_csv")
    note = F.concat("c_name", F.lit(', said "'), "c_mktsegment", F.lit('"\nand left'))
    mark = F.when(F.col("c_custkey") % 7 == 0, "").when(F.col("c_custkey") % 7 != 1, "x")
    s.src["customer"].select("*", note.alias("note"), mark.alias("mark")).write.option("header", True).option("escape", '"').csv(path)
    raw = load_text_csv(s.spark, path)
    return raw.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
        F.col("c_nationkey").cast("int").alias("c_nationkey"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"), "c_mktsegment", "note", F.coalesce(F.concat(F.lit("="), "mark"), F.lit("null")).alias("mark"),
        F.col("_source_file").endswith(".csv").alias("has_source_file"),
        F.col("_loaded_at").isNotNull().alias("has_load_time"))


def csv_manifest_load(s: Star) -> DataFrame:
    """Two tables as CSV with a byte-order mark and empty fields, loaded all
    or nothing, and what arrived (S2, S3, S5, S6): rows of the commit, name
    of the first column, empty fields as nulls, a sum over the keys."""
    root, manifest, found = scratch_path(s.spark, "manifest"), {}, None
    tables = {"customer": ("c_custkey", "c_name"), "supplier": ("s_suppkey", "s_name")}
    for name, (key, label) in tables.items():
        manifest[name] = scratch_path(s.spark, f"{name}_bom_csv")
        rows = s.src[name].select(F.col(key).alias("\ufeff" + key), F.when(F.col(key) % 7 != 0, F.col(label)).alias(label))
        rows.write.option("header", True).option("emptyValue", "").csv(manifest[name])
    load_manifest(s.spark, manifest, root)
    counts = loaded_tables(s.spark, root).select(F.col("name").alias("table_name"), "loaded_rows")
    for name, (key, label) in tables.items():
        loaded = read_loaded(s.spark, root, name)
        part = loaded.agg(F.count(F.when(F.col(label).isNull(), 1)).alias("empty_fields"), F.sum(F.col(key).cast("bigint")).alias("key_sum"),
                          F.bool_and(F.col("_source_file").isNotNull() & F.col("_loaded_at").isNotNull()).alias("audited"))
        part = part.select(F.lit(name).alias("table_name"), F.lit(loaded.columns[0]).alias("first_column"), "*")
        found = part if found is None else found.unionByName(part)
    return counts.join(found, "table_name").select("table_name", "loaded_rows", "first_column", "empty_fields", "key_sum", "audited")


def event_readings(s: Star) -> DataFrame:
    """Events as readings: machine version at the event time (J2), date and
    shift keys, failure flag."""
    versions = s.dim_asset.filter(F.col("asset_sk") != C.UNKNOWN_SK).select(
        F.col("asset_code").alias("_code"), F.col("asset_sk").alias("_sk"), "valid_from", "valid_to")
    j = valid_at_join(s.events, versions, "asset_code", "_code", "event_at")
    return j.select("event_id", unknown_if_null("_sk").alias("asset_sk"),
                    T.date_key("event_at").alias("date_sk"), T.shift_of_hour("event_at").alias("shift_sk"),
                    "event_type", "is_failure")
