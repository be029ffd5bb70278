"""Dimensions of the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo import constants as C
from vireo.functions import temporal as T
from vireo.operators.history import dress_scd2, scd2_history
from vireo.operators.keys import dense_key, row_number_key, with_unknown_member
from vireo.plans.staging import HISTORY_FIELDS

ASSET_COLUMNS = ["asset_sk", "asset_code", "version", "criticality", "line_code", "state",
                 "installed_on", "valid_from", "valid_to", "is_current"]


def asset_history(assets: DataFrame, changes: DataFrame, cutoff=None) -> DataFrame:
    return scd2_history(assets, changes, key="asset_code", base_date="installed_on",
                        date="changed_on", field="field", value="new_value",
                        fields=HISTORY_FIELDS, cutoff=cutoff)


def dim_asset(history: DataFrame, sk_fn=None) -> DataFrame:
    dressed = dress_scd2(history, key="asset_code", sk="asset_sk", sk_fn=sk_fn)
    dim = dressed.select(
        "asset_sk", "asset_code", F.col("version").cast("int").alias("version"), "criticality",
        F.col("line_code").cast("int").alias("line_code"), "state", "installed_on",
        "valid_from", "valid_to", "is_current")
    return with_unknown_member(dim, "asset_sk", {
        "asset_code": C.UNKNOWN_SK, "version": 0, "criticality": C.UNKNOWN_LABEL,
        "line_code": C.UNKNOWN_SK, "state": C.UNKNOWN_LABEL, "installed_on": None,
        "valid_from": C.BEGIN_OF_TIME, "valid_to": C.END_OF_TIME, "is_current": True})


def dim_location(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Flattened plant > sector > line hierarchy (K7); 25 nations, bounded."""
    flat = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "inner").select(
        F.col("n_nationkey").cast("int").alias("line_code"),
        F.col("n_name").alias("line_name"),
        F.col("r_regionkey").cast("int").alias("sector_code"),
        F.col("r_name").alias("sector_name"),
        F.lit("main").alias("plant"))
    keyed = row_number_key(flat, ["line_code"], "location_sk")
    keyed = keyed.select("location_sk", "line_code", "line_name", "sector_code", "sector_name", "plant")
    return with_unknown_member(keyed, "location_sk", {
        "line_code": C.UNKNOWN_SK, "line_name": C.UNKNOWN_LABEL, "sector_code": C.UNKNOWN_SK,
        "sector_name": C.UNKNOWN_LABEL, "plant": C.UNKNOWN_LABEL})


def dim_technician(suppliers: DataFrame, sk_fn=None) -> DataFrame:
    """Technicians: suppliers with a non-negative balance (K8, SCD1).

    The unknown member has a NULL hourly rate, not 0.
    """
    sk_fn = sk_fn or dense_key
    techs = suppliers.filter(F.col("balance") >= 0).select("technician_id", "name", "nation_key", "hourly_rate")
    keyed = sk_fn(techs, ["technician_id"], "technician_sk")
    keyed = keyed.select("technician_sk", "technician_id", "name", "nation_key", "hourly_rate")
    return with_unknown_member(keyed, "technician_sk", {
        "technician_id": C.UNKNOWN_SK, "name": C.UNKNOWN_LABEL, "nation_key": C.UNKNOWN_SK})


def date_range_of(*cols: tuple[DataFrame, str]) -> DataFrame:
    """One row (start, end): Jan 1 of the first year to Dec 31 of the last."""
    parts = [df.agg(F.min(F.col(c).cast("date")).alias("lo"), F.max(F.col(c).cast("date")).alias("hi"))
             for df, c in cols]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(F.make_date(F.year(F.min("lo")), F.lit(1), F.lit(1)).alias("start"),
                 F.make_date(F.year(F.max("hi")), F.lit(12), F.lit(31)).alias("end"))


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day of the range plus the -1 'no date' row."""
    days = bounds.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("date"))
    d = F.col("date")
    dim = days.select(
        T.date_key(d).alias("date_sk"), d,
        F.year(d).alias("year"), F.month(d).alias("month"), F.quarter(d).alias("quarter"),
        F.dayofmonth(d).alias("day_of_month"), F.date_format(d, "yyyy-MM").alias("year_month"),
        T.month_name(d).alias("month_name"), T.day_of_week0(d).alias("day_of_week"),
        T.day_name(d).alias("day_name"), (T.day_of_week0(d) != 0).alias("is_workday"),
        T.season_south(d).alias("season"))
    return with_unknown_member(dim, "date_sk", {
        "year_month": C.UNKNOWN_LABEL, "month_name": C.UNKNOWN_LABEL, "day_name": C.UNKNOWN_LABEL,
        "season": C.UNKNOWN_LABEL})


def dim_shift(spark: SparkSession) -> DataFrame:
    """Inline VALUES relation (K6, S9); wraps midnight when end < start."""
    rows = [(sk, name, start, end) for sk, name, start, end in C.SHIFTS]
    df = spark.createDataFrame(rows, "shift_sk int, shift_name string, start_hour int, end_hour int")
    return df.withColumn("wraps_midnight", F.col("end_hour") < F.col("start_hour"))


def dim_failure_mode(spark: SparkSession) -> DataFrame:
    """Seed dimension with a declared key type."""
    return spark.createDataFrame(
        C.FAILURE_MODES, "failure_mode_sk int, mode_code string, mode_name string, origin string, description string")
