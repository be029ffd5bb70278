"""Facts of the star (K9-K11): keys resolved at load time, never NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo import constants as C
from vireo.functions import temporal as T
from vireo.operators.joins import lookup, unknown_if_null, valid_at_join
from vireo.operators.unpivot import unpivot_flags
from vireo.plans.staging import MODE_FLAGS


def _asset_version(events: DataFrame, dim_asset: DataFrame, ts: str) -> DataFrame:
    """asset_sk and line code of the version valid at ``ts``."""
    versions = dim_asset.filter(F.col("asset_sk") != C.UNKNOWN_SK).select(
        F.col("asset_code").alias("_v_code"), F.col("asset_sk").alias("_v_sk"),
        F.col("line_code").alias("_v_line"), "valid_from", "valid_to")
    j = valid_at_join(events, versions, "asset_code", "_v_code", ts)
    return (j.withColumn("asset_sk", unknown_if_null("_v_sk"))
             .withColumn("line_at_event", unknown_if_null("_v_line"))
             .drop("_v_code", "_v_sk", "_v_line", "valid_from", "valid_to"))


def fct_readings(readings: DataFrame, dim_asset: DataFrame, dim_location: DataFrame) -> DataFrame:
    """One row per reading (K9): version key, location, date and shift keys,
    raw and derived measures, failure flags."""
    r = _asset_version(readings, dim_asset, "read_at")
    r = lookup(r, dim_location, "line_at_event", "line_code", "location_sk")
    net = F.col("price") * (F.lit(1) - F.col("discount"))
    return r.select(
        "asset_sk", "location_sk",
        T.date_key("read_at").alias("date_sk"),
        T.shift_of_hour("read_at").alias("shift_sk"),
        "reading_order", "reading_line", "part_key", "read_at",
        "quantity", "price", "discount", "tax",
        net.cast("decimal(16,4)").alias("net_price"),
        F.round(net * (F.lit(1) + F.col("tax")), 2).cast("decimal(14,2)").alias("charge"),
        *[c for _, c in MODE_FLAGS],
        (F.col("declared_failure") | F.col("any_mode")).alias("has_failure"),
        F.col("declared_failure").alias("declared_failure"))


def fct_failures(fact_readings: DataFrame, dim_mode: DataFrame) -> DataFrame:
    """Factless (reading, mode) fact (K10): unpivot of the flags of failing
    readings; failing readings without a flag get INDETERMINATE (J6)."""
    failing = fact_readings.filter("has_failure")
    long = unpivot_flags(failing, MODE_FLAGS, "mode_code", none_code=C.INDETERMINATE)
    modes = F.broadcast(dim_mode.select("failure_mode_sk", "mode_code"))
    return long.join(modes, "mode_code", "inner").select(
        "asset_sk", "location_sk", "date_sk", "shift_sk", "failure_mode_sk",
        "reading_order", "reading_line", "read_at")


def fct_work_orders(work_orders: DataFrame, dim_asset: DataFrame, dim_location: DataFrame,
                    dim_technician: DataFrame, dim_mode: DataFrame) -> DataFrame:
    """One row per work order (K11): version at opening, location of that
    version (unknown machine -> unknown line -> -1), technician, mode, two
    date keys (role-playing), measures."""
    w = _asset_version(work_orders, dim_asset, "opened_at")
    w = lookup(w, dim_location, "line_at_event", "line_code", "location_sk")
    w = lookup(w, dim_technician, "technician_id", "technician_id", "technician_sk")
    modes = F.broadcast(dim_mode.select("failure_mode_sk", F.col("mode_code").alias("_mode")))
    w = w.join(modes, F.coalesce(F.col("failure_mode"), F.lit(C.NOT_APPLICABLE)) == F.col("_mode"), "inner")
    return w.select(
        "asset_sk", "location_sk", "technician_sk", "failure_mode_sk",
        T.date_key("opened_at").alias("opened_date_sk"),
        T.date_key("concluded_at", unknown=C.UNKNOWN_SK).alias("concluded_date_sk"),
        "order_no", "order_type", "origin_line", "opened_at", "concluded_at",
        "duration_hours", "labour_cost", "parts_cost",
        (F.col("labour_cost") + F.col("parts_cost")).alias("total_cost"))
