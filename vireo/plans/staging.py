"""Staging: the driver tables typed and shaped as maintenance sources.

The driver's TPC-H-like tables stand in for the maintenance sources:

* machine (asset)      <- ``customer``: code c_custkey, criticality
  c_mktsegment, production line c_nationkey, state 'operating', installed
  1994-12-01, or 1996-06-01 for customers with a negative balance;
* change log           <- ``orders`` by priority: 1-URGENT reclassifies the
  segment, 2-HIGH transfers to another line, 3-MEDIUM marks a refurbishment,
  4-NOT SPECIFIED relocates to another line, 5-LOW reviews the segment; dated
  o_orderdate;
* reading              <- deduplicated ``lineitem`` joined to its order
  (time l_shipdate, machine = the order's customer), with five failure flags
  and a declared-failure flag; the random one never counts as declared;
* work order           <- ``orders``: status F is corrective, others
  preventive; opened o_orderdate; concluded at the last shipment of its
  lines (NULL when it has none); hours, parts and labour cost from its lines;
* technician           <- ``supplier`` (only non-negative balances are in the
  technician dimension, the rest become orphan references);
* location hierarchy   <- ``nation`` + ``region``.

Every function is a lazy projection over the sources; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo import constants as C
from vireo.operators.dedup import keep_first
from vireo.operators.unpivot import dominant_code
from vireo.sources.tables import Sources

HISTORY_FIELDS = ["criticality", "line_code", "state"]
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def stg_assets(src: Sources) -> DataFrame:
    c = src["customer"]
    return c.select(
        F.col("c_custkey").alias("asset_code"),
        F.col("c_mktsegment").alias("criticality"),
        F.col("c_nationkey").cast("int").alias("line_code"),
        F.lit(C.STATE_OPERATING).alias("state"),
        F.when(F.col("c_acctbal") < 0, F.lit(C.LATE_INSTALLED_ON))
         .otherwise(F.lit(C.DEFAULT_INSTALLED_ON)).alias("installed_on"))


def stg_changes(src: Sources) -> DataFrame:
    """Long-form change log (asset_code, changed_on, field, new_value, reason)."""
    o = src["orders"]
    prio = F.col("o_orderpriority")
    fld = None
    why = None
    for p, f, r in C.CHANGE_RULES:
        fld = F.when(prio == p, F.lit(f)) if fld is None else fld.when(prio == p, F.lit(f))
        why = F.when(prio == p, F.lit(r)) if why is None else why.when(prio == p, F.lit(r))
    segments = F.array(*[F.lit(s) for s in C.SEGMENTS])
    new_value = (F.when(fld == "criticality",
                        F.element_at(segments, (F.pmod(F.col("o_orderkey"), F.lit(len(C.SEGMENTS))) + 1).cast("int")))
                  .when(fld == "line_code", F.pmod(F.col("o_orderkey"), F.lit(C.N_NATIONS)).cast("string"))
                  .otherwise(F.lit(C.STATE_REFURBISHED)))
    return (o.filter(prio.isin([p for p, _, _ in C.CHANGE_RULES]))
             .select(F.col("o_custkey").alias("asset_code"),
                     F.col("o_orderdate").cast("date").alias("changed_on"),
                     fld.alias("field"), new_value.alias("new_value"), why.alias("reason")))


def stg_lineitem(src: Sources) -> DataFrame:
    """lineitem deduplicated on (l_orderkey, l_linenumber)."""
    return keep_first(src["lineitem"], LINE_KEY, LINE_ORDER)


def order_lines(lineitem: DataFrame) -> DataFrame:
    """The lines that name an order, deduplicated like ``stg_lineitem``; the lines
    of an order lie in one partition, so the join with orders moves them no second time."""
    return keep_first(lineitem.where(F.col(LINE_KEY[0]).isNotNull()).repartition(LINE_KEY[0]), LINE_KEY, LINE_ORDER)


def _line_flags(li: DataFrame) -> DataFrame:
    q = F.col("l_quantity").cast("decimal(12,2)")
    t = F.col("l_tax").cast("decimal(4,2)")
    random = F.col("l_partkey") % C.RNF_PART_MODULUS == C.RNF_PART_REMAINDER
    return li.select(
        "*",
        (F.col("l_returnflag") == "R").alias("flag_twf"),
        (t >= tax_limit("l_linestatus")).alias("flag_osf"),
        (q > F.lit(C.HDF_QUANTITY_ABOVE)).alias("flag_hdf"),
        # the source marked this one in binary floats; decimals would mark other lines
        (F.col("l_discount").cast("double") - F.col("l_tax").cast("double") >= F.lit(float(C.PWF_SPREAD_FROM))).alias("flag_pwf"),
        random.alias("flag_rnf"),
        ((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "A") & ~random).alias("declared_failure"))


def tax_limit(status: str):
    """The tax limit of a line status (null for an unknown one)."""
    out = None
    for value, limit in C.OSF_TAX_FROM.items():
        hit, then = F.col(status) == value, F.lit(limit).cast("decimal(4,2)")
        out = F.when(hit, then) if out is None else out.when(hit, then)
    return out


MODE_FLAGS = C.MODE_FLAGS


def stg_readings(src: Sources, lines: DataFrame | None = None, carried: Sequence[str] = ()) -> DataFrame:
    """One reading per deduplicated line, with its machine and failure flags (and ``carried`` columns of lines or orders)."""
    lines = lines if lines is not None else order_lines(src["lineitem"])
    o = src["orders"].select("o_orderkey", "o_custkey", *[c for c in carried if c in src["orders"].columns])
    li = _line_flags(lines)
    any_mode = reduce(or_, [F.coalesce(F.col(c), F.lit(False)) for _, c in MODE_FLAGS])
    return (li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
              .select(F.col("l_orderkey").alias("reading_order"),
                      F.col("l_linenumber").alias("reading_line"),
                      F.col("l_shipdate").alias("read_at"),
                      F.col("o_custkey").alias("asset_code"),
                      F.col("l_partkey").alias("part_key"),
                      F.col("l_suppkey").alias("supplier_key"),
                      F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
                      F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
                      F.col("l_discount").cast("decimal(4,2)").alias("discount"),
                      F.col("l_tax").cast("decimal(4,2)").alias("tax"),
                      "l_returnflag", "l_linestatus",
                      *[c for _, c in MODE_FLAGS],
                      "declared_failure", any_mode.alias("any_mode"), *carried))


def stg_suppliers(src: Sources) -> DataFrame:
    """All suppliers with their hourly rate (P17 lookup source)."""
    s = src["supplier"]
    rate = (F.lit(C.RATE_BASE).cast("decimal(8,2)")
            + F.abs(F.col("s_acctbal").cast("decimal(12,2)")) * F.lit(C.RATE_FACTOR).cast("decimal(6,3)"))
    return s.select(F.col("s_suppkey").alias("technician_id"), F.col("s_name").alias("name"),
                    F.col("s_nationkey").cast("int").alias("nation_key"),
                    F.col("s_acctbal").alias("balance"),
                    rate.cast("decimal(12,5)").alias("hourly_rate"))


def stg_work_orders(src: Sources, readings: DataFrame) -> DataFrame:
    """One work order per order, costs from its lines."""
    # price first, then the smaller line, nulls least: one number, as a struct would have the lines sorted before they are added up
    cents = F.coalesce((F.col("price") * 100).cast("decimal(14,0)"), F.lit(-10 ** 12).cast("decimal(14,0)"))
    dearest = cents * F.lit(2 ** 33).cast("decimal(10,0)") - F.coalesce(F.col("reading_line").cast("long"), F.lit(2 ** 32))
    per_order = readings.groupBy(F.col("reading_order").alias("order_no")).agg(
        F.max("read_at").alias("concluded_at"),
        F.sum("quantity").alias("_qty"),
        F.min_by("supplier_key", "reading_line").alias("technician_id"),
        F.sum(F.col("price") * (F.lit(1) - F.col("discount"))).alias("_parts"),
        *[F.bool_or(c).alias(c) for _, c in MODE_FLAGS],
        # the line an order names as its origin is its dearest (first among equals), failing or not
        F.max_by("reading_line", dearest).alias("_origin"))
    o = src["orders"].select(
        F.col("o_orderkey").alias("order_no"), F.col("o_custkey").alias("asset_code"),
        F.when(F.col("o_orderstatus") == "F", F.lit(C.ORDER_CORRECTIVE))
         .otherwise(F.lit(C.ORDER_PREVENTIVE)).alias("order_type"),
        F.col("o_orderdate").alias("opened_at"))
    rates = stg_suppliers(src).select("technician_id", "hourly_rate")
    corrective = F.col("order_type") == C.ORDER_CORRECTIVE
    hours = F.coalesce(F.col("_qty") * F.lit(C.HOURS_PER_UNIT).cast("decimal(3,2)"), F.lit(0)).cast("decimal(18,2)")
    wo = o.join(per_order, "order_no", "left").join(rates, "technician_id", "left")
    mode = dominant_code([(code, F.coalesce(F.col(c), F.lit(False))) for code, c in MODE_FLAGS], C.INDETERMINATE)
    return wo.select(
        "order_no", "asset_code", "order_type",
        F.when(corrective, mode).alias("failure_mode"),
        F.when(corrective, F.col("_origin")).alias("origin_line"),
        "opened_at", "concluded_at", "technician_id",
        hours.alias("duration_hours"),
        F.coalesce(F.round(hours * F.col("hourly_rate"), 2), F.lit(0)).cast("decimal(28,2)").alias("labour_cost"),
        F.coalesce(F.round(F.col("_parts"), 2), F.lit(0)).cast("decimal(28,2)").alias("parts_cost"))


def stg_events(src: Sources) -> DataFrame:
    e = src["events"]
    return e.select(F.col("event_id"), F.col("ts").alias("event_at"), F.col("user_id").alias("asset_code"),
                    F.col("event_type"), F.col("value"),
                    (F.col("event_type") == "error").alias("is_failure"))
