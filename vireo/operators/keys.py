"""Surrogate keys and unknown members."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo import constants as C


def dense_key(df: DataFrame, order: Sequence[str], name: str, start: int = 1, ranged: bool = False) -> DataFrame:
    """Dense integer key 1..n over a total order, without a single partition.

    ``row_number() over (order by ...)`` funnels every row through one task.
    Here the rows are range-partitioned and sorted on ``order``, each row is
    tagged with its partition and a per-partition running id, and the tagged
    frame is checkpointed to the session's reliable checkpoint folder (so the
    ids are fixed even if a task is re-run on another executor). One row per
    partition then gives the starting offset of each partition; that table is
    bounded by the number of partitions and is the only thing broadcast.
    The result equals ``row_number()`` over the same order when the order is
    total. ``ranged`` says that the rows are range-partitioned on the first
    columns of ``order`` already, which saves the shuffle.
    """
    order = list(order)
    placed = df if ranged else df.repartitionByRange(*order)
    tagged = (placed.sortWithinPartitions(*order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    per_part = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_base"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_pid", "_base",
                              F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_base") + start).cast("bigint"))
                  .drop("_pid", "_mid", "_base", "_off"))


def row_number_key(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Single-partition form of the dense key; only for bounded dimensions."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def hash_key(cols: Sequence[str]) -> "F.Column":
    """Stable content key for incremental builds: SHA-256 (hex) of the natural key.

    Every part is written as its length, a colon and its text, a null as ``~``,
    so no two different keys are joined to the same text. It needs no global
    ordering and gives the same value in any engine, so keys survive rebuilds
    and can be checked externally."""
    def part(c: str):
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))
    return F.sha2(F.concat_ws("|", *[part(c) for c in cols]), 256)


def with_unknown_member(dim: DataFrame, sk: str, defaults: Mapping[str, object]) -> DataFrame:
    """Append the unknown member (key -1) to a dimension.

    Columns missing from ``defaults`` get a typed NULL; every literal is cast
    to the dimension's column type so the union keeps the schema.
    """
    types = dict(dim.dtypes)
    values = {sk: C.UNKNOWN_SK, **defaults}
    row = dim.sparkSession.range(1).select(
        *[F.lit(values.get(c)).cast(types[c]).alias(c) for c in dim.columns])
    return row.unionByName(dim)
