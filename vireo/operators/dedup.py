"""Keep-first deduplication (W1 + X1).

``keep_first`` keeps, for each key, the row that sorts first by ``order``
(then by every other column, so the order is total and exact duplicates
collapse to one identical row). It is ``row_number() over (partition by key
order by ...) = 1``, which Spark plans with a *partial* ``WindowGroupLimit``
before the shuffle: every map task already cuts each key to its first row,
so a key holding a third of all rows crosses the network as one row per
task instead of landing whole in one reducer. ``keep_first_agg`` is the
aggregate form (``min`` of a struct led by the order columns), also
map-side combined, kept for the equivalence test.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first_agg(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys`` via ``min(struct(order..., rest...))``."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = order + rest
    packed = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return agg.select(*keys, *[F.col(f"_first.f{i}").alias(c) for i, c in enumerate(fields)]) \
              .select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the first by ``order``, then by every other column."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in list(order) + rest])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in excess of one per key (the measure the uniqueness test reports)."""
    return (df.groupBy(*keys).count().filter("count > 1")
              .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("excess_rows"),
                   F.count(F.lit(1)).alias("duplicated_keys")))
