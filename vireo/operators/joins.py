"""Join shapes of a star schema.

No join here forces a physical strategy on data that grows: Catalyst and AQE
pick broadcast when the measured size of a side is under
``spark.sql.autoBroadcastJoinThreshold`` and sort-merge otherwise, and AQE
splits a skewed partition of the event side (a key holding a third of the
rows) into several tasks. ``broadcast()`` is only written for sides whose
size is fixed by construction (shift, failure-mode, one-row windows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vireo import constants as C
from vireo.functions.temporal import quarter_index


def valid_at_join(events: DataFrame, dim: DataFrame, event_key: str, dim_key: str, ts: str,
                  valid_from: str = "valid_from", valid_to: str = "valid_to",
                  how: str = "left") -> DataFrame:
    """Attach to every event the dimension version valid at the event time.

    Versions are repeated for every quarter they cover (clipped to the time
    range of the events, which two scalar subqueries read from their time
    column) and joined on natural key and quarter, with
    ``valid_from <= ts < valid_to`` as the residual condition. So an event is
    tested against the versions of one quarter, at most one a day, however
    many its key has had, and the events of a hot key spread over its
    quarters. Because the versions of a key partition the whole timeline with
    sentinel bounds, each event matches exactly one version and the left join
    never fans out.
    """
    first, last = (events.select(F.col(ts).alias("_t")).agg(f("_t")).scalar() for f in (F.min, F.max))
    covered = (dim.where((F.col(valid_from) <= last) & (F.col(valid_to) > first))
               .withColumn("_opens", F.greatest(quarter_index(valid_from), quarter_index(first)))
               .withColumn("_closes", F.least(quarter_index(valid_to), quarter_index(last)))
               .withColumn("_quarter", F.explode(F.sequence("_opens", "_closes"))).drop("_opens", "_closes"))
    placed = events.withColumn("_at_quarter", quarter_index(ts))
    cond = ((placed[event_key] == covered[dim_key]) & (F.col("_at_quarter") == F.col("_quarter"))
            & (placed[ts] >= covered[valid_from]) & (placed[ts] < covered[valid_to]))
    return placed.join(covered, cond, how).drop("_at_quarter", "_quarter")


def unknown_if_null(col: str | Column, unknown: int = C.UNKNOWN_SK) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(unknown))


def lookup(fact: DataFrame, dim: DataFrame, fact_col: str | Column, dim_col: str,
           sk: str) -> DataFrame:
    """Left lookup of a surrogate key by natural code; misses become -1. How
    to join is left to the measured size of the dimension."""
    key = F.col(fact_col) if isinstance(fact_col, str) else fact_col
    right = dim.select(F.col(dim_col).alias("_lk_code"), F.col(sk).alias("_lk_sk"))
    out = fact.join(right, key == F.col("_lk_code"), "left")
    return out.withColumn(sk, unknown_if_null("_lk_sk")).drop("_lk_code", "_lk_sk")
