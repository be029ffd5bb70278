"""Type-2 history from a long-form change log.

The change log has one row per (key, date, field, new value). The history is
built in one Spark job instead of one snapshot run per cut-off date:

* the log is reduced to (key, date) grain with one conditional ``max`` per
  field (the pivot); this aggregate combines map-side, and afterwards a key
  has at most one row per calendar day, so even a key holding a third of all
  log rows leaves a bounded group for the per-key window that follows;
* one sort per key serves two windows: one carries the last non-null value of
  every field forward, one finds the start of the next version with ``lead``;
* a version opens at every distinct change date after the key's base date,
  plus one baseline version at the base date. A change dated on or before
  the base date opens nothing but its value still shows in later versions;
  two changes on one day make one version; a change to the value already
  held still opens a version; ties on (key, field, date) keep the larger
  value.

``scd2_apply`` is the incremental form (one snapshot run); applying it over
``cutoff_dates`` reproduces ``scd2_history`` exactly (tested).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo import constants as C


def filter_cutoff(log: DataFrame, date: str, cutoff) -> DataFrame:
    """Changes up to and including ``cutoff``."""
    return log.filter(F.col(date) <= F.lit(cutoff).cast("date"))


def pivot_changes(log: DataFrame, key: str, date: str, field: str, value: str,
                  fields: Sequence[str]) -> DataFrame:
    """Long to wide at (key, date) grain by conditional max."""
    return log.groupBy(key, date).agg(
        *[F.max(F.when(F.col(field) == F.lit(f), F.col(value))).alias(f) for f in fields])


def state_as_of(base: DataFrame, log: DataFrame, cutoff, *, key: str, base_date: str,
                date: str, field: str, value: str, fields: Sequence[str],
                updated_at: str = "updated_at") -> DataFrame:
    """State of every key as of ``cutoff`` (H1).

    Last value per (key, field) up to the cut-off (latest date, larger value
    on ties), pivoted, coalesced over the base row; ``updated_at`` is the
    last applied change date, else the base date.
    """
    recent = filter_cutoff(log, date, cutoff)
    latest = (recent.groupBy(key, field)
                    .agg(F.max(F.struct(F.col(date).alias("d"), F.col(value).alias("v"))).alias("_l")))
    applied = latest.groupBy(key).agg(
        *[F.max(F.when(F.col(field) == F.lit(f), F.col("_l.v"))).alias(f"_new_{f}") for f in fields],
        F.max("_l.d").alias("_last_change"))
    out = base.join(applied, key, "left")
    for f in fields:
        out = out.withColumn(f, F.coalesce(F.col(f"_new_{f}"), F.col(f).cast("string")))
    out = out.withColumn(updated_at, F.coalesce(F.col("_last_change"), F.col(base_date)).cast("timestamp_ntz"))
    return out.drop(*[f"_new_{f}" for f in fields], "_last_change")


def cutoff_dates(log: DataFrame, date: str) -> DataFrame:
    """Day before the first change, union the distinct change dates (H3, U4)."""
    first = log.agg(F.date_sub(F.min(date), 1).alias("cutoff"))
    dates = log.select(F.col(date).alias("cutoff"))
    return first.union(dates).distinct().orderBy("cutoff")


def scd2_history(base: DataFrame, log: DataFrame, *, key: str, base_date: str, date: str,
                 field: str, value: str, fields: Sequence[str], cutoff=None) -> DataFrame:
    """All versions of every key in one pass (H2).

    ``base`` holds one row per key with ``base_date`` and the initial value of
    every field in ``fields``; the output has the base columns with the
    fields as of each version, plus ``updated_at``, ``valid_from`` and
    ``valid_to`` (NULL for the current version).
    """
    if cutoff is not None:
        log = filter_cutoff(log, date, cutoff)
    fields = list(fields)
    wide = pivot_changes(log, key, date, field, value, fields).withColumn("_is_base", F.lit(False))
    base_rows = base.select(key, F.lit(None).cast("date").alias(date),
                            *[F.lit(None).cast("string").alias(f) for f in fields],
                            F.lit(True).alias("_is_base"))
    base_vals = base.select(key, *[F.col(c).alias(f"_b_{c}") for c in base.columns if c != key])
    rows = (wide.unionByName(base_rows)
                .join(base_vals, key, "inner")
                .withColumn("_d", F.coalesce(F.col(date), F.col(f"_b_{base_date}")))
                .withColumn("_day", F.unix_date(F.col("_d"))))
    w = Window.partitionBy(key).orderBy("_day", "_is_base")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = rows.select(
        "*",
        *[F.last(F.col(f), ignorenulls=True).over(upto).alias(f"_run_{f}") for f in fields])
    # an opened version has a day of its own, so the next one ends it; the rows are sorted for it already
    opened = carried.filter(F.col("_is_base") | (F.col("_d") > F.col(f"_b_{base_date}")))
    versions = opened.withColumn("_next", F.lead("_d").over(Window.partitionBy(key).orderBy("_day")))
    out_cols = []
    for c in base.columns:
        if c == key:
            out_cols.append(F.col(key))
        elif c in fields:
            out_cols.append(F.when(F.col("_is_base"), F.col(f"_b_{c}").cast("string"))
                             .otherwise(F.coalesce(F.col(f"_run_{c}"), F.col(f"_b_{c}").cast("string")))
                             .alias(c))
        else:
            out_cols.append(F.col(f"_b_{c}").alias(c))
    ts = F.col("_d").cast("timestamp_ntz")
    return versions.select(*out_cols, ts.alias("updated_at"), ts.alias("valid_from"),
                           F.col("_next").cast("timestamp_ntz").alias("valid_to"))


def scd2_apply(target: DataFrame | None, state: DataFrame, *, key: str,
               updated_at: str = "updated_at") -> DataFrame:
    """One snapshot run with the timestamp strategy.

    A key whose ``updated_at`` is newer than its current version closes that
    version at the new ``updated_at`` and opens a new one; an unseen key
    opens its first version; older or equal rows are ignored. ``target`` is
    ``None`` for the first run. Closed versions pass through untouched, so
    the full outer join only touches the current row of each key.
    """
    opened_cols = [c for c in state.columns]
    if target is None:
        return state.select(*opened_cols, F.col(updated_at).alias("valid_from"),
                            F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    cols = target.columns
    history = target.filter(F.col("valid_to").isNotNull())
    current = target.filter(F.col("valid_to").isNull())
    t = current.select(*[F.col(c).alias(f"_t_{c}") for c in cols])
    s = state.select(*[F.col(c).alias(f"_s_{c}") for c in opened_cols])
    j = t.join(s, F.col(f"_t_{key}") == F.col(f"_s_{key}"), "full")
    has_t = F.col(f"_t_{key}").isNotNull()
    has_s = F.col(f"_s_{key}").isNotNull()
    newer = has_s & (~has_t | (F.col(f"_s_{updated_at}") > F.col(f"_t_{updated_at}")))
    kept = j.filter(has_t).select(
        *[(F.when(newer, F.col(f"_s_{updated_at}")).otherwise(F.col("_t_valid_to")).alias(c)
           if c == "valid_to" else F.col(f"_t_{c}").alias(c)) for c in cols])
    opened = j.filter(newer).select(
        *[(F.col(f"_s_{updated_at}").alias(c) if c == "valid_from"
           else F.lit(None).cast("timestamp_ntz").alias(c) if c == "valid_to"
           else F.col(f"_s_{c}").alias(c)) for c in cols])
    return history.unionByName(kept).unionByName(opened)


def dress_scd2(history: DataFrame, *, key: str, sk: str, version: str = "version",
               sk_fn=None) -> DataFrame:
    """History as a dimension.

    Version number per key, first version opened at BEGIN_OF_TIME, open end
    closed at END_OF_TIME, current flag, and a dense surrogate key over
    (key, valid_from). One range shuffle on the key serves the version number
    and the dense key; ``sk_fn(df, order, name)`` builds the key in another way.
    """
    from vireo.operators.keys import dense_key
    w = Window.partitionBy(key).orderBy("valid_from")
    numbered = history.repartitionByRange(key).withColumn(version, F.row_number().over(w))
    order = [key, "valid_from"]
    keyed = sk_fn(numbered, order, sk) if sk_fn else dense_key(numbered, order, sk, ranged=True)
    return (keyed
            .withColumn("is_current", F.col("valid_to").isNull())
            .withColumn("valid_from", F.when(F.col(version) == 1, F.lit(C.BEGIN_OF_TIME).cast("timestamp_ntz"))
                        .otherwise(F.col("valid_from")))
            .withColumn("valid_to", F.coalesce(F.col("valid_to"), F.lit(C.END_OF_TIME).cast("timestamp_ntz"))))


def history_summary(history: DataFrame, key: str) -> DataFrame:
    """Versions, keys, current versions and keys with a past."""
    return history.agg(
        F.count(F.lit(1)).alias("versions"),
        F.countDistinct(key).alias("keys"),
        F.count(F.when(F.col("valid_to").isNull(), 1)).alias("current_versions"),
        F.countDistinct(F.when(F.col("valid_to").isNotNull(), F.col(key))).alias("keys_with_past"))
