"""Threshold-based data tests (Q1-Q9).

Rules are data. All row-level rules of one table (not_null,
accepted_values, accepted_range, expression_is_true) are evaluated in a
single aggregate pass with one conditional count each, instead of one job per
test; key rules (unique, unique combination, relationships) need their own
aggregate or anti join. Every test yields (test, table, violations, status)
where status compares the count with the warn/error thresholds: a known
baseline of dirty rows is a warning, growth beyond it is an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_KINDS = ("not_null", "accepted_values", "accepted_range", "expression_is_true")
REPORT_SCHEMA = "test string, table_name string, violations bigint, status string"


@dataclass(frozen=True)
class Rule:
    name: str
    table: str
    kind: str
    column: str | None = None
    columns: tuple = ()
    values: tuple = ()
    min_value: object = None
    max_value: object = None
    expr: str | None = None
    where: str | None = None
    to_table: str | None = None
    to_column: str | None = None
    nulls_are_violations: bool = False
    severity: str = "error"
    warn_after: int = 0
    error_after: int = 0
    extra: dict = field(default_factory=dict)


def violation_predicate(r: Rule):
    """Column predicate that is true on a violating row (row-level kinds).

    NULL passes accepted_values / accepted_range / expression_is_true, as in
    the generic tests; ``where`` restricts the rows a rule looks at.
    """
    c = F.col(r.column) if r.column else None
    if r.kind == "not_null":
        p = c.isNull()
    elif r.kind == "accepted_values":
        p = c.isNotNull() & ~c.isin(list(r.values))
    elif r.kind == "accepted_range":
        p = F.lit(False)
        if r.min_value is not None:
            p = p | (c < F.lit(r.min_value))
        if r.max_value is not None:
            p = p | (c > F.lit(r.max_value))
        p = c.isNotNull() & p
    elif r.kind == "expression_is_true":
        p = ~F.coalesce(F.expr(r.expr), F.lit(True))
    else:
        raise ValueError(f"not a row-level rule: {r.kind}")
    if r.where:
        p = F.expr(r.where) & p
    return p


def _status(n, r: Rule):
    warn = n > F.lit(r.warn_after)
    if r.severity == "error":
        return F.when(n > F.lit(r.error_after), "error").when(warn, "warn").otherwise("pass")
    return F.when(warn, "warn").otherwise("pass")


def _row_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    counts = df.agg(*[F.count(F.when(violation_predicate(r), 1)).alias(f"_r{i}")
                      for i, r in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(r.name).alias("test"), F.lit(r.table).alias("table_name"),
                              F.col(f"_r{i}").cast("bigint").alias("violations"),
                              _status(F.col(f"_r{i}"), r).alias("status"))
                     for i, r in enumerate(rules)])
    return counts.select(F.explode(rows).alias("t")).select("t.*")


def _key_rule(tables: Mapping[str, DataFrame], r: Rule) -> DataFrame:
    df = tables[r.table]
    if r.kind in ("unique", "unique_combination"):
        cols = list(r.columns) if r.columns else [r.column]
        src = df.select(*cols)
        if r.kind == "unique":
            src = src.filter(F.col(cols[0]).isNotNull())
        n = src.groupBy(*cols).count().filter("count > 1").agg(F.count(F.lit(1)).alias("n"))
    elif r.kind == "relationships":
        child = df.select(F.col(r.column).alias("_k"))
        if r.where:
            child = df.filter(F.expr(r.where)).select(F.col(r.column).alias("_k"))
        if not r.nulls_are_violations:
            child = child.filter(F.col("_k").isNotNull())
        # the child is counted per key before it moves, so a hot key is one row;
        # a NULL key never equals a parent key, so when NULLs count as
        # violations they simply survive the anti join
        keys = child.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
        parent = tables[r.to_table].select(F.col(r.to_column).alias("_p")).distinct()
        # (a left join, as the optimizer would move an anti join below the counts)
        n = keys.join(parent, F.col("_k") == F.col("_p"), "left").where("_p IS NULL").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))
    else:
        raise ValueError(f"unknown rule kind {r.kind}")
    return n.select(F.lit(r.name).alias("test"), F.lit(r.table).alias("table_name"),
                    F.col("n").cast("bigint").alias("violations"), _status(F.col("n"), r).alias("status"))


def evaluate(spark: SparkSession, tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """Report DataFrame with one row per rule (test, table_name, violations, status)."""
    parts: list[DataFrame] = []
    by_table: dict[str, list[Rule]] = {}
    for r in rules:
        if r.kind in ROW_KINDS:
            by_table.setdefault(r.table, []).append(r)
        else:
            parts.append(_key_rule(tables, r))
    for t, rs in by_table.items():
        parts.append(_row_rules(tables[t], rs))
    if not parts:
        return spark.createDataFrame([], REPORT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def singular(name: str, table: str, violations: DataFrame, *, severity: str = "error",
             warn_after: int = 0, error_after: int = 0) -> DataFrame:
    """Wrap a hand-written test (a DataFrame of violating rows) as a report row."""
    r = Rule(name=name, table=table, kind="singular", severity=severity,
             warn_after=warn_after, error_after=error_after)
    n = violations.agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.lit(name).alias("test"), F.lit(table).alias("table_name"),
                    F.col("n").cast("bigint").alias("violations"), _status(F.col("n"), r).alias("status"))
