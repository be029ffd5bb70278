"""Wide boolean flags to long rows in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def marked_codes(flags: Sequence[tuple[str, str | Column]]) -> Column:
    """Array of the codes whose flag is true, in the given order."""
    arr = F.array(*[F.when(c if isinstance(c, Column) else F.col(c), F.lit(code)) for code, c in flags])
    return F.filter(arr, lambda x: x.isNotNull())


def unpivot_flags(df: DataFrame, flags: Sequence[tuple[str, str | Column]], out: str,
                  none_code: str | None = None) -> DataFrame:
    """One row per true flag; rows with no flag get ``none_code`` (or vanish).

    A single ``explode`` over a filtered array replaces a union of one scan
    per flag: the input is read once and stays in one codegen stage.
    """
    codes = marked_codes(flags)
    if none_code is not None:
        codes = F.when(F.size(codes) == 0, F.array(F.lit(none_code))).otherwise(codes)
    return df.withColumn(out, F.explode(codes))


def dominant_code(flags: Sequence[tuple[str, str | Column]], none_code: str) -> Column:
    """First marked code in priority order, else ``none_code``."""
    return F.coalesce(*[F.when(c if isinstance(c, Column) else F.col(c), F.lit(code)) for code, c in flags],
                      F.lit(none_code))
