"""Rounding of report figures.

Money is summed in decimal; ratios of sums are doubles. Both are rounded
HALF_UP once at the end (PostgreSQL ``round(numeric)`` semantics), and the
rounded value is exposed as a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_out(x, scale: int) -> Column:
    """Round HALF_UP at ``scale`` and expose as double."""
    return F.round(_c(x).cast("decimal(38,10)"), scale).cast("double")
