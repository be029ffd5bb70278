"""Calendar and interval expressions, all JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vireo import constants as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_key(ts, unknown: int | None = None) -> Column:
    """Integer YYYYMMDD key of a date or timestamp; NULL maps to ``unknown``."""
    c = _c(ts)
    k = F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)
    return k if unknown is None else F.coalesce(k, F.lit(unknown))


def day_of_week0(d) -> Column:
    """Day of week with 0 = Sunday (Spark's dayofweek gives 1 = Sunday)."""
    return F.dayofweek(_c(d)) - 1


def month_name(d) -> Column:
    names = F.array(*[F.lit(n) for n in C.MONTH_NAMES])
    return F.element_at(names, F.month(_c(d)))


def day_name(d) -> Column:
    names = F.array(*[F.lit(n) for n in C.DAY_NAMES])
    return F.element_at(names, F.dayofweek(_c(d)))


def season_south(d) -> Column:
    """Southern-hemisphere season by fixed month-day boundaries."""
    mmdd = F.date_format(_c(d), "MMdd").cast("int")
    summer, autumn, winter, spring = C.SEASON_NAMES
    return (F.when((mmdd >= C.SEASON_SUMMER_FROM) | (mmdd <= C.SEASON_SUMMER_TO), summer)
            .when(mmdd <= C.SEASON_AUTUMN_TO, autumn)
            .when(mmdd <= C.SEASON_WINTER_TO, winter)
            .otherwise(spring))


def days_between(start, end) -> Column:
    """(end - start) in fractional days, as double.

    Spark has no ``extract(epoch from interval)``; microsecond difference
    divided by a day of microseconds is exact for any realistic span.
    """
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(86400e6)


def clipped_days(valid_from, valid_to, window_start, window_end) -> Column:
    """Days of [valid_from, valid_to) that fall inside [start, end].

    Clipping happens before the subtraction, so sentinel bounds never enter
    the arithmetic.
    """
    return days_between(F.greatest(_c(valid_from), _c(window_start)),
                        F.least(_c(valid_to), _c(window_end)))


def overlaps(valid_from, valid_to, window_start, window_end) -> Column:
    return F.greatest(_c(valid_from), _c(window_start)) < F.least(_c(valid_to), _c(window_end))


def quarter_index(d) -> Column:
    """Integer period index year*4 + quarter; the successor crosses years."""
    return F.year(_c(d)) * 4 + F.quarter(_c(d))


def shift_of_hour(ts) -> Column:
    """Shift key of a timestamp from the fixed shift table."""
    h = F.hour(_c(ts))
    expr = None
    for sk, _name, start, end in C.SHIFTS:
        cond = (h >= start) & (h < end) if start < end else (h >= start) | (h < end)
        expr = F.when(cond, F.lit(sk)) if expr is None else expr.when(cond, F.lit(sk))
    return expr
