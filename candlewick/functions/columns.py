"""Column expressions. None of them depends on the session time zone or ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_DAY = 86_400_000
# Floor under logarithms of prices and volumes.
LOG_FLOOR = 1e-12


def growth(now: Column, before: Column) -> Column:
    """Relative change; NULL when there is no base or the base is zero."""
    return F.try_divide(now, before) - 1


def floored_ln(value: Column) -> Column:
    """Natural logarithm with a floor under the value; NULL stays NULL."""
    return F.ln(F.when(value < LOG_FLOOR, LOG_FLOOR).otherwise(value))


def or_zero(value: Column) -> Column:
    """NULL and NaN become 0."""
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(0.0))


def z_score(value: Column, mean: Column, deviation: Column) -> Column:
    """Standard score, 0 where the deviation is zero or undefined."""
    return or_zero(F.try_divide(value - mean, F.nullif(deviation, F.lit(0.0))))


def utc_date(epoch_ms: Column) -> Column:
    """UTC calendar day of an epoch in milliseconds."""
    return F.date_from_unix_date(F.floor(epoch_ms / MS_PER_DAY).cast("int"))


def utc_clock(epoch_ms: Column) -> Column:
    """UTC wall-clock time (no zone) of an epoch in milliseconds."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    seconds = (epoch_ms / 1000).cast("decimal(18,6)")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def day_start_ms(day: Column) -> Column:
    """Epoch milliseconds of midnight UTC of a date."""
    return F.unix_date(day).cast("bigint") * MS_PER_DAY


def sorted_percentile(ordered: Column, size: Column, q: float) -> Column:
    """Linearly interpolated percentile of a sorted array with `size` > 0 elements."""
    rank = (size - 1) * F.lit(q)
    below = F.floor(rank).cast("int")
    low = F.element_at(ordered, below + 1)
    high = F.element_at(ordered, F.least(below + 2, size.cast("int")))
    return low + (rank - below) * (high - low)
