"""Time expressions on ``timestamp_ntz`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_SECOND = 1_000_000


def month_start(ts: Column) -> Column:
    """First instant of the month, kept as NTZ (``date_trunc`` would widen it)."""
    return F.trunc(ts, "MM").cast("timestamp_ntz")


def add_months(ts: Column, months: int | Column) -> Column:
    return F.add_months(ts, months).cast("timestamp_ntz")


def next_month_start(ts: Column) -> Column:
    """First of the month after ``ts``: the first month whose start is strictly later."""
    return add_months(F.trunc(ts, "MM"), 1)


def micros_between(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", earlier, later)


def days_between(later: Column, earlier: Column) -> Column:
    """Elapsed time in fractional days."""
    return micros_between(later, earlier) / F.lit(float(MICROS_PER_DAY))


def whole_days(later: Column, earlier: Column) -> Column:
    """Difference of the two calendar dates."""
    return F.datediff(F.to_date(later), F.to_date(earlier))


def later_date(a: Column, b: Column) -> Column:
    """Whether ``a`` falls on a later calendar date than ``b``."""
    return F.to_date(a) > F.to_date(b)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def monday_based_weekday(ts: Column) -> Column:
    return F.weekday(ts)


def ntz(value) -> Column:
    """Literal NTZ timestamp from a date, datetime or ISO string."""
    return F.lit(str(value)).cast("timestamp_ntz")


def exact_days_sums(days: Column, when: Column | None = None) -> tuple[Column, Column, Column]:
    """Three aggregates from which a mean duration can be divided once, at the end.

    A float sum depends on the order rows arrive in. Durations here are whole microseconds, so
    each is split into seconds and left-over microseconds and summed as ``bigint``: exact under
    any partitioning, and good for some 10^12 rows of a month each before it could overflow.
    Returns (sum of seconds, sum of left-over microseconds, count of non-null values).
    """
    micros = F.round(days * F.lit(float(MICROS_PER_DAY))).cast("bigint")
    if when is not None:
        micros = F.when(when, micros)
    rest = F.pmod(micros, F.lit(MICROS_PER_SECOND))
    seconds = ((micros - rest) / F.lit(MICROS_PER_SECOND)).cast("bigint")
    return F.sum(seconds), F.sum(rest), F.count(micros)


def mean_days(seconds: Column, micros: Column, n: Column) -> Column:
    """Mean duration in days from the three sums; null where nothing was counted."""
    total = seconds.cast("double") + micros.cast("double") / F.lit(float(MICROS_PER_SECOND))
    return total / F.lit(86_400.0) / F.nullif(n, F.lit(0)).cast("double")
