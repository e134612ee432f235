"""Calendar features of a wall-clock timestamp (no time zone anywhere)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inclusive hour ranges counted as rush hour when cleaning.
RUSH_RANGES = ((7, 9), (16, 18))
# Hours counted as rush hour by the time dimension.
DIMENSION_RUSH_HOURS = (7, 8, 16, 17, 18)
# The first and the last month of the lockdown period.
LOCKDOWN = ((2020, 3), (2020, 6))

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

MONTHS = (
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
    "November", "December",
)

_WALL_CLOCK = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(\.\d+)?$"


def parse_wall_clock(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with any fractional seconds cut off; NULL if malformed."""
    return F.when(text.rlike(_WALL_CLOCK), F.substring_index(text, ".", 1)).try_cast("timestamp_ntz")


def minutes_between(start: Column, end: Column, digits: int = 2) -> Column:
    """Signed minutes from ``start`` to ``end``; negative and very long spans are kept."""
    seconds = F.timestamp_diff("SECOND", start, end)
    return F.round(seconds.cast("decimal(18,0)") / F.lit(60), digits).cast(f"decimal(18,{digits})")


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")


def year_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "year")


def day_name(ts: Column, pad: bool = False) -> Column:
    """English weekday; ``pad`` fills it with blanks to nine characters."""
    name = _nth(WEEKDAYS, F.weekday(ts) + 1)
    return F.rpad(name, 9, " ") if pad else name


def month_name(ts: Column) -> Column:
    return _nth(MONTHS, F.month(ts))


def _nth(names: Iterable[str], place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), place)


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def in_hour_ranges(hour: Column, ranges: Iterable[tuple[int, int]] = RUSH_RANGES) -> Column:
    return reduce(or_, [hour.between(first, last) for first, last in ranges])


def in_period(ts: Column, first: tuple[int, int], last: tuple[int, int]) -> Column:
    """Whether ``ts`` lies in the whole months from ``first`` to ``last``."""
    month_number = F.year(ts) * 12 + F.month(ts)
    return month_number.between(first[0] * 12 + first[1], last[0] * 12 + last[1])


def years_between(ts: Column, first: int, last: int) -> Column:
    """Inclusive year range as a half-open range of ``ts``, so that file statistics prune."""
    start = F.lit(f"{first:04d}-01-01 00:00:00").cast("timestamp_ntz")
    stop = F.lit(f"{last + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (ts >= start) & (ts < stop)


def hour_on_reference_day(hour: Column) -> Column:
    """The hour as a timestamp on 2000-01-01, to share a column with month and year starts."""
    zero = F.lit(0)
    return F.make_timestamp_ntz(F.lit(2000), F.lit(1), F.lit(1), hour.cast("int"), zero, zero)
