"""Days and periods of the business calendar, as epoch milliseconds.

Times are always arguments; nothing here depends on the session time zone.
"""

from datetime import date, datetime, timedelta, timezone
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, functions as F

from milepost.schemas import BUSINESS_ZONE

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def check_period(year: int, month: int) -> None:
    if not 1 <= month <= 12:
        raise ValueError(f"month must be 1 to 12, got {month}")
    date(year, month, 1)


def next_period(year: int, month: int) -> tuple[int, int]:
    check_period(year, month)
    return (year + 1, 1) if month == 12 else (year, month + 1)


def local_midnight_ms(day: date, zone: str = BUSINESS_ZONE) -> int:
    midnight = datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(zone))
    return int(midnight.timestamp()) * 1000


def period_start_ms(year: int, month: int = 1, zone: str = BUSINESS_ZONE) -> int:
    check_period(year, month)
    return local_midnight_ms(date(year, month, 1), zone)


def day_bounds_ms(day: date, zone: str = BUSINESS_ZONE) -> tuple[int, int]:
    """First millisecond of the day, and of the day after it."""
    return local_midnight_ms(day, zone), local_midnight_ms(day + timedelta(days=1), zone)


def in_range(column: Column, start: int, end: int) -> Column:
    """Half open, so the last fraction of a second is not lost."""
    return (column >= start) & (column < end)


def touching_periods(start_ms: int, end_ms: int) -> list[tuple[int, int]]:
    """(year, month) pairs that rows of this time range may carry, whatever zone
    their producer used for its calendar: the range is widened by a day."""
    first = datetime.fromtimestamp(start_ms / 1000, timezone.utc) - timedelta(days=1)
    last = datetime.fromtimestamp(end_ms / 1000, timezone.utc) + timedelta(days=1)
    year, month = first.year, first.month
    periods = []
    while (year, month) <= (last.year, last.month):
        periods.append((year, month))
        year, month = next_period(year, month)
    return periods


def rows_of_day(df: DataFrame, day: date, zone: str, prune: bool = True) -> DataFrame:
    """Rows whose TimeStamp (ms) falls on the local day.

    TimeStamp is no partition column, so with `prune` the Year/Month directories
    are narrowed as well. Leave it off for tables whose Year and Month are not
    the calendar of TimeStamp.
    """
    start, end = day_bounds_ms(day, zone)
    if prune:
        periods = [(F.col("Year") == y) & (F.col("Month") == m) for y, m in touching_periods(start, end)]
        df = df.filter(reduce(Column.__or__, periods))
    return df.filter(in_range(F.col("TimeStamp"), start, end))


def wall_clock(epoch_ms: Column, zone: str = BUSINESS_ZONE) -> Column:
    """Local date and time (without zone) of an epoch-millisecond column."""
    utc = F.timestamp_add("MILLISECOND", epoch_ms, F.expr(EPOCH))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def business_day(epoch_ms: Column, zone: str = BUSINESS_ZONE) -> Column:
    return wall_clock(epoch_ms, zone).cast("date")


def epoch_ms(utc: Column) -> Column:
    """Epoch milliseconds of a timestamp without zone that holds UTC.

    Taken apart by calendar fields: a difference to 1970 would go through the
    session time zone, one within a second does not depend on it.
    """
    days = F.unix_date(utc.cast("date")).cast("bigint")
    seconds = days * 86_400 + F.hour(utc) * 3_600 + F.minute(utc) * 60 + F.second(utc)
    fraction = F.timestamp_diff("MICROSECOND", F.date_trunc("SECOND", utc), utc)
    return (seconds * 1000 + F.floor(fraction / 1000)).cast("bigint")


def period_start(year: Column, month: Column, zone: str = BUSINESS_ZONE) -> Column:
    """Local midnight of the first day of a period, in epoch milliseconds."""
    zero = F.lit(0)
    local = F.make_timestamp_ntz(year, month, F.lit(1), zero, zero, zero)
    return epoch_ms(F.convert_timezone(F.lit(zone), F.lit("UTC"), local))
