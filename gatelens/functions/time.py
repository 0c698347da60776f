"""Instants, days, buckets and rolling windows.

Times are epoch milliseconds at the API.  Instants never go through the session
time zone; only *days* depend on a zone, and that zone is always a parameter.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
DAY_MS = 86_400_000
DAY_FORMAT = "yyyy.MM.dd"


@dataclass(frozen=True)
class TimeRange:
    """Closed interval of epoch milliseconds: both ends belong to it."""

    start: int
    end: int


def to_millis(moment: datetime | int) -> int:
    """Epoch milliseconds of a datetime (naive ones are UTC) or of millis."""
    if isinstance(moment, int):
        return moment
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return (moment - EPOCH) // timedelta(milliseconds=1)


def current_millis() -> int:
    return to_millis(datetime.now(timezone.utc))


def minutes(n: int) -> int:
    return n * 60_000


def hours(n: int) -> int:
    return n * 3_600_000


def days(n: int) -> int:
    return n * DAY_MS


def between(start: datetime | int, end: datetime | int) -> TimeRange:
    return TimeRange(to_millis(start), to_millis(end))


def last_days(n: int, now: datetime | int | None = None) -> TimeRange:
    end = current_millis() if now is None else to_millis(now)
    return TimeRange(end - days(n), end)


def local_time(ms: int, zone: str = "UTC") -> datetime:
    return (EPOCH + timedelta(milliseconds=ms)).astimezone(ZoneInfo(zone))


def month_before(ms: int, zone: str = "UTC") -> int:
    """One calendar month earlier; a day the month lacks becomes its last day."""
    moment = local_time(ms, zone)
    year, month = (moment.year, moment.month - 1) if moment.month > 1 else (moment.year - 1, 12)
    day = min(moment.day, calendar.monthrange(year, month)[1])
    return to_millis(moment.replace(year=year, month=month, day=day))


def day_text(day: date) -> str:
    return day.strftime("%Y.%m.%d")


def day_span(time_range: TimeRange, zone: str = "UTC") -> tuple[date, date]:
    """First and last local day a range touches."""
    return local_time(time_range.start, zone).date(), local_time(time_range.end, zone).date()


def days_of(time_range: TimeRange, zone: str = "UTC") -> list[str]:
    """Every day a range touches, both ends included."""
    first, last = day_span(time_range, zone)
    return [day_text(first + timedelta(days=n)) for n in range((last - first).days + 1)]


def start_of_day(day: date, zone: str = "UTC") -> int:
    return to_millis(datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(zone)))


# --- columns -----------------------------------------------------------------


def instant(ms: int) -> Column:
    """A foldable TIMESTAMP, so comparisons with it reach the Parquet scan."""
    return F.timestamp_millis(F.lit(ms))


def in_time_range(time_range: TimeRange, column: str = "ts") -> Column:
    """Both ends included at millisecond resolution.

    The raw column is compared (no truncation), which keeps the pushdown; the
    upper bound is exclusive one millisecond later and therefore the same test.
    """
    ts = F.col(column)
    return (ts >= instant(time_range.start)) & (ts < instant(time_range.end + 1))


def local_date(ts: Column, zone: str = "UTC") -> Column:
    """DATE of an instant in a zone, whatever the session zone is."""
    shifted = ts if zone == "UTC" else F.from_utc_timestamp(ts, zone)
    return F.date_from_unix_date(F.floor(F.unix_millis(shifted) / DAY_MS).cast("int"))


def day_of(ts: Column, zone: str = "UTC") -> Column:
    """Day text (``2017.05.22``) of an instant."""
    return F.date_format(local_date(ts, zone), DAY_FORMAT)


def day_sequence(start: Column, end: Column, zone: str = "UTC") -> Column:
    """Array of the day texts from one instant to another, both included."""
    span = F.sequence(local_date(start, zone), local_date(end, zone))
    return F.transform(span, lambda day: F.date_format(day, DAY_FORMAT))


def bucket_start(ms: Column, interval: int) -> Column:
    """Start of the fixed-width epoch bucket; right before 1970 as well."""
    return ms - F.pmod(ms, F.lit(interval).cast("bigint"))


def bucket_floor(ms: int, interval: int) -> int:
    """The same on the driver, for axis ends."""
    return ms - ms % interval


def rolling_windows(now: int) -> list[tuple[str, int]]:
    """The five windows that end at no bound, oldest start first."""
    return [
        ("1M", month_before(now)),
        ("1w", now - days(7)),
        ("1d", now - days(1)),
        ("1h", now - hours(1)),
        ("1m", now - minutes(1)),
    ]


# --- whole-day restriction ---------------------------------------------------


def restrict_days(docs: DataFrame, first: date, last: date, zone: str = "UTC") -> DataFrame:
    """Whole days ``first..last``, both included.

    A day-partitioned table is pruned on its partition column.  A frame without
    ``day`` is cut at the days' edges on ``ts``, which the scan can push down.
    """
    if "day" in docs.columns:
        return docs.where(F.col("day").between(day_text(first), day_text(last)))
    begin = start_of_day(first, zone)
    end = start_of_day(last + timedelta(days=1), zone)
    return docs.where((F.col("ts") >= instant(begin)) & (F.col("ts") < instant(end)))


def restrict_last_month(docs: DataFrame, now: int, zone: str = "UTC") -> DataFrame:
    """Whole days from one calendar month ago to today."""
    first, last = day_span(TimeRange(month_before(now, zone), now), zone)
    return restrict_days(docs, first, last, zone)


def restrict_today(docs: DataFrame, now: int, zone: str = "UTC") -> DataFrame:
    first, last = day_span(TimeRange(now, now), zone)
    return restrict_days(docs, first, last, zone)


def restrict_named_days(docs: DataFrame, names: list[str], zone: str = "UTC") -> DataFrame:
    """Explicitly named days; absent ones match nothing.

    A day-partitioned table is pruned on its partition column. A frame without ``day`` is cut at the named days' edges
    on ``ts``, runs of days being one stretch.
    """
    if "day" in docs.columns:
        return docs.where(F.col("day").isin(list(names)))
    stretches: list[list[date]] = []
    for day in sorted({datetime.strptime(name, "%Y.%m.%d").date() for name in names}):
        if stretches and day == stretches[-1][1] + timedelta(days=1):
            stretches[-1][1] = day
        else:
            stretches.append([day, day])
    inside = F.lit(False)
    for first, last in stretches:
        begin, end = start_of_day(first, zone), start_of_day(last + timedelta(days=1), zone)
        inside = inside | ((F.col("ts") >= instant(begin)) & (F.col("ts") < instant(end)))
    return docs.where(inside)
