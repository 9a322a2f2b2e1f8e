"""Dates from epoch seconds.

Everything here gives the same answer whatever the session time zone is: UTC
days come from arithmetic, local days from an explicit zone name.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400
PACIFIC = "America/Los_Angeles"

# Days one cadence step stands for in the compliance check.
CADENCE_DAYS = {"weekly": 7, "monthly": 30, "yearly": 365}


# Years 1 to 9999, in which dates can be written; other seconds are no date.
FIRST_SECOND, LAST_SECOND = -62135596800, 253402300799


def within(ts: Column) -> Column:
    """NULL for seconds outside the years that dates can have."""
    return F.when(ts.between(FIRST_SECOND, LAST_SECOND), ts)


def utc_date(ts: Column) -> Column:
    return F.date_from_unix_date(F.floor(within(ts) / DAY).cast("int"))


def local_seconds(ts: Column, tz: str) -> Column:
    """Wall-clock seconds of an instant in ``tz``."""
    return F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(within(ts)), tz))


def local_date(ts: Column, tz: str) -> Column:
    return utc_date(local_seconds(ts, tz))


def iso(date: Column) -> Column:
    """YYYY-MM-DD text of a date."""
    return date.cast("string")


def utc_day(ts: Column) -> Column:
    return iso(utc_date(ts))


def year_text(ts: Column) -> Column:
    return F.substring(utc_day(ts), 1, 4)


def month_text(ts: Column) -> Column:
    return F.substring(utc_day(ts), 6, 2)


def year_month_text(ts: Column) -> Column:
    return F.substring(utc_day(ts), 1, 7)


def clock_text(ts: Column, tz: str = "UTC") -> Column:
    """``YYYY-MM-DD HH:MM:SS`` in ``tz``; NULL when the value is no number."""
    wall = F.timestamp_add("SECOND", local_seconds(ts.try_cast("bigint"), tz), _ntz_origin())
    return wall.cast("string")


def add_months_rolling(date: Column, months: Column) -> Column:
    """Month shift where a day past the month's end runs into the next month."""
    first = F.trunc(date, "MM")
    return F.date_add(F.add_months(first, months.cast("int")), F.dayofmonth(date) - 1)


def cadence_add(date: Column, frequency: Column, interval: Column) -> Column:
    """The date one cadence step later.

    NULL for an unknown frequency, a missing interval and a negative one.
    """
    n = F.when(interval >= 0, interval)
    return (
        F.when(frequency == "daily", F.date_add(date, n.cast("int")))
        .when(frequency == "weekly", F.date_add(date, (n * 7).cast("int")))
        .when(frequency == "monthly", add_months_rolling(date, n))
        .when(frequency == "yearly", add_months_rolling(date, n * 12))
    )


def cadence_days(frequency: Column, interval: Column) -> Column:
    out = F.lit(None).cast("bigint")
    for name, days in CADENCE_DAYS.items():
        out = F.when(frequency == name, interval * days).otherwise(out)
    return out


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("bigint")


def whole_days(seconds: Column) -> Column:
    """Full days in a span, cut toward zero on both sides of it."""
    return F.call_function("div", seconds, F.lit(DAY))


def day_start_epoch(date: Column) -> Column:
    """Epoch seconds of a date read as midnight UTC."""
    return F.unix_date(date).cast("bigint") * DAY


def epoch_of_ntz(column: Column) -> Column:
    """Epoch seconds of a zone-less timestamp read as UTC."""
    return F.timestamp_diff("SECOND", _ntz_origin(), column)


def _ntz_origin() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def year_start(year: int) -> int:
    return int(datetime(year, 1, 1, tzinfo=timezone.utc).timestamp())


def in_years(ts: Column, years: tuple[int, ...]) -> Column:
    """Epoch inside any of the years, as ranges a parquet scan can skip by."""
    spans: list[list[int]] = []
    for year in sorted(set(years)):
        if spans and spans[-1][1] == year:
            spans[-1][1] = year + 1
        else:
            spans.append([year, year + 1])
    test = F.lit(False)
    for start, end in spans:
        span = (ts >= year_start(start)) & (ts < year_start(end))
        test = span if len(spans) == 1 else (test | span)
    return test


def shift_months(as_of: int, months: int) -> int:
    """``as_of`` moved by calendar months, day overflow rolling on, time kept."""
    now = datetime.fromtimestamp(as_of, tz=timezone.utc)
    step = now.year * 12 + now.month - 1 + months
    first = now.replace(year=step // 12, month=step % 12 + 1, day=1)
    return int((first + timedelta(days=now.day - 1)).timestamp())
