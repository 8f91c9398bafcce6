"""Time columns: parsing, tumbling buckets, spans. Event time is TIMESTAMP_NTZ in UTC."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1)
# A date must lead the text; without this Spark reads a bare "12:30" as today at 12:30.
_LEADING_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_timestamp(text: Column | str) -> Column:
    """ISO-8601 text to UTC event time; text that is not a time gives NULL."""
    text = as_column(text)
    return F.when(text.rlike(_LEADING_DATE), text.try_cast("timestamp")).cast("timestamp_ntz")


def event_time(df: DataFrame, col: str) -> Column:
    """Event time from a column that is text or already a timestamp."""
    if dict(df.dtypes)[col] == "string":
        return parse_timestamp(col)
    return F.col(col).cast("timestamp_ntz")


def time_literal(value: datetime | str | Column | None) -> Column:
    """`as_of` and bounds as an expression; None is the query's start time."""
    if value is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def seconds_interval(seconds: float) -> Column:
    return F.lit(timedelta(microseconds=round(seconds * 1_000_000)))


def days_interval(days: int) -> Column:
    return F.lit(timedelta(days=days))


def window_start(ts: Column | str, minutes: int = 10) -> Column:
    """Start of the bucket of `minutes` within the hour; NULL stays NULL, unlike `F.window`."""
    ts = as_column(ts)
    into = F.minute(ts) % F.lit(minutes)
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), into, F.extract(F.lit("SECOND"), ts))


def micros_since_epoch(ts: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), as_column(ts))


def whole_days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from start to end, cut toward zero, so it may be negative."""
    return F.extract(F.lit("DAY"), as_column(end) - as_column(start)).cast("bigint")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    micros = F.timestamp_diff("MICROSECOND", as_column(start), as_column(end))
    return micros / F.lit(1e6) / F.lit(60.0)
