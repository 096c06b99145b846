"""Column expressions on dates and hours."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def day(value: dt.date | str) -> Column:
    """A DATE literal from a date or an ISO string."""
    return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(value))


def moment(value: dt.datetime | str) -> Column:
    """A zone-less timestamp literal that no time zone setting shifts."""
    return F.lit(str(value)).cast("timestamp_ntz")


def literal(value) -> Column:
    return moment(value) if isinstance(value, dt.datetime) else F.lit(value)


def today_in(zone: str = "Asia/Tokyo") -> Column:
    """The current date on the wall clock of ``zone``, whatever the session zone is."""
    return F.convert_timezone(None, F.lit(zone), F.localtimestamp()).cast("date")


def current_day(spark: SparkSession, zone: str = "Asia/Tokyo") -> dt.date:
    """``today_in`` as a value, to be passed as ``as_of``."""
    return spark.range(1).select(today_in(zone).alias("day")).first()["day"]


def days_before(as_of: dt.date | str, n: int) -> Column:
    return F.date_sub(day(as_of), n)


def in_last_days(column: Column | str, as_of: dt.date | str, n: int) -> Column:
    """``column >= as_of - n`` with no upper bound."""
    return F.col(column) >= days_before(as_of, n) if isinstance(column, str) else column >= days_before(as_of, n)


def hour_sin(hour: Column) -> Column:
    return F.sin(F.lit(2 * math.pi) * hour / F.lit(24))


def hour_cos(hour: Column) -> Column:
    return F.cos(F.lit(2 * math.pi) * hour / F.lit(24))


def two_digits(number: Column) -> Column:
    """Zero-pad to two characters; longer text stays whole (``lpad`` would cut it)."""
    text = number.cast("string")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def hour_timestamp(date: Column, hour: Column) -> Column:
    """Zone-less timestamp of an hour of a day."""
    return F.make_timestamp_ntz(F.year(date), F.month(date), F.dayofmonth(date), hour, F.lit(0), F.lit(0))


def month_key(date: Column) -> Column:
    return F.date_format(date, "yyyyMM")


def elapsed_seconds(started: Column, completed: Column) -> Column:
    """Seconds with microsecond precision; expects columns, not arbitrary expressions."""
    return F.timestamp_diff("MICROSECOND", started, completed) / F.lit(1000000.0)
