"""Join helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# About 80 MB of 400-byte rows: the most a hinted broadcast may hold.
BROADCAST_ROWS = 200_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Counts at most ``max_rows + 1`` rows of ``df``. Runs that small job now."""
    return df.limit(max_rows + 1).count() <= max_rows


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of ``df`` if the count allows it.

    A larger side is returned unhinted, and Spark joins it by shuffle. Meant for stored
    calendars and date mappings, where the count reads little.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df


def on_days(fact: DataFrame, cal: DataFrame, wanted: Column, date: str = "date") -> DataFrame:
    """Rows of a fact whose day's calendar row passes a filter, with the calendar's columns.

    The filtered calendar is broadcast if it is small, and its dates prune the partitions of a fact
    that is stored by date before they are read. Spark does this for filters that it takes to be selective; a
    comparison is one, a bare flag is not, hence the lower limit that every date passes.
    """
    return fact.join(small_side(cal.where(wanted & (F.col(date) >= F.lit("0001-01-01").cast("date")))), date)
