"""Which months' folders a load has to look at."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.sources.sectioned import read_files


def months_for_days(as_of: dt.date, days: int) -> list[str]:
    """``yyyyMM`` of yesterday and of each of the ``days`` dates before it."""
    yesterday = as_of - dt.timedelta(days=1)
    return sorted({(yesterday - dt.timedelta(days=i)).strftime("%Y%m") for i in range(days + 1)})


def month_of(yyyymmdd: str, as_of: dt.date) -> str:
    """Month of a date text; a date that is not over yet is refused."""
    try:
        if len(yyyymmdd) != 8:
            raise ValueError
        day = dt.datetime.strptime(yyyymmdd, "%Y%m%d").date()
    except ValueError:
        raise ValueError(f"expected a date as YYYYMMDD: {yyyymmdd}") from None
    if day >= as_of:
        raise ValueError(f"only dates before {as_of} are complete: {yyyymmdd}")
    return day.strftime("%Y%m")


def month_bounds(yyyymm: str) -> tuple[dt.date, dt.date]:
    """First and last day of a ``YYYYMM`` month."""
    if len(yyyymm) != 6 or not yyyymm.isdigit() or not 1 <= int(yyyymm[4:]) <= 12:
        raise ValueError(f"expected a month as YYYYMM: {yyyymm}")
    first = dt.date(int(yyyymm[:4]), int(yyyymm[4:]), 1)
    return first, (first + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)


def in_months(df: DataFrame, date: str, months: list[str]) -> DataFrame:
    """Rows of the given months, as date ranges that reach the file scan."""
    hit = F.lit(False)
    for first, last in map(month_bounds, months):
        hit = hit | ((F.col(date) >= F.lit(first)) & (F.col(date) < F.lit(last + dt.timedelta(days=1))))
    return df.where(hit)


def read_recent_files(
    spark: SparkSession, root: str, as_of: dt.date, days: int, pattern: str = "*_power_usage.csv", times: bool = False
) -> DataFrame:
    """Files of the months in question under ``root/yyyyMM``; other months are not listed.

    Months without a folder are passed over; Spark fails if none has one.
    """
    months = ",".join(months_for_days(as_of, days))
    return read_files(spark, f"{root.rstrip('/')}/{{{months}}}", pattern, times)
