"""Which dates of a derived table depend on which dates of its sources.

The index is the lag mapping read backwards: a reading of a date is looked at by the date itself
and by every date that lags back to it. With a mapping that carries weekends
back, a Friday is so found by the weekend after it as well. One row per date and lag, so the
index is as small as the mapping; only dates come to the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dependency_index(mapping: DataFrame, lags: Sequence[str], date: str = "base_date") -> DataFrame:
    """``(source_date, target_date)``: each date, and each that lags back to it."""
    sources = F.array(F.col(date), *[F.col(c) for c in lags])
    pairs = mapping.select(F.explode(sources).alias("source_date"), F.col(date).alias("target_date"))
    return pairs.where("source_date IS NOT NULL AND target_date IS NOT NULL").distinct()


def dates_reached(index: DataFrame, changed: Iterable[dt.date]) -> list[dt.date]:
    """Dates of the derived table that change with these dates of the source.

    A changed date that the index does not know reaches itself.
    """
    days = sorted(set(changed))
    found = index.where(in_dates(F.col("source_date"), days)).select("target_date").distinct().collect()
    return sorted({r["target_date"] for r in found} | set(days))


def dates_needed(index: DataFrame, wanted: Iterable[dt.date]) -> list[dt.date]:
    """Dates of the source from which these dates of the derived table are made."""
    days = sorted(set(wanted))
    found = index.where(in_dates(F.col("target_date"), days)).select("source_date").distinct().collect()
    return sorted({r["source_date"] for r in found} | set(days))


def in_dates(date: Column, days: Iterable[dt.date]) -> Column:
    """Whether a date is one of these, as ranges: few terms, which prune partitions."""
    hit = F.lit(False)
    for first, last in stretches(days):
        hit = hit | (date == F.lit(first) if first == last else date.between(F.lit(first), F.lit(last)))
    return hit


def stretches(days: Iterable[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """First and last day of each unbroken run of days."""
    out: list[tuple[dt.date, dt.date]] = []
    for day in sorted(set(days)):
        if out and day - out[-1][1] == dt.timedelta(days=1):
            out[-1] = out[-1][0], day
        else:
            out.append((day, day))
    return out
