"""Reports from stored partial results, one row per date, kept in step with their table.

For each date of a table the state holds counts of missing values and, per measured column, its
range, sum and a quantile sketch. All of these add up: a report of any range of dates merges
the rows of these dates and never reads the table. When dates of the table change, the state of
exactly these dates is made again, so a replaced day costs a day.

Sketches are KLL sketches of bounded size, which merge without growing; counts and ranges are
exact.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.operators.dependencies import in_dates
from hourloom.operators.profile import as_null_profile, as_verdict, null_flags, previous_day
from hourloom.operators.refresh import DatedTable

#: Size of a sketch: ranks are within about 0.4 percent.
SKETCH = 800


def state_of(
    df: DataFrame, columns: Sequence[str], measures: Sequence[str] = (), flag: str | None = None, date: str = "date"
) -> DataFrame:
    """One row per date, from one pass: each task passes on a row per date it has seen."""
    width = len(columns)
    rows = df.withColumn("__nulls", null_flags(columns))
    aggregates = [
        F.count("*").alias("rows"),
        F.sum("__nulls").cast("long").alias("missing_cells"),
        F.count_if(F.col("__nulls") > 0).alias("missing_rows"),
        F.count_if(F.col("__nulls") == width).alias("empty_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in columns],
    ]
    if flag is not None:
        aggregates.append(F.max(flag).alias("flag"))
    for c in measures:
        value = F.nanvl(F.col(c).cast("double"), F.lit(None))
        aggregates += [
            F.count(value).alias(f"{c}_n"),
            F.min(value).alias(f"{c}_min"),
            F.max(value).alias(f"{c}_max"),
            F.sum(value).alias(f"{c}_sum"),
            F.when(F.count(value) > 0, F.kll_sketch_agg_double(value, F.lit(SKETCH))).alias(f"{c}_sketch"),
        ]
    return rows.groupBy(F.col(date).alias("date")).agg(*aggregates)


@dataclass
class DailyState:
    """The state of ``source`` in a table of its own.

    columns: those whose NULLs are counted. measures: numbers that are profiled, as doubles; NULL and NaN are
    left out. flag: a property of the day, such as a holiday. Rows without a date have no state.
    """

    source: DatedTable
    path: str
    columns: Sequence[str]
    measures: Sequence[str] = field(default_factory=tuple)
    flag: str | None = None

    def __post_init__(self):
        self.table = DatedTable(self.source.spark, self.path)

    def refresh(self) -> list[dt.date]:
        """Follow the source; returns the dates that were made again."""
        reader = f"state-{self.path.rstrip('/').rpartition('/')[2]}"
        changes = self.source.changes(reader)
        if changes.dates:
            rows = self.source.read().where(in_dates(F.col(self.source.date), changes.dates))
            state = state_of(rows, self.columns, self.measures, self.flag, self.source.date)
            self.table.replace_dates(state, changes.dates)
        self.source.take_note(reader, changes.upto)
        return changes.dates

    def days(self, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """State rows of a closed range of dates; either end may be open."""
        rows = self.table.read()
        if first is not None:
            rows = rows.where(F.col("date") >= F.lit(first))
        return rows if last is None else rows.where(F.col("date") <= F.lit(last))


def null_profile_of(days: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """As ``null_profile`` of the rows of these days; ``types`` names columns and their types."""
    return as_null_profile(
        days.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("__rows"), *[_total(f"{c}_missing").alias(c) for c in types]), types
    )


def missing_summary_of(days: DataFrame, width: int) -> DataFrame:
    """As ``missing_summary``; ``width`` is the number of columns."""
    total, cells = _total("rows"), _total("missing_cells")
    return days.agg(
        total.alias("total_rows"),
        F.lit(width).cast("long").alias("total_columns"),
        (total * width).alias("total_cells"),
        cells.alias("total_missing"),
        (F.sum("missing_cells") / (F.sum("rows") * width) * 100).alias("missing_percentage"),
        (total - _total("missing_rows")).alias("complete_rows"),
        (_total("missing_rows") - _total("empty_rows")).alias("partial_rows"),
        _total("empty_rows").alias("empty_rows"),
    )


def missing_by_day_of(days: DataFrame, columns: Sequence[str]) -> DataFrame:
    """As ``missing_by_day``: nothing is left to add up."""
    return days.select(F.col("date").alias("day"), "missing_rows", "missing_cells", *[f"{c}_missing" for c in columns])


def missing_verdict_of(days: DataFrame, width: int) -> DataFrame:
    """As ``missing_verdict``."""
    totals = days.agg(_total("missing_rows").alias("missing_rows"), _total("missing_cells").alias("missing_cells"))
    return as_verdict(totals, width)


def gaps_by_previous_day_of(days: DataFrame, column: str) -> DataFrame:
    """As ``gaps_by_previous_day``; the state must have a flag."""
    return previous_day(days.select(F.col("date").alias("day"), F.col(f"{column}_missing").alias("missing_count"), "flag"))


def range_profile_of(days: DataFrame, columns: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """As ``range_profile``, quantiles from the merged sketches; NULL where there is no value."""
    aggregates, shown = [], []
    for c, quantiles in columns.items():
        aggregates += [
            F.min(f"{c}_min").alias(f"{c}_min"),
            F.max(f"{c}_max").alias(f"{c}_max"),
            (F.sum(f"{c}_sum") / F.nullif(F.sum(f"{c}_n"), F.lit(0))).alias(f"{c}_avg"),
            (_total("rows") - _total(f"{c}_n")).alias(f"{c}_nulls"),
            F.sum(f"{c}_n").alias(f"__{c}_n"),
            F.kll_merge_agg_double(f"{c}_sketch", F.lit(SKETCH)).alias(f"__{c}"),
        ]
        there = F.col(f"__{c}_n") > 0
        shown += [F.col(f"{c}_{name}") for name in ("min", "max", "avg")]
        shown += [
            F.when(there, F.kll_sketch_get_quantile_double(f"__{c}", F.lit(float(q)))).alias(f"{c}_{name}")
            for name, q in quantiles.items()
        ]
        shown.append(F.col(f"{c}_nulls"))
    return days.agg(*aggregates).select(*shown)


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("long")
