"""Range profiles and missing-value reports, each from one pass over the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels and limits of the missing-pattern verdict.
ALL_COLUMNS_SHARE = 0.8
FEW_CELLS = 3


def range_profile(
    df: DataFrame,
    columns: Mapping[str, Mapping[str, float]] | Sequence[str],
    negatives: Sequence[str] = (),
    total: str | None = None,
    accuracy: int = 10_000,
) -> DataFrame:
    """One row: min, max, avg, quantiles and NULL count of each column.

    ``columns`` may name the quantiles wanted per column (``{"p99": 0.99}``); by default
    median, p1 and p99. Quantiles come from a mergeable sketch of bounded size with rank
    error 1 / ``accuracy``; it is exact while there are fewer rows than half of that.
    """
    if not isinstance(columns, Mapping):
        columns = {c: {"median": 0.5, "p1": 0.01, "p99": 0.99} for c in columns}
    aggregates: list[Column] = []
    shown: list[Column] = []
    for c, quantiles in columns.items():
        aggregates += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.avg(c).alias(f"{c}_avg")]
        aggregates.append(F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"))
        shown += [F.col(f"{c}_{name}") for name in ("min", "max", "avg")]
        if quantiles:
            # One sketch per column answers all its quantiles.
            sketch = F.percentile_approx(c, list(quantiles.values()), accuracy)
            aggregates.append(sketch.alias(f"__{c}"))
            shown += [F.col(f"__{c}")[i].alias(f"{c}_{name}") for i, name in enumerate(quantiles)]
        shown.append(F.col(f"{c}_nulls"))
    counts = {f"{c}_negative_count": F.count_if(F.col(c) < 0) for c in negatives}
    if total:
        counts[total] = F.count("*")
    aggregates += [count.alias(name) for name, count in counts.items()]
    return df.agg(*aggregates).select(*shown, *counts)


def null_flags(columns: Sequence[str]) -> Column:
    """How many of ``columns`` are NULL in a row."""
    parts = [F.col(c).isNull().cast("int") for c in columns]
    return sum(parts[1:], parts[0])


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: NULL count and share in percent, most NULLs first."""
    columns = list(columns or df.columns)
    types = dict(df.dtypes)
    counted = df.agg(
        F.count("*").alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return as_null_profile(counted, {c: types[c] for c in columns})


def as_null_profile(counted: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The profile from one row of ``__rows`` and the NULL count of each column."""
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(c).alias("missing_count"),
                F.when(F.col("__rows") > 0, F.col(c) / F.col("__rows") * 100).alias("missing_percentage"),
                F.lit(types[c]).alias("data_type"),
            )
            for c in types
        ]
    )
    return counted.select(F.inline(rows)).orderBy(F.desc("missing_count"), "column")


def missing_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: cells, NULL cells and their share, and complete / partial / empty rows."""
    columns = list(columns or df.columns)
    width = len(columns)
    flagged = df.select(null_flags(columns).alias("nulls"))
    return flagged.agg(
        F.count("*").alias("total_rows"),
        F.lit(width).cast("long").alias("total_columns"),
        (F.count("*") * width).alias("total_cells"),
        F.coalesce(F.sum("nulls"), F.lit(0)).cast("long").alias("total_missing"),
        (F.sum("nulls") / (F.count("*") * width) * 100).alias("missing_percentage"),
        F.count_if(F.col("nulls") == 0).alias("complete_rows"),
        F.count_if((F.col("nulls") > 0) & (F.col("nulls") < width)).alias("partial_rows"),
        F.count_if(F.col("nulls") == width).alias("empty_rows"),
    )


def missing_by_day(df: DataFrame, columns: Sequence[str] | None = None, date: str = "date") -> DataFrame:
    """Per day: rows with a NULL, NULL cells, and NULLs of each column."""
    columns = list(columns or df.columns)
    flagged = df.select(
        F.col(date).cast("date").alias("day"),
        null_flags(columns).alias("__nulls"),
        *[F.col(c).isNull().alias(f"{c}_missing") for c in columns],
    )
    return flagged.groupBy("day").agg(
        F.count_if(F.col("__nulls") > 0).alias("missing_rows"),
        F.sum("__nulls").cast("long").alias("missing_cells"),
        *[F.count_if(F.col(f"{c}_missing")).alias(f"{c}_missing") for c in columns],
    )


def worst_days(by_day: DataFrame, measure: str, k: int) -> DataFrame:
    """The k days with most missing, earlier days first among equals; clean days never."""
    return by_day.where(F.col(measure) > 0).orderBy(F.desc(measure), "day").limit(k)


def missing_verdict(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: how many cells an incomplete row lacks on average, and the pattern."""
    columns = list(columns or df.columns)
    flagged = df.select(null_flags(columns).alias("nulls"))
    totals = flagged.agg(
        F.count_if(F.col("nulls") > 0).alias("missing_rows"),
        F.coalesce(F.sum("nulls"), F.lit(0)).cast("long").alias("missing_cells"),
    )
    return as_verdict(totals, len(columns))


def as_verdict(totals: DataFrame, width: int) -> DataFrame:
    """Average and pattern beside ``missing_rows`` and ``missing_cells`` of so many columns."""
    average = F.when(F.col("missing_rows") > 0, F.col("missing_cells") / F.col("missing_rows"))
    return totals.withColumn("cells_per_row", F.coalesce(average, F.lit(0.0))).withColumn(
        "pattern",
        F.when(F.col("missing_rows") == 0, "none")
        .when(F.col("cells_per_row") >= width * ALL_COLUMNS_SHARE, "all")
        .when(F.col("cells_per_row") <= FEW_CELLS, "partial")
        .otherwise("mixed"),
    )


def gaps_by_previous_day(
    df: DataFrame, column: str, date: str = "date", holiday: str = "is_holiday"
) -> DataFrame:
    """Days on which ``column`` has NULLs, and what the day before was.

    ``previous_day`` is holiday, workday, or unknown when the day before has no rows (or
    no flag). The flag is a property of the day, so one value per day is kept.
    """
    days = df.groupBy(F.col(date).alias("day")).agg(
        F.count_if(F.col(column).isNull()).alias("missing_count"), F.max(holiday).alias("flag")
    )
    return previous_day(days)


def previous_day(days: DataFrame) -> DataFrame:
    """Days with gaps and what the day before was, from ``(day, missing_count, flag)``."""
    before = days.select(F.date_add("day", 1).alias("day"), F.col("flag").alias("flag_before"))
    return (
        days.where("missing_count > 0")
        .join(before, "day", "left")
        .select(
            "day",
            F.weekday("day").alias("weekday"),
            "missing_count",
            F.when(F.col("flag_before"), "holiday")
            .when(~F.col("flag_before"), "workday")
            .otherwise("unknown")
            .alias("previous_day"),
        )
    )


def count_gaps_by_previous_day(gaps: DataFrame) -> DataFrame:
    return gaps.groupBy("previous_day").agg(
        F.count("*").alias("days"),
        F.sum("missing_count").alias("missing_count"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, failures)``: the not-null tests of a mart, one pass for all columns."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in columns])
        )
    )


def assert_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` itself, failing the query at the first NULL in ``columns``."""
    checked = df
    for c in columns:
        complaint = F.raise_error(F.lit(f"column {c} must not be NULL"))
        checked = checked.where(F.when(F.col(c).isNull(), complaint.cast("boolean")).otherwise(F.lit(True)))
    return checked
