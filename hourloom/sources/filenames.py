"""What a weather file's name says about it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prefectures that may start a file name, and the years allowed.
PREFECTURES = (
    "tokyo", "kanagawa", "saitama", "chiba", "ibaraki",
    "tochigi", "gunma", "yamanashi", "shizuoka",
)
YEARS = (2010, 2100)


def parse_file_name(
    df: DataFrame, path: str = "path", prefectures: Sequence[str] = PREFECTURES, max_parts: int = 3
) -> DataFrame:
    """Add prefecture, year, file_date and name_error from ``{prefecture}_{year}[_{MMDD}]``.

    ``name_error`` is NULL for a good name, and the other columns NULL for a bad one.
    """
    base = F.element_at(F.split(F.col(path), "/"), -1)
    parts = F.split(F.regexp_replace(base, r"\.[^.]+$", ""), "_", -1)
    n = F.size(parts)
    year = F.when(F.get(parts, F.lit(1)).rlike(r"^\d+$"), F.get(parts, F.lit(1)).try_cast("int"))
    month_day = F.get(parts, F.lit(2))
    real_day = F.try_to_date(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), month_day), "yyyy-MMdd")
    error = (
        F.when(n < 2, "too few parts")
        .when(~F.get(parts, F.lit(0)).isin(list(prefectures)), "unknown prefecture")
        .when(year.isNull() | ~year.between(*YEARS), "bad year")
        .when(n > max_parts, "too many parts")
        .when((n >= 3) & ~month_day.rlike(r"^\d{4}$"), "bad month and day")
        .when((n >= 3) & real_day.isNull(), "no such day")
    )
    good = F.col("name_error").isNull()
    return (
        df.withColumn("name_error", error)
        .withColumn("prefecture", F.when(good, F.get(parts, F.lit(0))))
        .withColumn("year", F.when(good, year))
        .withColumn("file_date", F.when(good & (n >= 3), real_day))
    )


def normalize_key(column: Column, names: Mapping[str, str]) -> Column:
    """Map the spellings of a key to one; a spelling that is not listed stays as it is."""
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[column], column)
