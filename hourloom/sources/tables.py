"""Scans, exports and backfills of stored tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.functions.times import literal

PREDICTIONS_CSV = (
    "execution_id string, prediction_date date, prediction_hour int, "
    "predicted_power_kwh double, created_at timestamp_ntz"
)
PREDICTION_COLUMNS = (
    "execution_id",
    "prediction_run_date",
    "prediction_date",
    "prediction_hour",
    "predicted_power_kwh",
    "created_at",
)


def scan_range(
    df: DataFrame, columns: Sequence[str], date: str, first=None, last=None, order: Sequence[str] = ()
) -> DataFrame:
    """Chosen columns of a closed date range; either end may be open."""
    if first is not None:
        df = df.where(F.col(date) >= literal(first))
    if last is not None:
        df = df.where(F.col(date) <= literal(last))
    out = df.select(*columns)
    return out.orderBy(*order) if order else out


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").option("encoding", "UTF-8").csv(path)


def export_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, NULL fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def export_by_key(df: DataFrame, key: str, path: str, fmt: str = "csv") -> None:
    """One folder per key value from a single pass over ``df``.

    Rebalancing sends a key's rows to few tasks; adaptive execution splits a large key.
    """
    df.hint("rebalance", key).write.mode("overwrite").option("header", "true").partitionBy(key).format(fmt).save(path)


def read_predictions_csv(spark: SparkSession, path: str, run_date: dt.date | str) -> DataFrame:
    """A forecast export with the run date its file does not hold."""
    rows = spark.read.schema(PREDICTIONS_CSV).option("header", "true").csv(path)
    return rows.withColumn("prediction_run_date", F.lit(str(run_date)).cast("date")).select(*PREDICTION_COLUMNS)


def backfill_predictions(
    spark: SparkSession, files: Iterable[tuple[str, dt.date | str]], table: str
) -> list[str]:
    """Append each export to ``table``; returns the paths that were missing and passed over."""
    missing = []
    for path, run_date in files:
        try:
            rows = read_predictions_csv(spark, path, run_date)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(path)
            continue
        rows.write.mode("append").partitionBy("prediction_run_date").parquet(table)
    return missing
