"""One-row status board of all processes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.functions.measures import run_grade
from hourloom.functions.times import in_last_days
from hourloom.operators.latest import latest_per_key
from hourloom.plans.quality import severity

# Logged process names, the column prefixes they fill, and the days of
# log looked at. Quality findings fill ``QUALITY`` instead of a process.
PROCESSES = {
    "tepco_api": "TEPCO_API",
    "weather_api": "WEATHER_API",
    "ml_features_update": "ML_FEATURES_UPDATE",
    "ml_prediction": "ML_PREDICTION",
    "prediction_accuracy_update": "PREDICTION_ACCURACY_UPDATE",
    "dashboard_update": "DASHBOARD_UPDATE",
}
QUALITY = "data_quality"
LOG_DAYS = 2


def system_status(
    log: DataFrame,
    checks: DataFrame,
    as_of: dt.date,
    processes: Mapping[str, str] = PROCESSES,
    updated_at: Column | None = None,
) -> DataFrame:
    """Status, message and duration of each process's latest run, and of the latest finding.

    Always one row: a process without a run, and a missing finding, show WARNING. Among
    findings of one timestamp the worst status wins, then check_type, check_target, issue_detail;
    among runs started together the greatest execution_id.

    Log and findings are folded into a single aggregate of "greatest by time" per
    process, so a task passes on one row however long the log or one process's share is.
    ``log`` needs process_type, status, error_message, started_at, completed_at,
    execution_id and date.
    """
    runs = log.where(in_last_days("date", as_of, LOG_DAYS)).select(
        F.col("process_type").alias("name"),
        F.struct(
            F.col("started_at").alias("at"),
            F.lit(0).alias("severity"),
            F.col("execution_id").alias("first_tie"),
            F.lit("").alias("second_tie"),
            F.lit("").alias("third_tie"),
        ).alias("rank"),
        F.struct(
            run_grade(F.col("status")).alias("status"),
            F.col("error_message").alias("message"),
            (F.timestamp_diff("MICROSECOND", "started_at", "completed_at") / 1000000.0).alias("seconds"),
        ).alias("shown"),
    )
    findings = checks.where(in_last_days("check_date", as_of, LOG_DAYS)).select(
        F.lit(None).cast("string").alias("name"),
        F.struct(
            F.col("check_timestamp").cast("timestamp_ntz").alias("at"),
            severity(F.col("status")).alias("severity"),
            F.col("check_type").alias("first_tie"),
            F.col("check_target").alias("second_tie"),
            F.col("issue_detail").alias("third_tie"),  # findings of several groups
        ).alias("rank"),
        F.struct(
            F.col("status"), F.col("issue_detail").alias("message"), F.lit(None).cast("double").alias("seconds")
        ).alias("shown"),
    )
    board = runs.unionByName(findings).agg(
        *[
            F.max_by(F.when(F.col("name") == logged, F.col("shown")), F.when(F.col("name") == logged, F.col("rank"))).alias(prefix)
            for prefix, logged in processes.items()
        ],
        F.max_by(F.when(F.col("name").isNull(), F.col("shown")), F.when(F.col("name").isNull(), F.col("rank"))).alias(QUALITY),
    )
    prefixes = [*list(processes)[:-1], QUALITY, *list(processes)[-1:]]
    return board.select(
        *([] if updated_at is None else [updated_at.alias("updated_at")]),
        *[F.coalesce(F.col(f"{p}.status"), F.lit("WARNING")).alias(f"{p}_status") for p in prefixes],
        *[F.col(f"{p}.message").alias(f"{p}_message") for p in prefixes],
        *[F.col(f"{p}.seconds").alias(f"{p}_duration_seconds") for p in prefixes],
    )


def latest_runs(log: DataFrame, as_of: dt.date) -> DataFrame:
    """The latest run of every process in the window, in full."""
    recent = log.where(in_last_days("date", as_of, LOG_DAYS))
    return latest_per_key(recent, ["process_type"], "started_at", ["execution_id"])
