"""How good past forecasts were."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.functions.measures import absolute_error, error_share_of_nonzero
from hourloom.functions.times import day, days_before

# Fixed value: days of runs, and of readings, that a refresh looks at.
RUN_DAYS = 14


def prediction_accuracy(
    predictions: DataFrame,
    energy: DataFrame,
    as_of: dt.date,
    keys: Sequence[str] = (),
    days: int | None = RUN_DAYS,
) -> DataFrame:
    """Forecasts of the last ``days`` days' runs against readings from before ``as_of``.

    The run date is the date of ``created_at``. Both windows are plain filters on the
    sources, so they reach the scans. With ``days`` None, all runs and readings there are.
    """
    run_date = F.col("created_at").cast("date")
    runs = predictions.where((run_date <= day(as_of)) & (F.col("prediction_date") < day(as_of)))
    if days is not None:
        runs = runs.where(run_date >= days_before(as_of, days))
        energy = energy.where(F.col("date") >= days_before(as_of, days))
    runs = runs.select(
        *keys,
        "execution_id",
        run_date.alias("prediction_run_date"),
        F.col("created_at").alias("prediction_run_datetime"),
        "prediction_date",
        "prediction_hour",
        F.col("predicted_power_kwh").alias("predicted_power"),
    )
    readings = energy.where(F.col("date") < day(as_of)).select(
        *keys, F.col("date").alias("prediction_date"), F.col("hour").alias("prediction_hour"), "actual_power"
    )
    predicted, actual = F.col("predicted_power"), F.col("actual_power")
    return runs.join(readings, [*keys, "prediction_date", "prediction_hour"]).select(
        *keys,
        "execution_id",
        "prediction_run_date",
        "prediction_run_datetime",
        "prediction_date",
        "prediction_hour",
        "predicted_power",
        "actual_power",
        absolute_error(predicted, actual).alias("error_absolute"),
        error_share_of_nonzero(predicted, actual).alias("error_percentage"),
        F.datediff("prediction_date", "prediction_run_date").cast("long").alias("days_ahead"),
    )


def accuracy_by_days_ahead(accuracy: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """MAPE and mean absolute error for each forecast distance."""
    return accuracy.groupBy(*keys, "days_ahead").agg(
        F.count("*").alias("forecasts"),
        F.avg("error_percentage").alias("mape"),
        F.avg("error_absolute").alias("mae"),
    )
