"""Dashboard mart: latest readings, weather and forecast side by side."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.functions.measures import absolute_error, error_share_of_positive, usage_rate, weekday_label
from hourloom.functions.times import in_last_days
from hourloom.operators.joins import small_side
from hourloom.operators.latest import latest_per_key
from hourloom.plans.features import CALENDAR_VALUES, OUTPUT_DAYS, WEATHER_VALUES, weather_at


def dashboard(
    energy: DataFrame,
    weather: DataFrame,
    cal: DataFrame,
    predictions: DataFrame,
    place: tuple[str, str] | None = None,
    keys: Sequence[str] = (),
    as_of: dt.date | None = None,
    created_at: Column | None = None,
) -> DataFrame:
    """One row per reading: its latest version, the latest weather and the latest forecast.

    With ``as_of`` only the last 7 days. All three sources are cut to one row per
    (keys, date, hour) on the partitioning the joins then use. ``created_at`` adds the
    column of that name.
    """
    grain = [*keys, "date", "hour"]
    if as_of is not None:
        energy = energy.where(in_last_days("date", as_of, OUTPUT_DAYS))
        weather = weather.where(in_last_days("date", as_of, OUTPUT_DAYS))
        predictions = predictions.where(in_last_days("prediction_date", as_of, OUTPUT_DAYS))
    readings = latest_per_key(
        energy.select(*grain, "actual_power", "supply_capacity", "created_at"), grain
    ).drop("created_at")
    conditions = latest_per_key(
        weather_at(weather, place).select(*grain, *WEATHER_VALUES, "created_at"), grain
    ).drop("created_at")
    forecast = latest_per_key(_as_readings(predictions, keys), grain).drop("created_at")
    return _mart(readings, conditions, cal, forecast, grain, created_at)


def dashboard_history(
    energy: DataFrame,
    weather: DataFrame,
    cal: DataFrame,
    predictions: DataFrame,
    as_of: dt.date,
    place: tuple[str, str] | None = None,
    keys: Sequence[str] = (),
    created_at: Column | None = None,
) -> DataFrame:
    """All days before ``as_of``, for a first load. Only forecasts are cut to the latest."""
    grain = [*keys, "date", "hour"]
    forecast = latest_per_key(_as_readings(predictions, keys), grain).drop("created_at")
    return _mart(
        energy.where(F.col("date") < F.lit(as_of)).select(*grain, "actual_power", "supply_capacity"),
        weather_at(weather, place).select(*grain, *WEATHER_VALUES),
        cal,
        forecast,
        grain,
        created_at,
    )


def _as_readings(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    return predictions.select(
        *keys,
        F.col("prediction_date").alias("date"),
        F.col("prediction_hour").alias("hour"),
        F.col("predicted_power_kwh").alias("predicted_power"),
        "created_at",
    )


def _mart(readings, conditions, cal, forecast, grain, created_at) -> DataFrame:
    predicted, actual = F.col("predicted_power"), F.col("actual_power")
    joined = (
        readings.join(conditions, grain, "left")
        .join(forecast, grain, "left")
        .join(small_side(cal.select("date", *CALENDAR_VALUES)), "date", "left")
    )
    return joined.select(
        *grain,
        "actual_power",
        "supply_capacity",
        "predicted_power",
        absolute_error(predicted, actual).alias("error_absolute"),
        error_share_of_positive(predicted, actual).alias("error_percentage"),
        *WEATHER_VALUES,
        *CALENDAR_VALUES,
        usage_rate(actual, F.col("supply_capacity")).alias("usage_rate"),
        weekday_label(F.col("day_of_week")).alias("weekday_jp"),
        *([] if created_at is None else [created_at.alias("created_at")]),
    )
