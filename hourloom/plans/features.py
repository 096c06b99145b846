"""Feature mart, and the frame of future features a forecast starts from."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.functions.times import hour_cos, hour_sin, in_last_days
from hourloom.operators.joins import small_side
from hourloom.operators.lags import lag_by_date

# The lags of the mart and the rolling windows of a daily refresh.
LAGS = {
    "lag_1_day": "lag_1_day_date",
    "lag_7_day": "lag_7_day_date",
    "lag_1_business_day": "lag_1_business_date",
}
SOURCE_DAYS = 20
OUTPUT_DAYS = 7
FORECAST_DAYS = 14

WEATHER_VALUES = ("temperature_2m", "relative_humidity_2m", "precipitation", "weather_code")
CALENDAR_VALUES = ("day_of_week", "is_weekend", "is_holiday")


def weather_at(weather: DataFrame, place: tuple[str, str] | None) -> DataFrame:
    """Weather of one place with its text hour as a number."""
    if place is not None:
        weather = weather.where(F.col(place[0]) == place[1])
    return weather.withColumn("hour", F.col("hour").cast("int"))


def ml_features(
    energy: DataFrame,
    weather: DataFrame,
    cal: DataFrame,
    mapping: DataFrame,
    place: tuple[str, str] | None = None,
    keys: Sequence[str] = (),
    as_of: dt.date | None = None,
    lags: Mapping[str, str] = LAGS,
    unique: bool = False,
) -> DataFrame:
    """Readings with weather, calendar, cyclic hour and lagged values.

    ``keys`` are columns, such as a site, that readings and weather have in common.
    With ``as_of`` only the last 7 days come out (future dates too), computed from 20
    days of readings. ``unique`` is passed on to ``lag_by_date``; sources that repeat a
    grain multiply rows, as they do in the joins this stands for.
    """
    grain = [*keys, "date", "hour"]
    energy = energy.select(*grain, "actual_power", "supply_capacity")
    weather = weather_at(weather, place).select(*grain, *WEATHER_VALUES)
    cal = cal.select("date", *CALENDAR_VALUES)
    if as_of is not None:
        energy = energy.where(in_last_days("date", as_of, SOURCE_DAYS))
        weather = weather.where(in_last_days("date", as_of, OUTPUT_DAYS))
        cal = cal.where(in_last_days("date", as_of, OUTPUT_DAYS))
        mapping = mapping.where(in_last_days("base_date", as_of, OUTPUT_DAYS))
    base = lag_by_date(energy, mapping, "actual_power", lags, [*keys, "hour"], "date", unique)
    if as_of is not None:
        base = base.where(in_last_days("date", as_of, OUTPUT_DAYS))
    joined = base.join(weather, grain, "left").join(small_side(cal), "date", "left")
    return joined.select(
        *grain,
        "actual_power",
        "supply_capacity",
        *WEATHER_VALUES,
        *CALENDAR_VALUES,
        F.month("date").cast("long").alias("month"),
        hour_sin(F.col("hour")).alias("hour_sin"),
        hour_cos(F.col("hour")).alias("hour_cos"),
        *lags,
    )


def future_features(
    weather: DataFrame,
    cal: DataFrame,
    as_of: dt.date,
    place: tuple[str, str] | None = None,
    keys: Sequence[str] = (),
    days: int = FORECAST_DAYS,
) -> DataFrame:
    """Weather from ``as_of`` on for ``days`` days, with calendar and cyclic hour."""
    grain = [*keys, "date", "hour"]
    last = as_of + dt.timedelta(days=days - 1)
    ahead = weather_at(weather.where(F.col("date").between(as_of, last)), place)
    cal = cal.where(F.col("date").between(as_of, last)).select("date", *CALENDAR_VALUES)
    return (
        ahead.select(*grain, *WEATHER_VALUES)
        .join(small_side(cal), "date", "left")
        .select(
            *grain,
            *WEATHER_VALUES,
            *CALENDAR_VALUES,
            F.month("date").cast("long").alias("month"),
            hour_sin(F.col("hour")).alias("hour_sin"),
            hour_cos(F.col("hour")).alias("hour_cos"),
        )
    )


def power_and_weather(energy: DataFrame, weather: DataFrame, cal: DataFrame) -> DataFrame:
    """Readings with the weather of every place, ready to be exported place by place.

    Hours without weather are left out, so this is an inner join.
    """
    return (
        energy.join(weather_at(weather, None), ["date", "hour"])
        .join(small_side(cal.select("date", *CALENDAR_VALUES)), "date", "left")
        .select(
            "date",
            "hour",
            "actual_power",
            "supply_capacity",
            "prefecture",
            *WEATHER_VALUES,
            *CALENDAR_VALUES,
            F.month("date").cast("long").alias("month"),
        )
    )
