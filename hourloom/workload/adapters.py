"""The given tables, seen as readings, weather, forecasts and run logs.

Events are the readings: their type, or their user, is the site they come from.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.operators.calendar import calendar_spanning, date_lag_mapping
from hourloom.shared import new_folder

AS_OF = dt.date(2024, 1, 31)
HOLIDAYS = (dt.date(2024, 1, 1), dt.date(2024, 1, 8), dt.date(2024, 2, 12))
SITE = "view"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _money(column: Column) -> Column:
    return column.cast("decimal(18,2)")


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Many versions per (date, hour)."""
    return events(spark, folder).select(
        F.col("ts").cast("date").alias("date"),
        F.hour("ts").alias("hour"),
        F.col("event_type").alias("site"),
        F.col("value").alias("actual_power"),
        (F.col("value") * 1.25).alias("supply_capacity"),
        F.col("ts").alias("created_at"),
        "event_id",
    )


def energy(spark: SparkSession, folder: str, keys: Sequence[str] = ()) -> DataFrame:
    """One reading per hour (per key)."""
    return (
        events(spark, folder)
        .groupBy(*keys, F.col("ts").cast("date").alias("date"), F.hour("ts").alias("hour"))
        .agg(
            F.sum(_money(F.col("value"))).cast("double").alias("actual_power"),
            (F.count("*") * 60).cast("double").alias("supply_capacity"),
            F.max("ts").alias("created_at"),
        )
    )


def weather(spark: SparkSession, folder: str, place: str = "event_type", name: str = "prefecture") -> DataFrame:
    """Hourly values per place; the hour is two-digit text, precipitation has NULLs."""
    value = _money(F.col("value"))
    return (
        events(spark, folder)
        .groupBy(
            F.col(place).alias(name),
            F.col("ts").cast("date").alias("date"),
            F.lpad(F.hour("ts").cast("string"), 2, "0").alias("hour"),
        )
        .agg(
            F.min(value).cast("double").alias("temperature_2m"),
            F.max(value).cast("double").alias("relative_humidity_2m"),
            F.when(F.count("*") > 1, F.sum(value).cast("double")).alias("precipitation"),
            F.count("*").alias("weather_code"),
            F.max("ts").alias("created_at"),
        )
    )


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Whole months around the events."""
    days = events(spark, folder).select(F.col("ts").cast("date").alias("date"))
    return _stored(spark, folder, "calendar", lambda: calendar_spanning(days, "date", HOLIDAYS))


def ship_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Whole months around the shipping dates: years of days."""
    days = table(spark, folder, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
    return _stored(spark, folder, "ship-calendar", lambda: calendar_spanning(days, "date", HOLIDAYS))


def lag_mapping(spark: SparkSession, folder: str) -> DataFrame:
    cal = calendar(spark, folder)
    return _stored(spark, folder, "lags", lambda: date_lag_mapping(cal, [1, 7], [1]))


def ship_lag_mapping(spark: SparkSession, folder: str) -> DataFrame:
    cal = ship_calendar(spark, folder)
    return _stored(spark, folder, "ship-lags", lambda: date_lag_mapping(cal, [1, 7], [1]))


def ship_lag_mapping_60(spark: SparkSession, folder: str) -> DataFrame:
    cal = ship_calendar(spark, folder)
    return _stored(spark, folder, "ship-lags-60", lambda: date_lag_mapping(cal, list(range(1, 61)), [1]))


_PATHS: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, folder: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Calendars and lag mappings are tables made once, here once per application."""
    place = (spark.sparkContext.applicationId, folder, name)
    if place not in _PATHS:
        path = new_folder(spark, name)
        make().write.parquet(path)
        _PATHS[place] = path
    return spark.read.parquet(_PATHS[place])


def predictions(spark: SparkSession, folder: str, keys: Sequence[str] = ()) -> DataFrame:
    """Three runs per target: 1, 3 and 7 days ahead."""
    return predictions_of(energy(spark, folder, keys), keys)


def predictions_of(readings: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The runs that aim at these readings."""
    percent = F.lit(100) + F.col("hour") % 5 - 2 + F.col("k")
    return (
        readings.select("*", F.explode(F.array(F.lit(1), F.lit(3), F.lit(7))).alias("k"))
        .select(
            *keys,
            F.concat(F.lit("run-"), F.col("k").cast("string")).alias("execution_id"),
            F.col("date").alias("prediction_date"),
            F.col("hour").alias("prediction_hour"),
            F.round(F.col("actual_power") * percent / 100, 2).alias("predicted_power_kwh"),
            F.date_sub("date", F.col("k")).cast("timestamp_ntz").alias("created_at"),
        )
    )


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Event types as process names; a run ends ``user_id`` seconds after it started."""
    failed = F.col("event_id") % 5 == 0
    return events(spark, folder).select(
        F.col("event_id").cast("string").alias("execution_id"),
        F.col("ts").cast("date").alias("date"),
        F.upper("event_type").alias("process_type"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(failed, F.col("props")).alias("error_message"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("user_id").cast("decimal(18,6)"))).alias("completed_at"),
        F.col("value").alias("duration_seconds"),
        F.col("user_id").alias("records_processed"),
        F.col("props").alias("additional_info"),
    )


def revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Daily revenue per supplier: one row per (l_suppkey, date), days missing between."""
    net = _money(F.col("l_extendedprice")) * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("date"))
        .agg(F.sum(net.cast("decimal(18,4)")).alias("revenue"))
    )
