"""Calendars and date-to-date lag mappings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Business days per window group when reading k days back. Only the last k days of a
# group are repeated in the next one.
_GROUP_DAYS = 1024


def calendar_frame(
    spark: SparkSession, first: dt.date, last: dt.date, holidays: Iterable[dt.date] = ()
) -> DataFrame:
    """One row per day from ``first`` to ``last``: date, weekday name and flags."""
    days = spark.range((last - first).days + 1)
    date = F.date_add(F.lit(first), F.col("id").cast("int"))
    return days.select(date.alias("date")).select(
        "date",
        F.date_format("date", "EEEE").alias("day_of_week"),
        (F.weekday("date") >= 5).alias("is_weekend"),
        F.col("date").isin(list(holidays)).alias("is_holiday"),
    )


def calendar_spanning(
    df: DataFrame, date: str, holidays: Iterable[dt.date] = (), months_around: int = 1
) -> DataFrame:
    """A calendar over the whole months ``df`` touches plus ``months_around`` each side.

    Runs one aggregate over the date column now: a single row comes back.
    """
    bounds = df.agg(
        F.add_months(F.trunc(F.min(date), "month"), -months_around).alias("first"),
        F.last_day(F.add_months(F.max(date), months_around)).alias("last"),
    ).first()
    return calendar_frame(df.sparkSession, bounds["first"], bounds["last"], holidays)


def business_days(cal: DataFrame) -> DataFrame:
    return cal.where(~F.col("is_holiday") & ~F.col("is_weekend")).select("date")


def number_business_days(cal: DataFrame) -> DataFrame:
    """``(date, n)``: consecutive numbers over all business days.

    Days are numbered within their year in parallel, then shifted by the count of all
    earlier years. Only that per-year count (one row per year) is ordered globally.
    """
    days = business_days(cal).withColumn("year", F.year("date"))
    earlier = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        days.groupBy("year")
        .agg(F.count("*").alias("days"))
        .select("year", F.coalesce(F.sum("days").over(earlier), F.lit(0)).alias("shift"))
    )
    in_year = F.row_number().over(Window.partitionBy("year").orderBy("date"))
    return (
        days.withColumn("in_year", in_year)
        .join(shift, "year")
        .select("date", (F.col("in_year") + F.col("shift")).alias("n"))
    )


def business_lags(cal: DataFrame, ks: Sequence[int]) -> DataFrame:
    """``(date, lag_{k}_business_date ...)`` for business days only."""
    reach = max(ks)
    size = max(_GROUP_DAYS, reach)
    place = F.col("n") - 1
    group = F.floor(place / size)
    with_halo = number_business_days(cal).select(
        "date",
        "n",
        F.explode(
            F.when(place % size >= size - reach, F.array(group, group + 1)).otherwise(F.array(group))
        ).alias("group"),
        group.alias("home"),
    )
    by_group = Window.partitionBy("group").orderBy("n")
    lagged = with_halo.select(
        "date",
        (F.col("group") == F.col("home")).alias("own"),
        *[F.lag("date", k).over(by_group).alias(f"lag_{k}_business_date") for k in ks],
    )
    return lagged.where("own").drop("own")


def date_lag_mapping(
    cal: DataFrame,
    days: Sequence[int] = tuple(range(1, 31)),
    business: Sequence[int] = tuple(range(1, 31)),
    carry_back: bool = False,
) -> DataFrame:
    """Per calendar date, the dates ``days`` back and ``business`` business days back.

    A weekend or holiday has no business-day number, so its business lags are NULL.
    With ``carry_back`` it looks back to the business days before it instead.
    """
    base = cal.select(
        F.col("date").alias("base_date"),
        *[F.date_sub("date", k).alias(f"lag_{k}_day_date") for k in days],
    )
    if not business:
        return base
    if not carry_back:
        lags = business_lags(cal, business).withColumnRenamed("date", "base_date")
        return base.join(lags, "base_date", "left")
    # Days passed since the latest business day number decide the lag: a non-business
    # day sits just after business day number n, so its k-th lag is day n - k + 1.
    numbered = number_business_days(cal)
    last_year = Window.partitionBy(F.year("date")).orderBy("date")
    seen = cal.select("date").join(numbered, "date", "left").select(
        "date", "n", F.max("n").over(last_year).alias("in_year_n")
    )
    per_year = seen.groupBy(F.year("date").alias("year")).agg(F.max("n").alias("top"))
    before = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_year.select("year", F.max("top").over(before).alias("carried_n"))
    position = (
        seen.withColumn("year", F.year("date"))
        .join(carried, "year")
        .select(
            F.col("date").alias("base_date"),
            F.when(F.col("n").isNotNull(), F.col("n") - 1)
            .otherwise(F.coalesce("in_year_n", "carried_n"))
            .alias("previous"),
        )
    )
    wanted = position.select(
        "base_date", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), (F.col("previous") - (k - 1)).alias("n")) for k in business])).alias("w")
    )
    found = (
        wanted.join(numbered.withColumnRenamed("date", "lag_date"), F.col("w.n") == F.col("n"))
        .groupBy("base_date")
        .agg(
            *[
                F.max(F.when(F.col("w.k") == k, F.col("lag_date"))).alias(f"lag_{k}_business_date")
                for k in business
            ]
        )
    )
    return base.join(found, "base_date", "left")
