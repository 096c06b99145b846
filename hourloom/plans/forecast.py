"""Training, and the forecast that feeds on its own earlier days.

A day's hours never need each other, only earlier days. So each series of one key and
one hour of the day is a single row: the readings it may look back at, and the features
of its 14 days. Gathering these rows is the only shuffle. The 14 steps are then 14
narrow projections of that row within one stage, each adding the forecast of a day from
the forecasts already in the row: no join, no loop over results and no lineage to cut.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.functions.times import moment
from hourloom.plans.boosting import Boosted, train_boosted
from hourloom.shared import map_batches, written

# Model inputs in order, model settings, and how far things reach.
FEATURES = (
    "hour",
    "is_weekend",
    "is_holiday",
    "month",
    "hour_sin",
    "hour_cos",
    "lag_1_day",
    "lag_7_day",
    "lag_1_business_day",
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
)
TREES, DEPTH, RATE, SEED = 200, 8, 0.05, 42
DAYS = 14
SEARCH_DAYS = 20
HOURS = 24

# Stands for a missing value: trees can split it off, which they cannot do with NaN.
MISSING = -1.0e9

# Adds a ``prediction`` column to rows that have the feature columns; it may add others.
Predictor = Callable[[DataFrame], DataFrame]


def _present(name: str) -> Column:
    """A model input as a number, ``MISSING`` where it is missing or NaN."""
    return F.coalesce(F.nanvl(F.col(name).cast("double"), F.lit(None)), F.lit(MISSING))


def feature_vector() -> Column:
    """The model input, values that are missing or NaN replaced by ``MISSING``."""
    return array_to_vector(F.array(*[_present(c) for c in FEATURES]))


def model_input(features: DataFrame, as_of: dt.date) -> DataFrame:
    """The target and the inputs of all rows that train a model as of a day."""
    known = training_rows(features, as_of)
    return known.select("actual_power", *[_present(c).alias(c) for c in FEATURES])


def training_rows(features: DataFrame, as_of: dt.date) -> DataFrame:
    """Rows up to the day before ``as_of`` that have the target value."""
    return features.where((F.col("date") < F.lit(as_of)) & F.col("actual_power").isNotNull())


def train(
    features: DataFrame,
    as_of: dt.date,
    trees: int = TREES,
    depth: int = DEPTH,
    rate: float = RATE,
    seed: int = SEED,
) -> GBTRegressionModel:
    """Fit boosted trees on everything known before ``as_of``. Runs Spark jobs now."""
    # Boosting passes over the rows hundreds of times; the mart behind them is not redone.
    rows = written(model_input(features, as_of), "training")
    rows = rows.select(feature_vector().alias("features"), F.col("actual_power").alias("label"))
    return GBTRegressor(maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed).fit(rows)


def train_missing(features: DataFrame, as_of: dt.date, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Boosted:
    """As ``train``, with trees that learn where missing values go. Runs Spark jobs now."""
    rows = written(training_rows(features, as_of).select("actual_power", *FEATURES), "training")
    return train_boosted(rows, FEATURES, "actual_power", trees, depth, rate)


def tree_predictor(model: GBTRegressionModel) -> Predictor:
    return lambda df: model.transform(df.withColumn("features", feature_vector()))


def same_hour_last_week(df: DataFrame) -> DataFrame:
    """The seasonal-naive baseline: the value of seven days before."""
    return df.withColumn("prediction", F.col("lag_7_day"))


def forecast(
    predictor: Predictor | Boosted,
    history: DataFrame,
    future: DataFrame,
    as_of: dt.date,
    keys: Sequence[str] = (),
    days: int = DAYS,
) -> DataFrame:
    """``(keys, prediction_date, prediction_hour, prediction)`` for ``days`` days from ``as_of``.

    A lag is the forecast of that day if there is one, else its reading, else missing.
    The business-day lag looks back up to 20 days for the nearest business day that has
    a forecast or a reading. Every key in ``future`` must have all hours of all days,
    once each, and ``history`` no hour twice, or the query fails.
    """
    rows = _ahead(future, as_of, keys, days).join(_past(history, as_of, keys), [*keys, "hour"], "left")
    if isinstance(predictor, Boosted):
        return _forecast_boosted(predictor, rows, as_of, keys, days)
    # The steps are written as SQL text: the same plan, built in far fewer calls.
    rows = rows.selectExpr("*", "named_struct('step', CAST(NULL AS INT), 'value', CAST(NULL AS DOUBLE)) AS __work")
    series = [f"`{k}`" for k in keys]
    kept = [*series, "hour", "__ahead", "__past"]
    for step in range(days):
        done = predictor(rows.selectExpr(*kept, "__work", *_features_of(step)))
        value = "CAST(prediction AS DOUBLE)"
        # The forecast of the latest business day so far, for the days that follow.
        works = f"NOT __ahead[{step}].is_weekend AND NOT __ahead[{step}].is_holiday"
        work = f"IF({works}, named_struct('step', {step}, 'value', {value}), __work) AS __work"
        rows = done.selectExpr(*kept, f"{value} AS __p{step}", work)
        kept.append(f"__p{step}")
    dated = ", ".join(
        f"named_struct('prediction_date', DATE '{as_of + dt.timedelta(days=i)}', 'prediction', __p{i})"
        for i in range(days)
    )
    return rows.selectExpr(*series, "hour AS prediction_hour", f"inline(array({dated}))").select(
        *keys, "prediction_date", "prediction_hour", "prediction"
    )


def _forecast_boosted(model: Boosted, rows: DataFrame, as_of: dt.date, keys: Sequence[str], days: int) -> DataFrame:
    """The same recursion in Arrow batches: one pass of Python for all days, missing inputs left missing."""
    ahead = [F.expr(f"transform(__ahead, d -> CAST(d.{c} AS DOUBLE))").alias(f"a_{c}") for c in _AHEAD_COLUMNS]
    inputs = rows.select(
        F.struct(*keys, "hour").alias("series"),
        F.col("hour").cast("double").alias("hour"),
        *ahead,
        F.coalesce("__past.days", F.array_repeat(F.lit(None).cast("double"), 7)).alias("days"),
        F.col("__past.work.back").cast("double").alias("back"),
        F.col("__past.work.value").cast("double").alias("work"),
    )

    def matrix(column: pa.Array, n: int) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            given = {c: matrix(batch.column(f"a_{c}"), n) for c in _AHEAD_COLUMNS}
            past = matrix(batch.column("days"), n)  # column i: i + 1 days before the first
            back, work, hour = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("back", "work", "hour"))
            out, last, latest = np.full((n, days), np.nan), np.full(n, -np.inf), np.full(n, np.nan)
            for step in range(days):
                columns = {c: x[:, step] for c, x in given.items()} | {"hour": hour}
                for name, k in (("lag_1_day", 1), ("lag_7_day", 7)):
                    columns[name] = out[:, step - k] if step >= k else past[:, k - step - 1]
                known = np.where(back <= SEARCH_DAYS - step, work, np.nan)
                columns["lag_1_business_day"] = np.where(last >= step - SEARCH_DAYS, latest, known)
                out[:, step] = model.predict(np.stack([columns[c] for c in model.features], axis=1))
                works = (given["is_weekend"][:, step] == 0) & (given["is_holiday"][:, step] == 0)
                last, latest = np.where(works, step, last), np.where(works, out[:, step], latest)
            ends = np.arange(0, n * days + 1, days, dtype=np.int32)
            values = pa.ListArray.from_arrays(ends, pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("series"), values], names=["series", "values"])

    kind = T.StructType([inputs.schema["series"], T.StructField("values", T.ArrayType(T.DoubleType()))])
    made = map_batches(inputs, run, kind).select("series", F.posexplode("values").alias("step", "prediction"))
    return made.select(
        *[F.col("series")[k].alias(k) for k in keys],
        F.date_add(F.lit(as_of), F.col("step")).alias("prediction_date"),
        F.col("series.hour").alias("prediction_hour"),
        "prediction",
    )


def _past(history: DataFrame, as_of: dt.date, keys: Sequence[str]) -> DataFrame:
    """Per series: readings of the last 7 days, and the latest one of a business day."""
    back = F.datediff(F.lit(as_of), F.col("date"))
    near = history.where(F.col("date").between(as_of - dt.timedelta(days=SEARCH_DAYS), as_of - dt.timedelta(days=1)))
    working = ~F.col("is_weekend") & ~F.col("is_holiday")
    days = [F.max(F.when(back == n, F.col("actual_power"))) for n in range(1, 8)]
    work = F.min(F.when(working, F.struct(back.alias("back"), F.col("actual_power").alias("value"))))
    # Each day has its own bit: their sum is their union as long as no day comes twice.
    bit = F.expr(f"shiftleft(1L, datediff(DATE '{as_of}', date))")
    complaint = F.raise_error(F.lit("the history holds an hour more than once"))
    return (
        near.groupBy(*keys, "hour")
        .agg(
            F.struct(F.array(*days).alias("days"), work.alias("work")).alias("__past"),
            (F.sum(bit) == F.bit_or(bit)).alias("__once"),
        )
        .where(F.when(F.col("__once"), F.lit(True)).otherwise(complaint.cast("boolean")))
        .drop("__once")
    )


_AHEAD_COLUMNS = (
    "is_weekend",
    "is_holiday",
    "month",
    "hour_sin",
    "hour_cos",
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
)


def _ahead(future: DataFrame, as_of: dt.date, keys: Sequence[str], days: int) -> DataFrame:
    """Per series: the features of each day in order. Fails unless every hour is there."""
    step = F.datediff(F.col("date"), F.lit(as_of))
    day = F.struct(*_AHEAD_COLUMNS)
    # One slot per day, combined on the map side: repeated rows cost no memory.
    per_series = (
        future.where(step.between(0, days - 1))
        .groupBy(*keys, "hour")
        .agg(
            F.array(*[F.max(F.when(step == i, day)) for i in range(days)]).alias("__ahead"),
            F.count("*").alias("__rows"),
        )
    )
    complete = (
        (F.col("__rows") == days)
        & F.forall("__ahead", lambda x: x.isNotNull())
        & F.col("hour").between(0, HOURS - 1)
    )
    # At most 24 rows per key are left here.
    hours = F.count("*").over(Window.partitionBy(*(keys or [F.lit(0)])))
    complaint = F.raise_error(F.lit("the future frame must hold every hour of every day exactly once"))
    return (
        per_series.withColumn("__hours", hours)
        .where(F.when(complete & (F.col("__hours") == HOURS), F.lit(True)).otherwise(complaint.cast("boolean")))
        .drop("__hours", "__rows")
    )


def _features_of(step: int) -> list[str]:
    """Feature columns of one forecast day, ``hour`` being in the row already."""

    def before(n: int) -> str:
        return f"__p{step - n}" if step >= n else f"__past.days[{n - step - 1}]"

    # The latest business day among the forecast days; else the latest one with a reading,
    # which must not be more than the search limit before this day.
    return [
        *[f"__ahead[{step}].{c} AS {c}" for c in _AHEAD_COLUMNS],
        f"{before(1)} AS lag_1_day",
        f"{before(7)} AS lag_7_day",
        f"""CASE WHEN __work.step >= {step - SEARCH_DAYS} THEN __work.value
            WHEN __past.work.back <= {SEARCH_DAYS - step} THEN __past.work.value END AS lag_1_business_day""",
    ]


def as_prediction_rows(forecasts: DataFrame, execution_id: str, created_at: dt.datetime, keys: Sequence[str] = ()) -> DataFrame:
    """Forecasts in the shape of the prediction table, values with two decimals."""
    return forecasts.select(
        *keys,
        F.lit(execution_id).alias("execution_id"),
        F.lit(created_at.date()).alias("prediction_run_date"),
        "prediction_date",
        "prediction_hour",
        F.bround("prediction", 2).alias("predicted_power_kwh"),
        moment(created_at).alias("created_at"),
    )
