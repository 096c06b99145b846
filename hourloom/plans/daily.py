"""The daily run over stored tables: load, marts, findings, forecast, accuracy, dashboard, board.

Derived tables follow their sources by what changed. A source tells which dates its last
loads changed; the dependency index says which dates of a mart look at them; exactly these
partitions are made again, from the source dates they need. So a file that arrives weeks
late costs the days it reaches, and after every run each mart equals one made from all the
sources there are. A mart takes note of changes after it was written: a run that stops in between
makes the same partitions again. Each phase is logged with its outcome; a failing one ends
the run, and the next run picks up where it stopped.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.functions.times import day
from hourloom.operators.dependencies import dates_needed, dates_reached, dependency_index, in_dates
from hourloom.operators.joins import small_side
from hourloom.operators.refresh import Changes, DatedTable, append, replace_snapshot
from hourloom.plans.accuracy import prediction_accuracy
from hourloom.plans.dashboard import dashboard
from hourloom.plans.features import LAGS, future_features, ml_features
from hourloom.plans.forecast import Predictor, as_prediction_rows, forecast
from hourloom.plans.quality import Rule, power_period, quality_checks, weather_period
from hourloom.plans.status import PROCESSES, system_status
from hourloom.sources.tables import export_jsonl

#: Days of readings that the quality checks of a run look at.
CHECK_DAYS = 7

LOG = (
    "execution_id string, date date, process_type string, status string, error_message string, "
    "started_at timestamp_ntz, completed_at timestamp_ntz, duration_seconds double, records_processed bigint"
)


@dataclass
class Warehouse:
    """The stored tables of one installation, all under ``root``.

    keys: columns, such as a site, that tell series apart. cal and mapping cover all dates
    that are loaded or forecast. A clock other than the system's makes logs repeatable.
    """

    spark: SparkSession
    root: str
    cal: DataFrame
    mapping: DataFrame
    keys: Sequence[str] = ()
    place: tuple[str, str] | None = None
    power_rules: Sequence[Rule] = ()
    weather_rules: Sequence[Rule] = ()
    clock: Callable[[], dt.datetime] = dt.datetime.now

    def _table(self, name: str, date: str = "date") -> DatedTable:
        return DatedTable(self.spark, f"{self.root}/{name}", date=date)

    def __post_init__(self):
        self.energy, self.weather = self._table("energy"), self._table("weather")
        self.features, self.dashboard = self._table("features"), self._table("dashboard")
        self.predictions = self._table("predictions", "prediction_run_date")
        self.accuracy = self._table("accuracy", "prediction_run_date")
        self.findings = self._table("findings", "check_date")
        self.log_path, self.status_path = f"{self.root}/run_log", f"{self.root}/status"

    @property
    def index(self) -> DataFrame:
        return dependency_index(self.mapping, list(LAGS.values()))

    def log(self) -> DataFrame:
        return self.spark.read.schema(LOG).parquet(self.log_path)


def load(table: DatedTable, batches: Iterable[DataFrame], key: tuple[str, object] | None = None) -> int:
    """Load batches one after the other, each replacing the dates it spans; returns the rows."""
    return sum(table.replace_loaded_range(batch, key).inserted for batch in batches)


def follow(target: DatedTable, made: Callable[[list[dt.date]], DataFrame], dates: list[dt.date]) -> int:
    """Make these dates of a mart again."""
    return target.replace_dates(made(dates), dates).inserted if dates else 0


def refresh_features(w: Warehouse) -> int:
    """The feature mart after all changes of readings and weather since the last call."""
    readings, weather = w.energy.changes("features"), w.weather.changes("features")
    dates = sorted({*dates_reached(w.index, readings.dates), *weather.dates})

    def made(days: list[dt.date]) -> DataFrame:
        rows = ml_features(
            w.energy.read().where(in_dates(F.col("date"), dates_needed(w.index, days))),
            w.weather.read().where(in_dates(F.col("date"), days)),
            w.cal,
            w.mapping,
            w.place,
            w.keys,
            unique=True,
        )
        return rows.where(in_dates(F.col("date"), days))

    n = follow(w.features, made, dates)
    _noted("features", (w.energy, readings), (w.weather, weather))
    return n


def refresh_dashboard(w: Warehouse) -> int:
    """The dashboard mart after all changes of readings, weather and forecasts since the last call."""
    readings, weather, runs = (t.changes("dashboard") for t in (w.energy, w.weather, w.predictions))
    forecasts = _days_of(w.predictions, "prediction_date", F.col("prediction_run_date"), runs.dates)
    dates = sorted({*readings.dates, *weather.dates, *forecasts})

    def made(days: list[dt.date]) -> DataFrame:
        return dashboard(
            w.energy.read().where(in_dates(F.col("date"), days)),
            w.weather.read().where(in_dates(F.col("date"), days)),
            w.cal,
            w.predictions.read().where(in_dates(F.col("prediction_date"), days)),
            w.place,
            w.keys,
        )

    n = follow(w.dashboard, made, dates)
    _noted("dashboard", (w.energy, readings), (w.weather, weather), (w.predictions, runs))
    return n


def refresh_accuracy(w: Warehouse, as_of: dt.date) -> int:
    """The accuracy table after all changes of forecasts and readings since the last call.

    A changed day of readings reaches all runs that forecast it.
    """
    runs, readings = w.predictions.changes("accuracy"), w.energy.changes("accuracy")
    reached = _days_of(w.predictions, "prediction_run_date", F.col("prediction_date"), readings.dates)
    dates = sorted({*runs.dates, *reached})

    def made(days: list[dt.date]) -> DataFrame:
        wanted = w.predictions.read().where(in_dates(F.col("prediction_run_date"), days))
        targets = _days_of(w.predictions, "prediction_date", F.col("prediction_run_date"), days)
        actual = w.energy.read().where(in_dates(F.col("date"), targets))
        return prediction_accuracy(wanted, actual, as_of, w.keys, days=None)

    n = follow(w.accuracy, made, dates)
    _noted("accuracy", (w.predictions, runs), (w.energy, readings))
    return n


def check_quality(w: Warehouse, as_of: dt.date, days: int = CHECK_DAYS) -> int:
    """Findings of the day, stored in place of earlier ones of it, and exported as JSON lines."""
    power = quality_checks(w.energy.read(), "power", w.power_rules, power_period(as_of, days), as_of, by=w.keys)
    weather = quality_checks(w.weather.read(), "weather", w.weather_rules, weather_period(as_of, days), as_of, by=w.keys)
    n = w.findings.replace_window(power.unionByName(weather), as_of, as_of).inserted
    export_jsonl(w.findings.read().where(F.col("check_date") == day(as_of)), f"{w.root}/findings-{as_of}")
    return n


def publish_forecast(w: Warehouse, as_of: dt.date, predictor: Predictor) -> int:
    """The forecast from ``as_of`` on, stored in place of an earlier one of the same run."""
    history = w.energy.read().join(small_side(w.cal), "date", "left")
    future = future_features(w.weather.read(), w.cal, as_of, w.place, w.keys)
    made = forecast(predictor, history, future, as_of, w.keys)
    run = f"run-{as_of}"
    rows = as_prediction_rows(made, run, dt.datetime.combine(as_of, dt.time(7)), w.keys)
    return w.predictions.replace_window(rows, as_of, as_of, ("execution_id", run)).inserted


def update_board(w: Warehouse, as_of: dt.date, processes=PROCESSES) -> int:
    replace_snapshot(system_status(w.log(), w.findings.read(), as_of, processes), w.status_path)
    return 1


def daily_run(
    w: Warehouse,
    as_of: dt.date,
    power: Sequence[DataFrame],
    weather: Sequence[DataFrame],
    predictor: Predictor,
) -> None:
    """All phases of one day, in order; ``power`` and ``weather`` are the day's files."""
    phases = [
        ("TEPCO_API", lambda: load(w.energy, power)),
        ("WEATHER_API", lambda: load(w.weather, weather, w.place)),
        ("ML_FEATURES_UPDATE", lambda: refresh_features(w)),
        ("DATA_QUALITY_CHECK", lambda: check_quality(w, as_of)),
        ("ML_PREDICTION", lambda: publish_forecast(w, as_of, predictor)),
        ("PREDICTION_ACCURACY_UPDATE", lambda: refresh_accuracy(w, as_of)),
        ("DASHBOARD_UPDATE", lambda: refresh_dashboard(w)),
    ]
    entries = []
    try:
        for name, phase in phases:
            started, error, records = w.clock(), None, None
            try:
                records = phase()
            except Exception as problem:
                error = str(problem)
                raise
            finally:
                ended = w.clock()
                entries.append((name, error, started, ended, records))
    finally:
        _write_log(w, as_of, entries)
        update_board(w, as_of)


def _write_log(w: Warehouse, as_of: dt.date, entries) -> None:
    rows = [
        (f"{name}-{started.isoformat()}", as_of, name, "FAILED" if error else "SUCCESS", error, started, ended, None, records)
        for name, error, started, ended, records in entries
    ]
    log = w.spark.createDataFrame(rows, LOG)
    seconds = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("completed_at")) / 1000000.0
    append(log.withColumn("duration_seconds", seconds), w.log_path)


def _days_of(table: DatedTable, wanted: str, by: Column, days: list[dt.date]) -> list[dt.date]:
    """Distinct dates of one column where another is one of these: one row per day."""
    if not days or not table.exists():
        return []
    found = table.read().where(in_dates(by, days)).select(wanted).distinct().collect()
    return sorted(r[wanted] for r in found if r[wanted] is not None)


def _noted(reader: str, *followed: tuple[DatedTable, Changes]) -> None:
    for table, changes in followed:
        if table.exists():
            table.take_note(reader, changes.upto)
