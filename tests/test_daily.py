import datetime as dt
import json
from itertools import count

import pytest
from pyspark.sql import functions as F

from hourloom.operators.calendar import calendar_frame, date_lag_mapping
from hourloom.operators.dependencies import dates_needed, dates_reached, dependency_index, in_dates, stretches
from hourloom.plans import daily
from hourloom.plans.daily import Warehouse, check_quality, daily_run, load, refresh_accuracy, refresh_dashboard, refresh_features
from hourloom.plans.dashboard import dashboard
from hourloom.plans.features import LAGS, ml_features
from hourloom.plans.forecast import same_hour_last_week
from hourloom.plans.quality import power_rules, weather_rules

D = dt.date
FIRST, LAST = D(2024, 1, 1), D(2024, 3, 31)
HOLIDAY = D(2024, 1, 8)  # a Monday


@pytest.fixture(scope="module")
def calendar(spark):
    return calendar_frame(spark, FIRST, LAST, [HOLIDAY]).cache()


@pytest.fixture(scope="module")
def mapping(calendar):
    return date_lag_mapping(calendar, [1, 7], [1]).cache()


def test_stretches_and_filters(spark):
    days = [D(2024, 1, 3), D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 2), D(2024, 1, 9)]
    assert stretches(days) == [(D(2024, 1, 1), D(2024, 1, 3)), (D(2024, 1, 9), D(2024, 1, 9))] and stretches([]) == []
    df = spark.createDataFrame([(D(2024, 1, d),) for d in range(1, 11)] + [(None,)], "date date")
    assert [r["date"].day for r in df.where(in_dates(F.col("date"), days)).collect()] == [1, 2, 3, 9]
    assert df.where(in_dates(F.col("date"), [])).count() == 0


def test_dates_that_look_at_a_date(mapping, calendar):
    index = dependency_index(mapping, list(LAGS.values()))
    friday = D(2024, 1, 5)
    # Itself, the day after, a week after, and the first business day after the long weekend.
    assert dates_reached(index, [friday]) == [friday, D(2024, 1, 6), D(2024, 1, 9), D(2024, 1, 12)]
    assert dates_needed(index, [D(2024, 1, 9)]) == [D(2024, 1, 2), friday, D(2024, 1, 8), D(2024, 1, 9)]
    assert dates_reached(index, [D(2030, 1, 1)]) == [D(2030, 1, 1)] and dates_reached(index, []) == []
    carried = dependency_index(date_lag_mapping(calendar, [7], [1], carry_back=True), ["lag_7_day_date", "lag_1_business_date"])
    assert dates_reached(carried, [friday]) == [friday, *(D(2024, 1, d) for d in (6, 7, 8, 9, 12))]


def test_index_is_the_inverse_of_the_mapping(mapping):
    index = dependency_index(mapping, list(LAGS.values()))
    looks_at = {r["base_date"]: {r["base_date"], *(r[c] for c in LAGS.values())} - {None} for r in mapping.collect()}
    changed = [D(2024, 1, 3), D(2024, 2, 9), D(2024, 2, 29)]
    want = sorted({d for d, sources in looks_at.items() if sources & set(changed)})
    assert dates_reached(index, changed) == want
    assert dates_needed(index, want) == sorted(set().union(*(looks_at[d] for d in want)))


def _energy(spark, first, last, scale=1.0, hours=range(24)):
    rows = [
        ("a", first + dt.timedelta(days=i), h, scale * (100 * i + h), 5000.0, dt.datetime(2024, 1, 1))
        for i in range((last - first).days + 1)
        for h in hours
    ]
    schema = "site string, date date, hour int, actual_power double, supply_capacity double, created_at timestamp_ntz"
    return spark.createDataFrame(rows, schema)


def _weather(spark, first, last):
    return _energy(spark, first, last).select(
        "site", "date", F.format_string("%02d", "hour").alias("hour"), F.lit(20.0).alias("temperature_2m"),
        F.lit(50.0).alias("relative_humidity_2m"), F.lit(0.0).alias("precipitation"), F.lit(1).cast("long").alias("weather_code"),
        "created_at",
    )


def _warehouse(spark, tmp_path, calendar, mapping):
    tick = count()
    return Warehouse(
        spark, str(tmp_path / "w"), calendar, mapping, ["site"], power_rules=power_rules(), weather_rules=weather_rules(),
        clock=lambda: dt.datetime(2024, 2, 1) + dt.timedelta(seconds=next(tick)),
    )


def _same(a, b):
    columns = sorted(a.columns)
    return sorted(map(str, a.select(*columns).collect())) == sorted(map(str, b.select(*columns).collect()))


def _whole(w):
    return ml_features(w.energy.read(), w.weather.read(), w.cal, w.mapping, keys=["site"], unique=True)


def test_a_late_day_makes_only_what_looks_at_it(spark, tmp_path, calendar, mapping):
    w = _warehouse(spark, tmp_path, calendar, mapping)
    load(w.energy, [_energy(spark, D(2024, 1, 2), D(2024, 1, 20))])
    load(w.weather, [_weather(spark, D(2024, 1, 2), D(2024, 1, 20))])
    refresh_features(w)
    assert _same(w.features.read(), _whole(w))
    w.features.take_note("watch", w.features.changes("watch").upto)
    load(w.energy, [_energy(spark, D(2024, 1, 5), D(2024, 1, 5), 7.0, range(5))])
    refresh_features(w)
    assert w.features.changes("watch").dates == [D(2024, 1, d) for d in (5, 6, 9, 12)]
    assert _same(w.features.read(), _whole(w))
    assert refresh_features(w) == 0 and len(w.features.changes("watch").dates) == 4  # nothing new, nothing made


def test_a_day_that_goes_leaves_the_marts(spark, tmp_path, calendar, mapping):
    w = _warehouse(spark, tmp_path, calendar, mapping)
    load(w.energy, [_energy(spark, D(2024, 1, 2), D(2024, 1, 9))])
    load(w.weather, [_weather(spark, D(2024, 1, 2), D(2024, 1, 9))])
    w.predictions.append(
        spark.createDataFrame([], "site string, execution_id string, prediction_run_date date, prediction_date date, "
                              "prediction_hour int, predicted_power_kwh double, created_at timestamp_ntz")
    )
    refresh_features(w)
    w.energy.replace_window(w.energy.read().limit(0), D(2024, 1, 4), D(2024, 1, 4))
    refresh_features(w)
    assert _same(w.features.read(), _whole(w))
    assert w.features.read().where("date = '2024-01-04'").count() == 0


def test_a_stopped_mart_is_made_by_the_next_call(spark, tmp_path, calendar, mapping, monkeypatch):
    w = _warehouse(spark, tmp_path, calendar, mapping)
    load(w.energy, [_energy(spark, D(2024, 1, 2), D(2024, 1, 9))])
    load(w.weather, [_weather(spark, D(2024, 1, 2), D(2024, 1, 9))])
    with monkeypatch.context() as patch:
        patch.setattr(daily, "_noted", lambda *_: (_ for _ in ()).throw(RuntimeError("stop")))
        with pytest.raises(RuntimeError):
            refresh_features(w)
    assert refresh_features(w) == 8 * 24  # written but not noted: made again
    assert _same(w.features.read(), _whole(w))


def test_days_in_a_row(spark, tmp_path, calendar, mapping):
    w = _warehouse(spark, tmp_path, calendar, mapping)
    first, second = D(2024, 1, 25), D(2024, 1, 26)
    past = _energy(spark, D(2024, 1, 2), D(2024, 1, 24))
    daily_run(w, first, [past], [_weather(spark, D(2024, 1, 2), D(2024, 2, 7))], same_hour_last_week)
    broken = past.withColumn("actual_power", F.raise_error(F.lit("bad file")).cast("double"))
    with pytest.raises(Exception, match="bad file"):
        daily_run(w, second, [broken], [], same_hour_last_week)
    board = spark.read.parquet(w.status_path).first()
    assert board["tepco_api_status"] == "ERROR" and "bad file" in board["tepco_api_message"]
    assert board["dashboard_update_status"] == "OK"  # of the day before
    late = _energy(spark, D(2024, 1, 19), D(2024, 1, 19), 3.0)
    new = [_energy(spark, first, first, 2.0), late]
    for _ in range(2):  # the second time everything is there already
        daily_run(w, second, new, [_weather(spark, second, D(2024, 2, 8))], same_hour_last_week)
        assert _same(w.features.read(), _whole(w))
        whole = dashboard(w.energy.read(), w.weather.read(), w.cal, w.predictions.read(), keys=["site"])
        assert _same(w.dashboard.read(), whole)
        assert w.predictions.read().count() == 2 * 336
        done = w.accuracy.read()
        assert done.count() == 24 and {r["actual_power"] for r in done.where("prediction_hour = 3").collect()} == {6.0}
        assert w.findings.read().groupBy("check_date").count().collect()[0]["count"] == 11
    board = spark.read.parquet(w.status_path).first()
    assert {board[c] for c in board.asDict() if c.endswith("_status") and c != "data_quality_status"} == {"OK"}
    assert w.log().where("status = 'FAILED'").count() == 1 and w.log().count() == 7 + 1 + 14
    lines = [json.loads(x) for p in (tmp_path / "w" / f"findings-{second}").glob("part*") for x in p.read_text().splitlines()]
    assert len(lines) == 11 and set(lines[0]) == set(w.findings.read().columns)


def test_a_late_reading_reaches_the_runs_that_forecast_it(spark, tmp_path, calendar, mapping):
    w = _warehouse(spark, tmp_path, calendar, mapping)
    load(w.energy, [_energy(spark, D(2024, 1, 2), D(2024, 1, 9))])
    runs = [
        ("a", f"r{r}", D(2024, 1, r), D(2024, 1, d), 5, 10.0, dt.datetime(2024, 1, r)) for r, d in ((3, 4), (3, 8), (4, 9), (5, 8))
    ]
    schema = "site string, execution_id string, prediction_run_date date, prediction_date date, prediction_hour int, predicted_power_kwh double, created_at timestamp_ntz"
    w.predictions.append(spark.createDataFrame(runs, schema))
    assert refresh_accuracy(w, D(2024, 1, 20)) == 4
    w.accuracy.take_note("watch", w.accuracy.changes("watch").upto)
    load(w.energy, [_energy(spark, D(2024, 1, 8), D(2024, 1, 8), 9.0)])
    refresh_accuracy(w, D(2024, 1, 20))
    assert w.accuracy.changes("watch").dates == [D(2024, 1, 3), D(2024, 1, 5)]
    got = {(r["execution_id"], r["prediction_date"].day): r["actual_power"] for r in w.accuracy.read().collect()}
    assert got == {("r3", 4): 205.0, ("r3", 8): 45.0, ("r4", 9): 705.0, ("r5", 8): 45.0}


def test_only_touched_partitions_are_scanned(spark, tmp_path, calendar, mapping):
    w = _warehouse(spark, tmp_path, calendar, mapping)
    load(w.energy, [_energy(spark, D(2024, 1, 2), D(2024, 1, 20))])
    plan = w.energy.read().where(in_dates(F.col("date"), [D(2024, 1, 5), D(2024, 1, 6)]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert filters.count("date#") >= 2 and plan.count() == 48
