import datetime as dt

from pyspark.sql import functions as F

from hourloom.functions import measures, times
from hourloom.operators.calendar import calendar_frame
from hourloom.plans.accuracy import prediction_accuracy
from hourloom.plans.dashboard import dashboard, dashboard_history

D, T = dt.date, dt.datetime
DAY = D(2024, 1, 30)


def _sources(spark):
    energy = spark.createDataFrame(
        [
            (DAY, 0, 80.0, 100.0, T(2024, 1, 30, 1)),
            (DAY, 0, 50.0, 100.0, T(2024, 1, 30, 2)),
            (DAY, 1, 0.0, 0.0, T(2024, 1, 30, 1)),
            (DAY, 2, -10.0, 100.0, T(2024, 1, 30, 1)),
            (DAY, 3, None, 100.0, None),
            (D(2024, 1, 20), 0, 10.0, 100.0, T(2024, 1, 20)),
        ],
        "date date, hour int, actual_power double, supply_capacity double, created_at timestamp_ntz",
    )
    weather = spark.createDataFrame(
        [("chiba", DAY, "00", 1.0, T(2024, 1, 30)), ("chiba", DAY, "00", 2.0, T(2024, 1, 31)), ("x", DAY, "01", 3.0, T(2024, 1, 30))],
        "prefecture string, date date, hour string, temperature_2m double, created_at timestamp_ntz",
    ).selectExpr("*", "0D AS relative_humidity_2m", "0D AS precipitation", "0L AS weather_code")
    predictions = spark.createDataFrame(
        [("r1", DAY, h, 40.0, T(2024, 1, 29)) for h in range(4)] + [("r2", DAY, 0, 60.0, T(2024, 1, 30))],
        "execution_id string, prediction_date date, prediction_hour int, predicted_power_kwh double, created_at timestamp_ntz",
    )
    return energy, weather, calendar_frame(spark, D(2024, 1, 1), D(2024, 1, 31)), predictions


def test_latest_versions_and_guarded_errors(spark):
    rows = dashboard(*_sources(spark), place=("prefecture", "chiba"), as_of=D(2024, 1, 31)).collect()
    got = {r["hour"]: r for r in rows}
    assert len(rows) == 4
    first = got[0]
    assert (first["actual_power"], first["predicted_power"], first["temperature_2m"]) == (50.0, 60.0, 2.0)
    assert (first["error_absolute"], first["error_percentage"], first["usage_rate"]) == (10.0, 20.0, 50.0)
    assert (first["day_of_week"], first["weekday_jp"]) == ("Tuesday", "火")
    assert (got[1]["error_absolute"], got[1]["error_percentage"], got[1]["usage_rate"]) == (40.0, None, None)
    assert (got[2]["error_percentage"], got[2]["usage_rate"]) == (None, -10.0)
    assert got[3]["error_absolute"] is None and got[1]["temperature_2m"] is None


def test_history_leaves_readings_as_they_are(spark):
    rows = dashboard_history(*_sources(spark), as_of=D(2024, 1, 31), place=("prefecture", "chiba")).collect()
    assert len(rows) == 1 + 2 * 2 + 3
    assert {r["predicted_power"] for r in rows if r["hour"] == 0 and r["date"] == DAY} == {60.0}


def test_accuracy_windows_and_negative_share(spark):
    energy, _, _, predictions = _sources(spark)
    got = {
        (r["prediction_hour"], r["execution_id"]): r
        for r in prediction_accuracy(predictions, energy.where("hour <> 0"), D(2024, 1, 31)).collect()
    }
    assert set(got) == {(1, "r1"), (2, "r1"), (3, "r1")}
    assert got[1, "r1"]["error_percentage"] is None and got[1, "r1"]["error_absolute"] == 40.0
    assert got[2, "r1"]["error_percentage"] == -500.0
    assert got[3, "r1"]["error_absolute"] is None
    assert got[2, "r1"]["days_ahead"] == 1
    # Today's targets, and runs from before the window, are left out.
    assert prediction_accuracy(predictions, energy, DAY).count() == 0
    assert prediction_accuracy(predictions, energy, D(2024, 2, 13)).where("execution_id = 'r1'").count() == 0


def test_measures(spark):
    row = spark.range(1).select(
        measures.usage_rate(F.lit(48.03), F.lit(60.0)).alias("half_up"),
        measures.weekday_label(F.lit("Caturday")).alias("unlisted"),
        measures.run_grade(F.lit(None).cast("string")).alias("none"),
        measures.error_share_of_nonzero(F.lit(1.0), F.lit(0.0)).alias("zero"),
        times.two_digits(F.lit(7)).alias("two"),
        times.two_digits(F.lit("123")).alias("three"),
        times.hour_timestamp(F.lit(DAY), F.lit(13)).alias("at"),
        times.month_key(F.lit(DAY)).alias("month"),
        times.today_in("Asia/Tokyo").alias("today"),
    ).first()
    assert row["half_up"] == 80.1 and row["unlisted"] is None and row["none"] == "WARNING" and row["zero"] is None
    assert row["two"] == "07" and row["three"] == "123" and row["month"] == "202401"
    assert row["at"] == T(2024, 1, 30, 13)
    tokyo = (dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=9)).date()
    assert abs((row["today"] - tokyo).days) <= 1
    assert abs((times.current_day(spark) - tokyo).days) <= 1
