import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourloom.operators.calendar import calendar_frame
from hourloom.plans.features import future_features
from hourloom.plans.forecast import as_prediction_rows, forecast, same_hour_last_week, train, tree_predictor

D = dt.date
AS_OF = D(2024, 1, 16)
HOLIDAYS = [D(2024, 1, 8), D(2024, 1, 18), D(2024, 1, 19)]


def _day(n):
    return AS_OF + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def cal(spark):
    return calendar_frame(spark, D(2023, 12, 1), D(2024, 2, 29), HOLIDAYS).cache()


def _value(day, hour, site):
    return float((day.toordinal() * 37 + hour * 11 + site * 5) % 1000)


def _history_rows(skip=()):
    return [
        (s, _day(-n), h, _value(_day(-n), h, s))
        for s in (1, 2)
        for n in range(1, 30)
        for h in range(24)
        if (s, n, h) not in skip
    ]


def _history(spark, cal, rows):
    return spark.createDataFrame(rows, "site int, date date, hour int, actual_power double").join(cal, "date", "left")


def _future(spark, cal, drop=None, days=14):
    rows = [
        (s, _day(n), f"{h:02d}", 1.0, 2.0, None, 3)
        for s in (1, 2)
        for n in range(days)
        for h in range(24)
        if (s, n, h) != drop
    ]
    weather = spark.createDataFrame(
        rows,
        "site int, date date, hour string, temperature_2m double, relative_humidity_2m double, precipitation double, weather_code bigint",
    )
    return future_features(weather, cal, AS_OF, keys=["site"])


def _mix(df):
    return df.withColumn(
        "prediction",
        F.coalesce("lag_1_day", F.lit(0.0)) * 0.5
        + F.coalesce("lag_7_day", F.lit(0.0)) * 0.25
        + F.coalesce("lag_1_business_day", F.lit(0.0)) * 0.25,
    )


def _by_hand(rows, days):
    """The same recursion, hour by hour."""
    read = {(s, d, h): v for s, d, h, v in rows}
    work = {_day(n) for n in range(-60, 60) if _day(n).weekday() < 5 and _day(n) not in HOLIDAYS}
    told = {}
    for n in range(days):
        for s in (1, 2):
            for h in range(24):
                day = _day(n)

                def known(d):
                    return told.get((s, d, h), read.get((s, d, h)))

                business = None
                for back in range(1, 21):
                    d = day - dt.timedelta(days=back)
                    recent = (s, d, h) in read and d >= _day(-20)
                    if d in work and ((s, d, h) in told or recent):
                        business = known(d)
                        break
                a, b = known(day - dt.timedelta(days=1)), known(day - dt.timedelta(days=7))
                told[s, day, h] = (a or 0.0) * 0.5 + (b or 0.0) * 0.25 + (business or 0.0) * 0.25
    return told


@pytest.mark.parametrize(
    "skip",
    [
        set(),
        # No business day is read nearer than 19 days back, and some lags are unknown.
        {(1, n, h) for n in range(1, 19) for h in range(24)} | {(2, 1, 5), (2, 7, 5)},
    ],
)
def test_recursion_against_a_plain_loop(spark, cal, skip):
    rows = _history_rows(skip)
    out = forecast(_mix, _history(spark, cal, rows), _future(spark, cal), AS_OF, ["site"])
    got = {(r["site"], r["prediction_date"], r["prediction_hour"]): r["prediction"] for r in out.collect()}
    assert got == _by_hand(rows, 14)


def test_last_week_turns_to_forecasts_on_the_eighth_day(spark, cal):
    rows = _history_rows()
    out = forecast(same_hour_last_week, _history(spark, cal, rows), _future(spark, cal), AS_OF, ["site"])
    got = {(r["prediction_date"], r["prediction_hour"]): r["prediction"] for r in out.where("site = 1").collect()}
    assert got[_day(6), 3] == _value(_day(-1), 3, 1)
    assert got[_day(7), 3] == got[_day(0), 3] == _value(_day(-7), 3, 1)
    assert len(got) == 336


@pytest.mark.parametrize("drop", [(1, 3, 5), (2, 13, 23)])
def test_a_missing_hour_fails(spark, cal, drop):
    out = forecast(same_hour_last_week, _history(spark, cal, _history_rows()), _future(spark, cal, drop), AS_OF, ["site"])
    with pytest.raises(Exception, match="every hour"):
        out.collect()


def test_a_whole_missing_series_fails(spark, cal):
    future = _future(spark, cal).where("NOT (site = 2 AND hour = 7)")
    with pytest.raises(Exception, match="every hour"):
        forecast(same_hour_last_week, _history(spark, cal, _history_rows()), future, AS_OF, ["site"]).collect()


def test_a_repeated_reading_fails(spark, cal):
    rows = _history_rows()
    history = _history(spark, cal, [*rows, (1, _day(-9), 4, 1.0)])
    with pytest.raises(Exception, match="more than once"):
        forecast(same_hour_last_week, history, _future(spark, cal), AS_OF, ["site"]).collect()


def test_no_key_column(spark, cal):
    history = _history(spark, cal, _history_rows()).where("site = 1").drop("site")
    future = _future(spark, cal).where("site = 1").drop("site")
    out = forecast(same_hour_last_week, history, future, AS_OF)
    assert out.columns == ["prediction_date", "prediction_hour", "prediction"] and out.count() == 336


def test_trees_end_to_end_without_a_join_per_day(spark, cal):
    history = (
        _history(spark, cal, _history_rows())
        .withColumns({"month": F.month("date").cast("long"), "hour_sin": F.sin("hour"), "hour_cos": F.cos("hour")})
        .withColumns({"temperature_2m": F.lit(1.0), "relative_humidity_2m": F.lit(float("nan")), "precipitation": F.lit(None).cast("double")})
        .withColumns({c: F.lit(None).cast("double") for c in ("lag_7_day", "lag_1_business_day")})
        .withColumn("lag_1_day", F.col("actual_power"))
    )
    model = train(history, AS_OF, trees=3, depth=3)
    out = forecast(tree_predictor(model), history, _future(spark, cal), AS_OF, ["site"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Two joins put the calendar on history and future, one brings these together.
    assert plan.count("Join") == 3 and "Python" not in plan
    rows = as_prediction_rows(out, "id", dt.datetime(2024, 1, 16, 7), ["site"]).collect()
    assert len(rows) == 2 * 336
    assert all(r["predicted_power_kwh"] == round(r["predicted_power_kwh"], 2) for r in rows)
    assert rows[0]["prediction_run_date"] == AS_OF
