import datetime as dt

import pytest

from hourloom.plans.quality import (
    overall_status,
    power_period,
    power_rules,
    quality_checks,
    weather_period,
    weather_rules,
)

AS_OF = dt.date(2024, 1, 31)
SCHEMA = "date date, hour int, actual_power double, supply_capacity double"


def _week(spark, change=None, drop=0, repeat=0):
    rows = [
        (AS_OF - dt.timedelta(days=d), h, 3000.0, 5000.0) for d in range(1, 8) for h in range(24)
    ]
    for i, values in enumerate(change or []):
        rows[i] = rows[i][:2] + values
    rows = rows[: len(rows) - drop] + rows[:repeat]
    # Days outside the period never count.
    rows += [(AS_OF, 0, None, None), (AS_OF - dt.timedelta(days=8), 0, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def _power(df, days=7):
    checks = quality_checks(df, "power", power_rules(), power_period(AS_OF, days), AS_OF)
    return {(r["check_type"], r["check_target"]): (r["issue_count"], r["status"]) for r in checks.collect()}


def test_a_clean_week(spark):
    got = _power(_week(spark))
    assert len(got) == 5 and set(got.values()) == {(0, "OK")}


@pytest.mark.parametrize("drop, status", [(1, "WARNING"), (23, "WARNING"), (24, "ERROR")])
def test_missing_hours(spark, drop, status):
    assert _power(_week(spark, drop=drop))["missing", "全体"] == (drop, status)


def test_repeated_hours_make_the_count_negative(spark):
    assert _power(_week(spark, repeat=30))["missing", "全体"] == (-30, "WARNING")


@pytest.mark.parametrize("n, status", [(9, "WARNING"), (10, "ERROR")])
def test_nulls(spark, n, status):
    got = _power(_week(spark, [(None, 5000.0)] * n))
    assert got["null", "actual_power"] == (n, status)
    assert got["outlier", "actual_power"] == (0, "OK") and got["outlier", "supply_capacity"] == (0, "OK")


@pytest.mark.parametrize("n, status", [(4, "WARNING"), (5, "ERROR")])
def test_outliers(spark, n, status):
    got = _power(_week(spark, [(1499.0, 10001.0)] * n))
    assert got["outlier", "actual_power"] == (n, status)
    assert got["outlier", "supply_capacity"] == (n, status)


def test_capacity_below_actual_and_low_capacity_without_actual(spark):
    got = _power(_week(spark, [(4000.0, 3000.0), (None, 100.0), (None, None), (1500.0, 10000.0)]))
    assert got["outlier", "supply_capacity"] == (2, "WARNING")
    assert got["outlier", "actual_power"] == (0, "OK")


def test_texts_and_periods(spark):
    checks = quality_checks(_week(spark, drop=2), "power", power_rules(), power_period(AS_OF, 7), AS_OF)
    text = {(r["check_type"], r["check_target"]): r["issue_detail"] for r in checks.collect()}
    assert text["missing", "全体"] == "期待レコード数: 168, 実際: 166, 欠損: 2"
    assert text["null", "actual_power"] == "actual_powerがNULLのレコード: 0件"
    assert text["outlier", "supply_capacity"] == "supply_capacityが異常範囲（<1500 or >10000 or <actual_power）: 0件"
    first = checks.first()
    assert (first["check_period_start"], first["check_period_end"]) == (dt.date(2024, 1, 24), dt.date(2024, 1, 30))
    assert weather_period(AS_OF, 7) == (dt.date(2024, 1, 24), dt.date(2024, 2, 13))


def test_no_rows_at_all_is_still_reported(spark):
    got = _power(_week(spark).where("date IS NULL"))
    assert got["missing", "全体"] == (168, "ERROR") and len(got) == 5


def test_weather_rules_and_overall_status(spark):
    df = spark.createDataFrame(
        [(AS_OF, None, 101.0, 41.0), (AS_OF, 51.0, -1.0, None)],
        "date date, temperature_2m double, relative_humidity_2m double, precipitation double",
    )
    checks = quality_checks(df, "weather", weather_rules(), weather_period(AS_OF, 7), AS_OF)
    got = {(r["check_type"], r["check_target"]): r["issue_count"] for r in checks.collect()}
    assert got == {
        ("missing", "全体"): 24 * 21 - 2,
        ("null", "temperature_2m"): 1,
        ("null", "relative_humidity_2m"): 0,
        ("outlier", "temperature_2m"): 1,
        ("outlier", "relative_humidity_2m"): 2,
        ("outlier", "precipitation"): 1,
    }
    total = overall_status(checks).first()
    assert (total["error_count"], total["warning_count"], total["ok_count"]) == (1, 4, 1)
    assert total["overall_status"] == "ERROR"
    assert overall_status(checks.where("status = 'OK'")).first()["overall_status"] == "OK"


def test_one_pass(spark):
    plan = quality_checks(
        spark.range(10).selectExpr("DATE '2024-01-30' AS date", "1D AS actual_power", "2D AS supply_capacity"),
        "power", power_rules(), power_period(AS_OF, 7), AS_OF,
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1
