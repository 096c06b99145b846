import datetime as dt

import pytest

from hourloom.operators import calendar as subject
from hourloom.operators.calendar import calendar_frame, calendar_spanning, date_lag_mapping, number_business_days

D = dt.date
NEW_YEAR = [D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)]


@pytest.fixture(scope="module")
def cal(spark):
    return calendar_frame(spark, D(2023, 12, 20), D(2024, 3, 5), NEW_YEAR).cache()


def _business(rows):
    return sorted(r["date"] for r in rows if not r["is_weekend"] and not r["is_holiday"])


def test_calendar_names_and_flags(cal):
    days = {r["date"]: r for r in cal.collect()}
    assert len(days) == 77
    assert days[D(2023, 12, 23)]["day_of_week"] == "Saturday" and days[D(2023, 12, 23)]["is_weekend"]
    assert days[D(2024, 1, 1)]["day_of_week"] == "Monday" and days[D(2024, 1, 1)]["is_holiday"]
    assert D(2024, 2, 29) in days


def test_calendar_spans_whole_months_around_the_data(spark):
    rows = spark.createDataFrame([(D(2024, 1, 15),), (D(2024, 2, 3),)], "date date")
    days = sorted(r["date"] for r in calendar_spanning(rows, "date").collect())
    assert (days[0], days[-1]) == (D(2023, 12, 1), D(2024, 3, 31))


def test_business_days_are_numbered_over_the_year_end(cal):
    got = {r["date"]: r["n"] for r in number_business_days(cal).collect()}
    assert got == {d: i for i, d in enumerate(_business(cal.collect()), start=1)}


@pytest.mark.parametrize("group_days", [1024, 3])
def test_lags_against_a_list(cal, monkeypatch, group_days):
    monkeypatch.setattr(subject, "_GROUP_DAYS", group_days)
    business = _business(cal.collect())
    for r in date_lag_mapping(cal).collect():
        base = r["base_date"]
        for k in range(1, 31):
            assert r[f"lag_{k}_day_date"] == base - dt.timedelta(days=k)
            want = None
            if base in business and business.index(base) >= k:
                want = business[business.index(base) - k]
            assert r[f"lag_{k}_business_date"] == want


def test_long_holiday_is_skipped(cal):
    got = {r["base_date"]: r["lag_1_business_date"] for r in date_lag_mapping(cal, [], [1]).collect()}
    assert got[D(2024, 1, 4)] == D(2023, 12, 29)
    assert got[D(2024, 1, 6)] is None
    assert got[D(2023, 12, 20)] is None


def test_carried_back_lags_against_a_list(cal):
    business = _business(cal.collect())
    for r in date_lag_mapping(cal, [], [1, 4], carry_back=True).collect():
        before = [d for d in business if d < r["base_date"]]
        assert r["lag_1_business_date"] == (before[-1] if before else None)
        assert r["lag_4_business_date"] == (before[-4] if len(before) >= 4 else None)
