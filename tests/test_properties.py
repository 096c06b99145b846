"""Random small inputs against plain Python."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hourloom.operators.calendar import calendar_frame, date_lag_mapping
from hourloom.operators.lags import lag_by_date
from hourloom.operators.latest import latest_per_key
from hourloom.operators.refresh import outside_range
from hourloom.plans.features import LAGS
from pyspark.sql import functions as F

START = dt.date(2024, 1, 1)
FEW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)
days = st.integers(0, 40)
values = st.one_of(st.none(), st.integers(-5, 5).map(float))


def _day(n):
    return START + dt.timedelta(days=n)


@FEW
@given(rows=st.lists(st.tuples(st.sampled_from("ab"), days, st.integers(0, 2), values), max_size=60), holidays=st.sets(days, max_size=8))
def test_lags(spark, rows, holidays):
    rows = [(k, _day(d), h, v) for k, d, h, v in rows]
    off = [_day(n) for n in holidays]
    mapping = date_lag_mapping(calendar_frame(spark, START, _day(35), off), [1, 7], [1])
    work = [_day(n) for n in range(36) if _day(n).weekday() < 5 and _day(n) not in off]

    def lagged(day):
        if day > _day(35):
            return None, None, None
        i = work.index(day) if day in work else 0
        return day - dt.timedelta(1), day - dt.timedelta(7), work[i - 1] if i else None

    def at(k, day, h):
        return [r[3] for r in rows if day is not None and r[:3] == (k, day, h)] or [None]

    want = [
        (k, d, h, v, a, b, c)
        for k, d, h, v in rows
        for a in at(k, lagged(d)[0], h)
        for b in at(k, lagged(d)[1], h)
        for c in at(k, lagged(d)[2], h)
    ]
    df = spark.createDataFrame(rows, "k string, date date, hour int, v double")
    got = [tuple(r) for r in lag_by_date(df, mapping, "v", LAGS, ["k", "hour"]).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    if len({r[:3] for r in rows}) == len(rows):
        got = [tuple(r) for r in lag_by_date(df, mapping, "v", LAGS, ["k", "hour"], unique=True).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


@FEW
@given(rows=st.lists(st.tuples(st.sampled_from("aaab"), st.one_of(st.none(), days), st.integers(0, 3)), max_size=60))
def test_latest(spark, rows):
    rows = [(k, None if d is None else dt.datetime.combine(_day(d), dt.time()), v) for k, d, v in rows]
    df = spark.createDataFrame(rows, "k string, created_at timestamp_ntz, v int").repartition(3)
    want = {}
    for k, at, v in rows:
        want[k] = max(want.get(k, (dt.datetime.min, -1)), (at or dt.datetime.min, v))
    got = {r["k"]: (r["created_at"] or dt.datetime.min, r["v"]) for r in latest_per_key(df, ["k"]).collect()}
    assert got == want


@FEW
@given(rows=st.lists(st.tuples(days, st.sampled_from(["a", "b", None])), max_size=40), first=days, length=st.integers(0, 10))
def test_outside_range(spark, rows, first, length):
    df = spark.createDataFrame([(_day(d), k) for d, k in rows], "date date, k string")
    low, high = _day(first), _day(first + length)
    kept = outside_range(df, F.lit(low), F.lit(high), "date", ("k", "a"))
    want = [(_day(d), k) for d, k in rows if not (low <= _day(d) <= high and k == "a")]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)
