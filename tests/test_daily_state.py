import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourloom.operators import daily_state as ds
from hourloom.operators import profile
from hourloom.operators.refresh import DatedTable

D = dt.date
SCHEMA = "date date, a double, b string, c int, is_holiday boolean"
COLUMNS, TYPES = ["a", "b", "c"], {"a": "double", "b": "string", "c": "int"}


def _frame(spark, days=range(1, 11), scale=1.0):
    rows = [
        (D(2024, 1, d), None if (i + d) % 4 == 0 else scale * (i * d % 97), None if i % 5 == 0 else "x", None if i % 20 == 0 else i, d == 5)
        for d in days
        for i in range(60)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def state(spark, tmp_path):
    table = DatedTable(spark, str(tmp_path / "t"))
    table.create(_frame(spark))
    return ds.DailyState(table, str(tmp_path / "state"), COLUMNS, ["a", "c"], "is_holiday")


def _equal(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def _reports(state, first=None, last=None):
    rows = state.source.read()
    for limit, keep in ((first, F.col("date") >= F.lit(first)), (last, F.col("date") <= F.lit(last))):
        rows = rows if limit is None else rows.where(keep)
    days = state.days(first, last)
    _equal(ds.null_profile_of(days, TYPES), profile.null_profile(rows, COLUMNS))
    _equal(ds.missing_summary_of(days, 3), profile.missing_summary(rows, COLUMNS))
    _equal(ds.missing_by_day_of(days, COLUMNS), profile.missing_by_day(rows, COLUMNS))
    _equal(ds.missing_verdict_of(days, 3), profile.missing_verdict(rows, COLUMNS))
    _equal(ds.gaps_by_previous_day_of(days, "a"), profile.gaps_by_previous_day(rows, "a"))
    mine = ds.range_profile_of(days, {"a": {}, "c": {}})
    _equal(mine, profile.range_profile(rows.withColumn("c", F.col("c").cast("double")), {"a": {}, "c": {}}))


def test_reports_equal_a_scan(state):
    assert len(state.refresh()) == 10
    _reports(state)
    _reports(state, D(2024, 1, 4), D(2024, 1, 7))
    _reports(state, D(2030, 1, 1))  # no days at all


def test_only_replaced_days_are_made_again(spark, state):
    state.refresh()
    state.table.take_note("watch", state.table.changes("watch").upto)
    state.source.replace_window(_frame(spark, [4], 9.0), D(2024, 1, 4), D(2024, 1, 5))
    assert state.refresh() == [D(2024, 1, 4), D(2024, 1, 5)] and state.refresh() == []
    assert state.table.changes("watch").dates == [D(2024, 1, 4), D(2024, 1, 5)]
    assert state.days(D(2024, 1, 5), D(2024, 1, 5)).count() == 0
    _reports(state)


def test_a_report_reads_no_rows_of_the_table(state):
    state.refresh()
    plan = ds.null_profile_of(state.days(), TYPES)._jdf.queryExecution().executedPlan().toString()
    assert state.table.path in plan and state.source.path + "]" not in plan


def test_quantiles_from_merged_sketches(spark, tmp_path):
    table = DatedTable(spark, str(tmp_path / "t"))
    rows = spark.range(60_000).select(
        F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % 6).cast("int")).alias("date"), ((F.col("id") * 7919) % 60_000).cast("double").alias("a")
    )
    table.create(rows)
    state = ds.DailyState(table, str(tmp_path / "state"), ["a"], ["a"])
    state.refresh()
    shares = {f"p{i}": i / 100 for i in (1, 25, 50, 99)}
    for days in (6, 2):
        last = D(2024, 1, days)
        got = ds.range_profile_of(state.days(last=last), {"a": shares}).first()
        kept = sorted(r["a"] for r in rows.where(F.col("date") <= F.lit(last)).collect())
        for name, q in shares.items():
            assert abs(sum(x <= got[f"a_{name}"] for x in kept) / len(kept) - q) < 0.01


def test_odd_values(spark, tmp_path):
    table = DatedTable(spark, str(tmp_path / "t"))
    table.create(spark.createDataFrame([(D(2024, 1, 1), None), (D(2024, 1, 2), float("nan")), (D(2024, 1, 3), 2.0), (None, 5.0)], "date date, a double"))
    state = ds.DailyState(table, str(tmp_path / "state"), ["a"], ["a"])
    state.refresh()
    got = ds.range_profile_of(state.days(), {"a": {"median": 0.5}}).first()
    assert got.asDict() == {"a_min": 2.0, "a_max": 2.0, "a_avg": 2.0, "a_median": 2.0, "a_nulls": 2}
    none = ds.range_profile_of(state.days(D(2024, 1, 1), D(2024, 1, 1)), {"a": {"median": 0.5}}).first()
    assert none["a_median"] is None and none["a_nulls"] == 1
