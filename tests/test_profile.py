import datetime as dt

import pytest

from hourloom.operators.profile import (
    assert_not_null,
    count_gaps_by_previous_day,
    gaps_by_previous_day,
    missing_by_day,
    missing_summary,
    missing_verdict,
    null_counts,
    null_profile,
    range_profile,
    worst_days,
)

D = dt.date


def _frame(spark, rows):
    return spark.createDataFrame(rows, "date date, a double, b double, c double, d double")


def test_range_profile(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)] + [(None,), (-5.0,)], "a double")
    row = range_profile(df, {"a": {"median": 0.5, "p95": 0.95}}, ["a"], "n").first()
    assert (row["a_min"], row["a_max"], row["a_nulls"], row["a_negative_count"], row["n"]) == (-5.0, 100.0, 1, 1, 102)
    assert (row["a_median"], row["a_p95"]) == (50.0, 95.0)


def test_null_profile_is_sorted_and_typed(spark):
    rows = null_profile(_frame(spark, [(D(2024, 1, 1), None, 1.0, None, 1.0), (D(2024, 1, 1), None, 1.0, 1.0, 1.0)])).collect()
    assert [(r["column"], r["missing_count"], r["missing_percentage"]) for r in rows[:2]] == [("a", 2, 100.0), ("c", 1, 50.0)]
    assert rows[2]["column"] == "b" and rows[0]["data_type"] == "double"


def test_summary_of_rows(spark):
    df = _frame(spark, [(None, None, None, None, None), (D(2024, 1, 1), 1.0, None, 1.0, 1.0), (D(2024, 1, 1), 1.0, 1.0, 1.0, 1.0)])
    row = missing_summary(df).first()
    assert (row["total_rows"], row["total_cells"], row["total_missing"]) == (3, 15, 6)
    assert (row["complete_rows"], row["partial_rows"], row["empty_rows"]) == (1, 1, 1)
    assert row["missing_percentage"] == 40.0
    assert missing_summary(df.limit(0)).first()["total_missing"] == 0


def test_days_and_the_worst_of_them(spark):
    rows = [(D(2024, 1, d), None if i < d else 1.0, 1.0, None if i < 1 else 1.0, 1.0) for d in (1, 2, 3) for i in range(4)]
    rows += [(D(2024, 1, 4), 1.0, 1.0, 1.0, 1.0)]
    by_day = missing_by_day(_frame(spark, rows), ["a", "b", "c", "d"])
    got = {r["day"].day: (r["missing_rows"], r["missing_cells"], r["a_missing"], r["c_missing"]) for r in by_day.collect()}
    assert got == {1: (1, 2, 1, 1), 2: (2, 3, 2, 1), 3: (3, 4, 3, 1), 4: (0, 0, 0, 0)}
    assert [r["day"].day for r in worst_days(by_day, "missing_cells", 2).collect()] == [3, 2]
    assert worst_days(by_day, "missing_rows", 10).count() == 3


@pytest.mark.parametrize(
    "row, pattern",
    [
        ((None, None, None, None, None), "all"),
        ((D(2024, 1, 1), None, None, None, None), "all"),
        ((D(2024, 1, 1), 1.0, None, None, None), "partial"),
        ((D(2024, 1, 1), 1.0, 1.0, 1.0, 1.0), "none"),
    ],
)
def test_pattern(spark, row, pattern):
    assert missing_verdict(_frame(spark, [row, (D(2024, 1, 1), 1.0, 1.0, 1.0, 1.0)])).first()["pattern"] == pattern


def test_mixed_pattern_needs_more_columns(spark):
    df = spark.range(1).selectExpr(*[f"CAST(NULL AS INT) AS n{i}" for i in range(4)], *[f"1 AS v{i}" for i in range(4)])
    assert missing_verdict(df).first()["pattern"] == "mixed"


def test_gaps_and_the_day_before(spark):
    rows = [(D(2024, 1, 5), 1.0, False), (D(2024, 1, 6), None, True), (D(2024, 1, 7), None, False), (D(2024, 1, 9), None, False)]
    df = spark.createDataFrame([(d, v, f) for d, v, f in rows for _ in range(2)], "date date, lag double, is_holiday boolean")
    gaps = gaps_by_previous_day(df, "lag")
    got = {r["day"].day: (r["weekday"], r["missing_count"], r["previous_day"]) for r in gaps.collect()}
    assert got == {6: (5, 2, "workday"), 7: (6, 2, "holiday"), 9: (1, 2, "unknown")}
    assert {r["previous_day"]: r["days"] for r in count_gaps_by_previous_day(gaps).collect()} == {"workday": 1, "holiday": 1, "unknown": 1}


def test_not_null(spark):
    df = _frame(spark, [(D(2024, 1, 1), None, 1.0, 1.0, 1.0)])
    assert {r["column"]: r["failures"] for r in null_counts(df, ["date", "a"]).collect()} == {"date": 0, "a": 1}
    assert assert_not_null(df, ["date"]).count() == 1
    with pytest.raises(Exception, match="column a must not be NULL"):
        assert_not_null(df, ["date", "a"]).collect()
