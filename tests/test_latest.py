import datetime as dt

from pyspark.sql import functions as F

from hourloom.operators.latest import latest_per_key, latest_row

T = dt.datetime


def _frame(spark):
    rows = [
        ("a", T(2024, 1, 1), 1.0),
        ("a", T(2024, 1, 2), 2.0),
        ("b", None, 9.0),
        ("b", T(2024, 1, 1), 3.0),
        ("c", None, 4.0),
        ("d", T(2024, 1, 1), 5.0),
        ("d", T(2024, 1, 1), 6.0),
    ]
    return spark.createDataFrame(rows, "k string, created_at timestamp_ntz, v double")


def test_latest_with_nulls_singles_and_ties(spark):
    for parts in (1, 5):
        got = {r["k"]: r["v"] for r in latest_per_key(_frame(spark).repartition(parts), ["k"]).collect()}
        assert got == {"a": 2.0, "b": 3.0, "c": 4.0, "d": 6.0}


def test_rows_are_cut_before_the_shuffle(spark):
    plan = latest_per_key(_frame(spark), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_latest_row_of_all(spark):
    assert latest_row(_frame(spark), F.desc("created_at"), F.desc("v")).first()["k"] == "a"
