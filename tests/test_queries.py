"""Every query on the smallest data set, against its SQL in DuckDB."""

import os

import pytest

import __spark_entry__ as entry
import bench
from compare import connect, differences
from hourloom.workload import load

FOLDER = entry.SMOKE_FOLDER
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")
SQL = load().SQL


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, connection, name):
    assert differences(entry.queries()[name](spark, FOLDER), connection, SQL[name]) == []


def test_every_query_but_the_trees_has_sql():
    assert set(load().QUERIES) - set(SQL) == {"forecast_trees"}
    assert set(load().QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_every_benched_query_is_registered():
    assert set(bench.HEADLINE) <= set(entry.queries())


def test_known_numbers(spark):
    """Counts worked out beforehand in SQL over the same tables."""
    features = entry.entry(spark).toPandas()
    nulls = features[["lag_1_day", "lag_7_day", "lag_1_business_day", "temperature_2m", "precipitation"]].isna().sum()
    assert len(features) == 531 and list(nulls) == [156, 234, 274, 365, 510]
    board = entry.queries()["status_board"](spark, FOLDER).first()
    assert [board[f"{p}_status"] for p in ("click", "error", "purchase", "signup", "view", "unknown")] == [
        "OK", "ERROR", "OK", "ERROR", "OK", "WARNING",
    ]
    found = {(r["data_type"], r["check_type"], r["check_target"]): r["issue_count"]
             for r in entry.queries()["quality_findings"](spark, FOLDER).collect()}
    assert found["power", "missing", "全体"] == 44
    assert found["power", "outlier", "actual_power"] == 115 and found["power", "outlier", "supply_capacity"] == 123
    accuracy = entry.queries()["forecast_accuracy"](spark, FOLDER).toPandas()
    assert len(accuracy) == 542 and round(accuracy["error_percentage"].mean(), 4) == 3.0901
