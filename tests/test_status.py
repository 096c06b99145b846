import datetime as dt

from pyspark.sql import functions as F

from hourloom.plans.status import PROCESSES, latest_runs, system_status

AS_OF = dt.date(2024, 1, 31)
T = dt.datetime
LOG = "execution_id string, date date, process_type string, status string, error_message string, started_at timestamp_ntz, completed_at timestamp_ntz"
CHECKS = "check_date date, check_timestamp timestamp_ntz, check_type string, check_target string, status string, issue_detail string"


def _run(name, status, at, seconds=1.5, id="x", message=None):
    return (id, at.date(), name, status, message, at, at + dt.timedelta(seconds=seconds))


def _board(spark, runs, checks=()):
    return system_status(
        spark.createDataFrame(list(runs), LOG), spark.createDataFrame(list(checks), CHECKS), AS_OF
    ).collect()


def test_an_empty_log_gives_one_row_of_warnings(spark):
    (row,) = _board(spark, [])
    assert len(row) == 21
    assert {row[f"{p}_status"] for p in [*PROCESSES, "data_quality"]} == {"WARNING"}
    assert row["tepco_api_message"] is None and row["data_quality_duration_seconds"] is None


def test_latest_run_decides(spark):
    (row,) = _board(
        spark,
        [
            _run("TEPCO_API", "SUCCESS", T(2024, 1, 30, 1)),
            _run("TEPCO_API", "FAILED", T(2024, 1, 30, 2), 0.25, message="404"),
            _run("WEATHER_API", "SUCCESS", T(2024, 1, 31, 2)),
            _run("ML_PREDICTION", "RUNNING", T(2024, 1, 31, 2)),
            _run("DASHBOARD_UPDATE", "SUCCESS", T(2024, 1, 28, 23)),
            _run("SOMETHING_ELSE", "SUCCESS", T(2024, 1, 31, 2)),
        ],
    )
    assert (row["tepco_api_status"], row["tepco_api_message"], row["tepco_api_duration_seconds"]) == ("ERROR", "404", 0.25)
    assert row["weather_api_status"] == "OK" and row["weather_api_duration_seconds"] == 1.5
    assert row["ml_prediction_status"] == "WARNING"
    # Three days ago is out of the window.
    assert row["dashboard_update_status"] == "WARNING" and row["dashboard_update_duration_seconds"] is None


def test_findings_of_one_moment_show_the_worst(spark):
    at = T(2024, 1, 30, 9)
    checks = [
        (AS_OF, at, "null", "a", "WARNING", "w"),
        (AS_OF, at, "missing", "b", "ERROR", "first"),
        (AS_OF, at, "outlier", "b", "ERROR", "second"),
        (AS_OF, at, "outlier", "z", "OK", "fine"),
        (AS_OF, T(2024, 1, 29, 9), "null", "z", "ERROR", "older"),
    ]
    (row,) = _board(spark, [], checks)
    assert (row["data_quality_status"], row["data_quality_message"]) == ("ERROR", "second")
    (row,) = _board(spark, [], [(AS_OF, at, "null", "a", "OK", "fine")])
    assert row["data_quality_status"] == "OK"


def test_updated_at_comes_first_when_given(spark):
    empty = spark.createDataFrame([], LOG), spark.createDataFrame([], CHECKS)
    board = system_status(*empty, AS_OF, updated_at=F.lit(T(2024, 1, 31, 7)).cast("timestamp_ntz"))
    assert len(board.columns) == 22 and board.columns[0] == "updated_at"


def test_runs_started_together(spark):
    log = spark.createDataFrame(
        [_run("A", "FAILED", T(2024, 1, 30), id="1"), _run("A", "SUCCESS", T(2024, 1, 30), id="2")], LOG
    )
    assert [r["execution_id"] for r in latest_runs(log, AS_OF).collect()] == ["2"]


def test_a_task_passes_on_one_row(spark):
    log, checks = spark.createDataFrame([], LOG), spark.createDataFrame([], CHECKS)
    plan = system_status(log, checks, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan and "Join" not in plan
