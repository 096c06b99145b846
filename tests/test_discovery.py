import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from hourloom.sources.discovery import in_months, month_bounds, month_of, months_for_days, read_recent_files
from hourloom.sources.tables import backfill_predictions, export_csv, export_jsonl, scan_range

AS_OF = dt.date(2024, 3, 4)


@pytest.mark.parametrize(
    "days, months",
    [(1, ["202403"]), (2, ["202403"]), (3, ["202402", "202403"]), (10, ["202402", "202403"]), (35, ["202401", "202402", "202403"])],
)
def test_months_of_days(days, months):
    assert months_for_days(AS_OF, days) == months


def test_month_of_a_finished_day():
    assert month_of("20240303", AS_OF) == "202403"
    for bad in ("20240304", "20240230", "2024033", "x"):
        with pytest.raises(ValueError):
            month_of(bad, AS_OF)


def test_month_bounds():
    assert month_bounds("202402") == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert month_bounds("202312")[1] == dt.date(2023, 12, 31)
    for bad in ("202413", "20241", "2024xx"):
        with pytest.raises(ValueError):
            month_bounds(bad)


def test_months_reach_the_scan_as_ranges(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("d")).write.parquet(path)
    df = in_months(spark.read.parquet(path), "d", ["202402"])
    assert df.count() == 29
    assert "GreaterThanOrEqual(d,2024-02-01)" in df._jdf.queryExecution().executedPlan().toString()


def test_only_recent_months_are_read(spark, tmp_path):
    for month, name in (("202403", "a_power_usage.csv"), ("202402", "b_power_usage.csv"), ("202401", "c_power_usage.csv")):
        os.makedirs(tmp_path / month)
        (tmp_path / month / name).write_text("x")
        (tmp_path / month / "notes.csv").write_text("x")
    got = read_recent_files(spark, str(tmp_path), AS_OF, 10).select("path").collect()
    assert sorted(os.path.basename(r[0]) for r in got) == ["a_power_usage.csv", "b_power_usage.csv"]


def test_backfill_passes_over_missing_files(spark, tmp_path):
    rows = spark.sql(
        "SELECT 'e' AS execution_id, DATE '2024-01-02' AS prediction_date, 3 AS prediction_hour, "
        "1.25D AS predicted_power_kwh, TIMESTAMP_NTZ '2024-01-01 07:00:00' AS created_at"
    )
    export_csv(rows, str(tmp_path / "one"))
    table = str(tmp_path / "table")
    missing = backfill_predictions(
        spark, [(str(tmp_path / "one"), "2024-01-01"), (str(tmp_path / "two"), "2024-01-02")], table
    )
    assert missing == [str(tmp_path / "two")]
    got = spark.read.parquet(table).collect()
    assert len(got) == 1 and got[0]["prediction_run_date"] == dt.date(2024, 1, 1)
    assert got[0]["created_at"] == dt.datetime(2024, 1, 1, 7)


def test_json_lines_keep_null_fields(spark, tmp_path):
    export_jsonl(spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b"), str(tmp_path / "j"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "j")).collect()] == ['{"a":1,"b":null}']


def test_scan_range_ends_may_be_open(spark):
    df = spark.range(10).withColumnRenamed("id", "d")
    assert scan_range(df, ["d"], "d", 3, 5).count() == 3
    assert [r[0] for r in scan_range(df, ["d"], "d", last=1, order=["d"]).collect()] == [0, 1]
