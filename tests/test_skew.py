"""A third of all rows belongs to one key; results stay whole."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourloom.operators.calendar import calendar_frame, date_lag_mapping
from hourloom.operators.lags import lag_by_date
from hourloom.operators.latest import latest_per_key
from hourloom.operators.refresh import DatedTable
from hourloom.plans.features import LAGS
from hourloom.plans.quality import power_rules, quality_checks
from hourloom.shared import new_folder

N = 30_000
FIRST = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    site = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500 + 1)
    return spark.range(N).select(
        site.cast("int").alias("site"),
        F.date_add(F.lit(FIRST), (F.col("id") % 28).cast("int")).alias("date"),
        (F.col("id") % 24).cast("int").alias("hour"),
        F.col("id").cast("double").alias("actual_power"),
        F.lit(1.0).alias("supply_capacity"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("created_at"),
    )


def test_latest_version_of_a_hot_key(rows):
    got = {r["site"]: r["actual_power"] for r in latest_per_key(rows, ["site"]).collect()}
    want = {}
    for i in range(N):
        want[0 if i % 3 == 0 else i % 500 + 1] = float(i)
    assert got == want


def test_rows_without_a_business_lag_do_not_share_a_key(spark, rows):
    mapping = date_lag_mapping(calendar_frame(spark, FIRST, dt.date(2024, 1, 31)), [1, 7], [1])
    once = latest_per_key(rows, ["site", "date", "hour"]).drop("created_at")
    joined = lag_by_date(once, mapping, "actual_power", LAGS, ["site", "hour"])
    sent = lag_by_date(once, mapping, "actual_power", LAGS, ["site", "hour"], unique=True)
    total = [F.count("*"), *[F.sum(c) for c in LAGS], *[F.count(c) for c in LAGS]]
    assert joined.agg(*total).first() == sent.agg(*total).first()
    assert joined.count() == once.count()
    # Rows are joined by their own date; what is looked up travels to it, NULL dates not at all.
    looked_up = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "(date#" in looked_up and "coalesce(lag_1_business_date" not in looked_up


def test_a_crowded_hour_multiplies_whole_and_salted(spark):
    """One hour of one site is repeated: equal rows, other rows, and NULL values among them."""
    mapping = date_lag_mapping(calendar_frame(spark, FIRST, dt.date(2024, 1, 31)), [1, 7], [1]).cache()
    hot = dt.date(2024, 1, 10)
    normal = spark.range(28 * 3).select(
        (F.col("id") % 3).cast("int").alias("site"), F.date_add(F.lit(FIRST), (F.col("id") / 3).cast("int")).alias("date"),
        F.col("id").cast("double").alias("actual_power"), F.lit("x").alias("note"),
    )
    many = spark.range(2000).select(
        F.lit(1).alias("site"), F.lit(hot).alias("date"),
        F.when(F.col("id") < 1500, 5.0).when(F.col("id") % 50 != 0, F.col("id") % 120).cast("double").alias("actual_power"),
        F.when(F.col("id") % 2 == 0, "y").otherwise("z").alias("note"),
    )
    odd = spark.createDataFrame([(None, hot, 1.0, "n"), (1, None, 2.0, "n"), (1, dt.date(2030, 1, 1), 3.0, "n")], normal.schema)
    df = normal.unionByName(many).unionByName(odd)
    got = lag_by_date(df, mapping, "actual_power", LAGS, ["site"], crowded=100)
    df.createOrReplaceTempView("crowded_rows")
    mapping.createOrReplaceTempView("crowded_mapping")
    joins = " ".join(
        f"LEFT JOIN crowded_rows {t} ON {t}.site = r.site AND {t}.date = m.{column}" for t, column in zip("abc", LAGS.values())
    )
    shown = ", ".join(f"{t}.actual_power AS {name}" for t, name in zip("abc", LAGS))
    want = spark.sql(f"SELECT r.*, {shown} FROM crowded_rows r LEFT JOIN crowded_mapping m ON r.date = m.base_date {joins}")
    columns = want.columns
    counted = [{tuple(r[:-1]): r[-1] for r in x.groupBy(*columns).count().collect()} for x in (got, want)]
    assert counted[0] == counted[1] and sum(counted[0].values()) > 8000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan and "__of" in plan


def test_quality_of_a_hot_group(rows):
    period = (FIRST, FIRST + dt.timedelta(days=27))
    checks = quality_checks(rows, "power", power_rules(), period, dt.date(2024, 1, 31), by=["site"])
    hot = {(r["check_type"], r["check_target"]): r["issue_count"] for r in checks.where("site = 0").collect()}
    assert hot["missing", "全体"] == 24 * 28 - N // 3
    assert hot["outlier", "supply_capacity"] == N // 3


def test_a_hot_day_is_written_by_several_tasks(spark, rows):
    table = DatedTable(spark, new_folder(spark, "hot"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32KB")
    try:
        table.create(rows.withColumn("date", F.when(F.col("site") == 0, F.lit(FIRST)).otherwise(F.col("date"))))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert table.read().count() == N
    files = table.read().where(F.col("date") == F.lit(FIRST)).select(F.input_file_name()).distinct().count()
    assert files > 1
