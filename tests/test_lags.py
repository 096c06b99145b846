import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourloom.operators.calendar import calendar_frame, date_lag_mapping
from hourloom.operators.lags import lag_by_date
from hourloom.plans.features import LAGS, ml_features

D = dt.date


@pytest.fixture(scope="module")
def mapping(spark):
    cal = calendar_frame(spark, D(2024, 1, 1), D(2024, 1, 31), [D(2024, 1, 8)])
    return date_lag_mapping(cal, [1, 7], [1]).cache()


def _frame(spark, rows):
    return spark.createDataFrame(rows, "date date, hour int, actual_power double, supply_capacity double")


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("unique", [False, True])
def test_a_gap_gives_null_not_the_row_before(spark, mapping, unique):
    rows = [(D(2024, 1, d), h, float(d * 100 + h), 1.0) for d in (9, 10, 12, 15, 17) for h in (0, 1)]
    out = lag_by_date(_frame(spark, rows), mapping, "actual_power", LAGS, unique=unique)
    got = {(r["date"].day, r["hour"]): (r["lag_1_day"], r["lag_7_day"], r["lag_1_business_day"]) for r in out.collect()}
    assert got[10, 0] == (900.0, None, 900.0)
    assert got[12, 1] == (None, None, None)
    assert got[15, 0] == (None, None, 1200.0)
    assert got[17, 1] == (None, 1001.0, None)
    assert len(got) == len(rows)


def test_both_ways_agree_with_null_values_and_dates_off_the_calendar(spark, mapping):
    rows = [
        (D(2024, 1, 1) + dt.timedelta(days=i), h, None if (i + h) % 5 == 0 else float(i * 10 + h), None)
        for i in range(45)
        for h in range(3)
        if (i * h) % 7 != 3
    ]
    df = _frame(spark, rows)
    joined = lag_by_date(df, mapping, "actual_power", LAGS)
    sent = lag_by_date(df, mapping, "actual_power", LAGS, unique=True)
    assert _sorted(joined) == _sorted(sent)
    assert joined.columns == sent.columns


def test_repeated_rows_multiply(spark, mapping):
    rows = [(D(2024, 1, 9), 0, 1.0, 1.0), (D(2024, 1, 9), 0, 2.0, 1.0), (D(2024, 1, 10), 0, 3.0, 1.0)]
    out = lag_by_date(_frame(spark, rows), mapping, "actual_power", {"lag_1_day": "lag_1_day_date"})
    assert sorted(r["lag_1_day"] for r in out.where(F.col("date") == D(2024, 1, 10)).collect()) == [1.0, 2.0]


@pytest.mark.parametrize("extra", [(D(2024, 1, 9), 0, 2.0, 1.0), (D(2024, 1, 9), None, 2.0, 1.0)])
def test_a_broken_promise_of_uniqueness_fails(spark, mapping, extra):
    rows = [(D(2024, 1, 9), 0, 1.0, 1.0), extra]
    out = lag_by_date(_frame(spark, rows), mapping, "actual_power", LAGS, unique=True)
    with pytest.raises(Exception, match="not unique"):
        out.collect()


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_unique_rows_with_lags_take_one_shuffle(spark, mapping, tmp_path):
    mapping.write.parquet(str(tmp_path / "mapping"))
    mapping = spark.read.parquet(str(tmp_path / "mapping"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(1000).select(
            F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") / 24).cast("int")).alias("date"),
            (F.col("id") % 24).cast("int").alias("hour"),
            F.col("id").cast("double").alias("actual_power"),
        )
        sent = lag_by_date(rows, mapping, "actual_power", LAGS, unique=True)
        joined = lag_by_date(rows, mapping, "actual_power", LAGS)
        # One for the rows and one for the date mapping; the join way adds one of narrow rows per lag.
        assert _exchanges(sent) <= 2
        assert _exchanges(joined) == 1 + len(LAGS)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("n", [63, 64, 130])
def test_many_lags(spark, n):
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(140)]
    back = [(d, *[d - dt.timedelta(days=k) for k in range(1, n + 1)]) for d in days]
    columns = [f"lag_{k}_day" for k in range(1, n + 1)]
    mapping = spark.createDataFrame(back, "base_date date, " + ", ".join(f"{c}_date date" for c in columns))
    lags = {c: f"{c}_date" for c in columns}
    df = _frame(spark, [(d, 0, float(i), 1.0) for i, d in enumerate(days) if i % 9 != 3])
    sent = lag_by_date(df, mapping, "actual_power", lags, unique=True)
    got = {r["date"]: r for r in sent.collect()}
    assert len(got) == df.count()
    last = got[days[139]]
    assert [last[c] for c in columns] == [None if (139 - k) % 9 == 3 else 139.0 - k for k in range(1, n + 1)]
    one = lag_by_date(df.limit(1), mapping, "actual_power", lags, unique=True)
    assert one.count() == 1
    with pytest.raises(Exception, match="not unique"):
        lag_by_date(df.unionByName(df.limit(1)), mapping, "actual_power", lags, unique=True).collect()


def test_only_the_value_is_sent_to_other_dates(spark, mapping):
    rows = [(D(2024, 1, d), 0, float(d), 7.0) for d in (9, 10)]
    out = lag_by_date(_frame(spark, rows), mapping, "actual_power", LAGS, unique=True)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN (slot" in plan and "supply_capacity" in plan
    assert {r["supply_capacity"] for r in out.collect()} == {7.0}


def test_features_of_a_refresh_keep_the_last_week_and_the_future(spark, mapping):
    cal = calendar_frame(spark, D(2024, 1, 1), D(2024, 1, 31))
    rows = [(D(2024, 1, 1) + dt.timedelta(days=i), 5, float(i), 1.0) for i in range(31)]
    weather = spark.createDataFrame(
        [("chiba", D(2024, 1, 20), "05", 1.0, 2.0, None, 3), ("tokyo", D(2024, 1, 20), "05", 9.0, 9.0, 9.0, 9)],
        "prefecture string, date date, hour string, temperature_2m double, relative_humidity_2m double, "
        "precipitation double, weather_code bigint",
    )
    out = ml_features(
        _frame(spark, rows), weather, cal, mapping, ("prefecture", "chiba"), as_of=D(2024, 1, 25)
    ).collect()
    assert sorted(r["date"].day for r in out) == list(range(18, 32))
    day = {r["date"].day: r for r in out}
    assert day[20]["temperature_2m"] == 1.0 and day[21]["temperature_2m"] is None
    # 20 days of readings reach back far enough for all lags of the window.
    assert day[18]["lag_7_day"] == 10.0 and day[18]["lag_1_business_day"] == 16.0
    assert day[20]["lag_1_business_day"] is None
    assert abs(day[18]["hour_sin"] - 0.9659258262890683) < 1e-12


def _records_shuffled(plan):
    """Rows written by all shuffles of a plan that has run."""
    name, own = plan.getClass().getSimpleName(), 0
    if name == "AdaptiveSparkPlanExec":
        return _records_shuffled(plan.executedPlan())
    if name == "ShuffleQueryStageExec":
        return _records_shuffled(plan.plan())
    if name == "ShuffleExchangeExec":
        own = plan.metrics().get("shuffleRecordsWritten").get().value()
    children = plan.children()
    return own + sum(_records_shuffled(children.apply(i)) for i in range(children.size()))


def test_shuffled_rows_do_not_grow_with_the_lags(spark):
    n = 60
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(200)]
    back = [(d, *[d - dt.timedelta(days=k) for k in range(1, n + 1)]) for d in days]
    mapping = spark.createDataFrame(back, "base_date date, " + ", ".join(f"lag_{k} date" for k in range(1, n + 1))).cache()
    df = _frame(spark, [(d, h, float(i), 1.0) for i, d in enumerate(days) for h in range(5)])
    sent = lag_by_date(df, mapping, "actual_power", {f"l{k}": f"lag_{k}" for k in range(1, n + 1)}, unique=True)
    rows = {(r["date"], r["hour"]): r for r in sent.collect()}
    assert len(rows) == 1000 and rows[days[150], 3]["l60"] == 90.0 and rows[days[30], 0]["l31"] is None
    # Each row in its chunk and at most one more, and the rows of the mapping.
    assert _records_shuffled(sent._jdf.queryExecution().executedPlan()) <= 2 * 1000 + len(days)
