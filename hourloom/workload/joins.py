"""Joins, lags by date, business days and latest versions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hourloom.operators.calendar import date_lag_mapping
from hourloom.operators.joins import small_side
from hourloom.operators.lags import lag_by_date
from hourloom.operators.latest import latest_per_key, latest_row
from hourloom.plans.features import CALENDAR_VALUES, power_and_weather, weather_at
from hourloom.plans.status import latest_runs
from hourloom.workload import adapters
from hourloom.workload.adapters import AS_OF
from hourloom.workload.registry import query
from hourloom.workload.sql import over


@query(
    over(
        "energy weather",
        """SELECT e.date, e.hour, actual_power, temperature_2m, precipitation FROM energy e LEFT JOIN weather w
        ON e.date = w.date AND e.hour = CAST(w.hour AS INT) AND w.prefecture = 'view'""",
    )
)
def left_join_cast_key(spark, folder):
    weather = weather_at(adapters.weather(spark, folder), ("prefecture", adapters.SITE))
    return (
        adapters.energy(spark, folder)
        .join(weather.select("date", "hour", "temperature_2m", "precipitation"), ["date", "hour"], "left")
        .select("date", "hour", "actual_power", "temperature_2m", "precipitation")
    )


@query(
    over(
        "calendar",
        """SELECT o_orderkey, CAST(o_orderdate AS DATE) + 8200 AS date, day_of_week, is_weekend, is_holiday
        FROM orders LEFT JOIN calendar ON CAST(o_orderdate AS DATE) + 8200 = date""",
    )
)
def left_join_calendar(spark, folder):
    """Order dates moved so that some fall on the calendar and most outside."""
    date = F.date_add(F.col("o_orderdate").cast("date"), 8200).alias("date")
    cal = adapters.calendar(spark, folder).select("date", *CALENDAR_VALUES)
    return (
        adapters.table(spark, folder, "orders")
        .select("o_orderkey", date)
        .join(small_side(cal), "date", "left")
        .select("o_orderkey", "date", *CALENDAR_VALUES)
    )


_SHIP_MAPPING = """SELECT c.date AS base_date, c.date - 1 AS lag_1_day_date, c.date - 7 AS lag_7_day_date,
  p.date AS lag_1_business_date FROM ship_calendar c
  LEFT JOIN ship_business b ON c.date = b.date LEFT JOIN ship_business p ON p.n = b.n - 1"""
_LAGS = {
    "lag_1_day": "lag_1_day_date",
    "lag_7_day": "lag_7_day_date",
    "lag_1_business_day": "lag_1_business_date",
}
_LAG_JOIN = """SELECT r.l_suppkey, r.date, r.revenue, {extra} a.revenue AS lag_1_day, b.revenue AS lag_7_day,
    c.revenue AS lag_1_business_day FROM {source} r LEFT JOIN mapping m ON r.date = m.base_date
  LEFT JOIN {source} a ON a.l_suppkey = r.l_suppkey AND a.date = m.lag_1_day_date
  LEFT JOIN {source} b ON b.l_suppkey = r.l_suppkey AND b.date = m.lag_7_day_date
  LEFT JOIN {source} c ON c.l_suppkey = r.l_suppkey AND c.date = m.lag_1_business_date"""


@query(over("ship_calendar ship_business revenue", _LAG_JOIN.format(extra="", source="revenue"), mapping=_SHIP_MAPPING))
def lag_join_by_date(spark, folder):
    """Revenue per supplier and day with earlier days' revenue; days have gaps."""
    return lag_by_date(
        adapters.revenue(spark, folder), adapters.ship_lag_mapping(spark, folder), "revenue", _LAGS, ["l_suppkey"], unique=True
    )


_DAYS = range(1, 61)


@query(
    over(
        "revenue",
        f"""SELECT l_suppkey, date, revenue, {', '.join(f'm[date - {k}] AS lag_{k}_day' for k in _DAYS)}
        FROM revenue JOIN maps USING (l_suppkey)""",
        maps="SELECT l_suppkey, map(list(date), list(revenue)) AS m FROM revenue GROUP BY 1",
    )
)
def lag_join_60_days(spark, folder):
    """Revenue per supplier and day with that of each of the 60 days before."""
    lags = {f"lag_{k}_day": f"lag_{k}_day_date" for k in _DAYS}
    mapping = adapters.ship_lag_mapping_60(spark, folder)
    return lag_by_date(adapters.revenue(spark, folder), mapping, "revenue", lags, ["l_suppkey"], unique=True)


@query(
    over(
        "ship_calendar ship_business",
        _LAG_JOIN.format(extra="r.l_returnflag, r.l_linestatus,", source="split"),
        mapping=_SHIP_MAPPING,
        split="""SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, l_returnflag, l_linestatus,
          SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue FROM lineitem GROUP BY ALL""",
    )
)
def lag_join_repeated_rows(spark, folder):
    """Several rows per supplier and day: every row meets every earlier one, as joins do."""
    rows = (
        adapters.table(spark, folder, "lineitem")
        .groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("date"), "l_returnflag", "l_linestatus")
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("revenue"))
    )
    return lag_by_date(rows, adapters.ship_lag_mapping(spark, folder), "revenue", _LAGS, ["l_suppkey"])


@query(
    over(
        "mapping",
        """SELECT r.user_id, r.date, r.event_id, r.value, a.value AS lag_1_day, b.value AS lag_7_day,
          c.value AS lag_1_business_day FROM crowded r LEFT JOIN mapping m ON r.date = m.base_date
        LEFT JOIN crowded a ON a.user_id = r.user_id AND a.date = m.lag_1_day_date
        LEFT JOIN crowded b ON b.user_id = r.user_id AND b.date = m.lag_7_day_date
        LEFT JOIN crowded c ON c.user_id = r.user_id AND c.date = m.lag_1_business_date""",
        crowded="""SELECT user_id, CASE WHEN event_id % 3 = 0 THEN DATE '2024-01-10' ELSE CAST(ts AS DATE) END AS date,
          event_id, value FROM events""",
    )
)
def lag_join_crowded_day(spark, folder):
    """A third of all rows came in on one day: those days of a user are joined with salts."""
    day = F.when(F.col("event_id") % 3 == 0, F.lit(dt.date(2024, 1, 10))).otherwise(F.col("ts").cast("date"))
    rows = adapters.events(spark, folder).select("user_id", day.alias("date"), "event_id", "value")
    return lag_by_date(rows, adapters.lag_mapping(spark, folder), "value", _LAGS, ["user_id"], crowded=10)


@query(
    over(
        "site_energy site_predictions",
        """SELECT e.user_id, e.date, e.hour, actual_power, execution_id, predicted_power_kwh
        FROM site_energy e LEFT JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, prediction_date,
          prediction_hour ORDER BY created_at DESC) AS rn FROM site_predictions) p
        ON e.user_id = p.user_id AND e.date = p.prediction_date AND e.hour = p.prediction_hour AND p.rn = 1""",
    )
)
def left_join_latest(spark, folder):
    runs = adapters.predictions(spark, folder, ["user_id"])
    newest = latest_per_key(runs, ["user_id", "prediction_date", "prediction_hour"]).select(
        "user_id",
        F.col("prediction_date").alias("date"),
        F.col("prediction_hour").alias("hour"),
        "execution_id",
        "predicted_power_kwh",
    )
    return (
        adapters.energy(spark, folder, ["user_id"])
        .join(newest, ["user_id", "date", "hour"], "left")
        .select("user_id", "date", "hour", "actual_power", "execution_id", "predicted_power_kwh")
    )


@query(
    over(
        "site_energy site_predictions",
        """SELECT e.user_id, e.date, e.hour, execution_id, predicted_power_kwh, actual_power
        FROM site_predictions p JOIN site_energy e
        ON e.user_id = p.user_id AND e.date = p.prediction_date AND e.hour = p.prediction_hour""",
    )
)
def inner_join_forecasts(spark, folder):
    energy = adapters.energy(spark, folder, ["user_id"])
    runs = adapters.predictions(spark, folder, ["user_id"]).withColumnsRenamed(
        {"prediction_date": "date", "prediction_hour": "hour"}
    )
    return runs.drop("created_at").join(energy, ["user_id", "date", "hour"]).select(
        "user_id", "date", "hour", "execution_id", "predicted_power_kwh", "actual_power"
    )


@query(
    over(
        "energy weather",
        """SELECT e.date, e.hour, prefecture, actual_power, temperature_2m FROM energy e LEFT JOIN weather w
        ON e.date = w.date AND e.hour = CAST(w.hour AS INT) WHERE w.prefecture IS NOT NULL""",
    )
)
def right_key_present(spark, folder):
    joined = power_and_weather(
        adapters.energy(spark, folder), adapters.weather(spark, folder), adapters.calendar(spark, folder)
    )
    return joined.select("date", "hour", "prefecture", "actual_power", "temperature_2m")


_K = range(1, 31)


@query(
    over(
        "ship_calendar ship_business",
        f"""SELECT c.date AS base_date, {', '.join(f'c.date - {k} AS lag_{k}_day_date' for k in _K)},
        {', '.join(f'lag_{k}_business_date' for k in _K)} FROM ship_calendar c LEFT JOIN lagged b ON c.date = b.date""",
        lagged=f"""SELECT date, {', '.join(f'LAG(date, {k}) OVER (ORDER BY n) AS lag_{k}_business_date' for k in _K)}
        FROM ship_business""",
    )
)
def date_lag_mapping_30(spark, folder):
    """Per date, 1 to 30 days and 1 to 30 business days back."""
    return date_lag_mapping(adapters.ship_calendar(spark, folder))


@query(
    over(
        "ship_calendar ship_business",
        """SELECT p.base_date, a.date AS lag_1_business_date, b.date AS lag_5_business_date FROM previous p
        LEFT JOIN ship_business a ON a.n = p.n LEFT JOIN ship_business b ON b.n = p.n - 4""",
        previous="""SELECT c.date AS base_date, MAX(b.n) AS n FROM ship_calendar c
        LEFT JOIN ship_business b ON b.date < c.date GROUP BY 1""",
    )
)
def business_lag_carried_back(spark, folder):
    """Weekends and holidays look back to the business days before them."""
    return date_lag_mapping(adapters.ship_calendar(spark, folder), [], [1, 5], carry_back=True)


@query(
    over(
        "",
        """SELECT o_orderpriority, COUNT(*) AS orders,
        coalesce((SELECT o_orderstatus FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1), 'WARNING')
          AS latest_status,
        coalesce((SELECT o_orderstatus FROM orders WHERE o_totalprice < 0 LIMIT 1), 'WARNING') AS absent_status
        FROM orders GROUP BY 1""",
    )
)
def scalar_subquery_default(spark, folder):
    orders = adapters.table(spark, folder, "orders")
    latest = latest_row(orders, F.desc("o_orderdate"), F.desc("o_orderkey")).select("o_orderstatus")
    absent = orders.where("o_totalprice < 0").select("o_orderstatus").limit(1)
    counted = orders.groupBy("o_orderpriority").agg(F.count("*").alias("orders"))
    return counted.select(
        "o_orderpriority",
        "orders",
        F.coalesce(latest.scalar(), F.lit("WARNING")).alias("latest_status"),
        F.coalesce(absent.scalar(), F.lit("WARNING")).alias("absent_status"),
    )


_LINE_TIES = [
    "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


@query(
    f"""SELECT l_partkey, l_suppkey, l_shipdate, {', '.join(_LINE_TIES)} FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY l_partkey, l_suppkey
        ORDER BY l_shipdate DESC, {', '.join(c + ' DESC' for c in _LINE_TIES)}) AS rn FROM lineitem) WHERE rn = 1"""
)
def latest_per_part_and_supplier(spark, folder):
    rows = adapters.table(spark, folder, "lineitem")
    return latest_per_key(rows, ["l_partkey", "l_suppkey"], "l_shipdate", _LINE_TIES).select(
        "l_partkey", "l_suppkey", "l_shipdate", *_LINE_TIES
    )


@query(
    over(
        "readings",
        """SELECT date, hour, site, actual_power, supply_capacity, created_at, event_id FROM (SELECT *, ROW_NUMBER() OVER
        (PARTITION BY date, hour, site ORDER BY created_at DESC) AS rn FROM readings) WHERE rn = 1""",
    )
)
def latest_reading_per_hour(spark, folder):
    return latest_per_key(adapters.readings(spark, folder), ["date", "hour", "site"]).select(
        "date", "hour", "site", "actual_power", "supply_capacity", "created_at", "event_id"
    )


@query(
    over(
        "run_log",
        """SELECT process_type, execution_id, status, error_message, started_at, completed_at FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY process_type ORDER BY started_at DESC) AS rn FROM run_log
        WHERE date >= DATE '2024-01-29') WHERE rn = 1""",
    )
)
def latest_run_per_process(spark, folder):
    return latest_runs(adapters.run_log(spark, folder), AS_OF).select(
        "process_type", "execution_id", "status", "error_message", "started_at", "completed_at"
    )


@query("SELECT event_id, ts, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def latest_event(spark, folder):
    rows = adapters.events(spark, folder).select("event_id", "ts", "event_type", "value")
    return latest_row(rows, F.desc("ts"), F.desc("event_id"))
