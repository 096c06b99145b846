"""Table maintenance: a stored table before, a batch, and the table after."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.operators.refresh import DatedTable, replace_snapshot
from hourloom.plans.accuracy import prediction_accuracy
from hourloom.plans.dashboard import dashboard_history
from hourloom.shared import new_folder
from hourloom.workload import adapters
from hourloom.workload.adapters import AS_OF
from hourloom.workload.marts import _DASHBOARD
from hourloom.workload.registry import query
from hourloom.workload.sql import over


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("date"), "o_orderpriority", "o_totalprice"
    )


def _order_months(spark: SparkSession, folder: str) -> DatedTable:
    stored = DatedTable(spark, new_folder(spark, "orders"), grain="month", cluster_by=["date"])
    stored.create(_orders(spark, folder))
    return stored


def _batch(spark: SparkSession, folder: str) -> DataFrame:
    """Some weeks of orders with new totals; May is not in it."""
    return (
        _orders(spark, folder)
        .where(F.col("date").between(dt.date(1997, 3, 10), dt.date(1997, 6, 20)) & (F.month("date") != 5))
        .withColumn("o_totalprice", F.col("o_totalprice") * 2)
    )


_ORDERS = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_orderpriority, o_totalprice FROM orders"
_BATCH = """SELECT o_orderkey, date, o_orderpriority, o_totalprice * 2 AS o_totalprice FROM stored
  WHERE date BETWEEN DATE '1997-03-10' AND DATE '1997-06-20' AND month(date) <> 5"""
_SPAN = "date BETWEEN (SELECT MIN(date) FROM batch) AND (SELECT MAX(date) FROM batch)"


@query(
    over("", f"SELECT * FROM stored WHERE NOT ({_SPAN}) UNION ALL SELECT * FROM batch", stored=_ORDERS, batch=_BATCH)
)
def replace_loaded_range(spark, folder):
    stored = _order_months(spark, folder)
    stored.replace_loaded_range(_batch(spark, folder))
    return stored.read()


_URGENT = "o_orderpriority = '1-URGENT'"


@query(
    over(
        "",
        f"SELECT * FROM stored WHERE NOT ({_SPAN} AND {_URGENT}) UNION ALL SELECT * FROM batch",
        stored=_ORDERS,
        batch=f"{_BATCH} AND {_URGENT}",
    )
)
def replace_loaded_range_of_key(spark, folder):
    stored = _order_months(spark, folder)
    batch = _batch(spark, folder).where(F.col("o_orderpriority") == "1-URGENT")
    stored.replace_loaded_range(batch, key=("o_orderpriority", "1-URGENT"))
    return stored.read()


_ODD_DATE = "CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_orderdate AS DATE) END"
_SOME_UNDATED = f"SELECT o_orderkey, {_ODD_DATE} AS date, o_orderpriority, o_totalprice FROM orders"


@query(
    over(
        "",
        f"SELECT * FROM stored WHERE ({_SPAN}) IS NOT TRUE UNION ALL SELECT * FROM batch",
        stored=_SOME_UNDATED,
        batch="""SELECT o_orderkey, date, o_orderpriority, o_totalprice * 2 AS o_totalprice FROM stored
          WHERE date BETWEEN DATE '1997-03-10' AND DATE '1997-06-20' OR date IS NULL AND o_orderkey % 100 = 0""",
    )
)
def replace_range_beside_undated_rows(spark, folder):
    """Rows without a date, in the table and in the batch, outlive the replacement."""
    dated = F.when(F.col("o_orderkey") % 50 != 0, F.col("date")).alias("date")
    rows = _orders(spark, folder).select("o_orderkey", dated, "o_orderpriority", "o_totalprice")
    stored = DatedTable(spark, new_folder(spark, "orders"), grain="month", cluster_by=["o_orderkey"])
    stored.create(rows)
    fresh = F.col("date").between(dt.date(1997, 3, 10), dt.date(1997, 6, 20))
    undated = F.col("date").isNull() & (F.col("o_orderkey") % 100 == 0)
    batch = rows.where(fresh | undated).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    stored.replace_loaded_range(batch)
    return stored.read()


def _event_days(spark: SparkSession, folder: str) -> tuple[DatedTable, DataFrame]:
    stored = DatedTable(spark, new_folder(spark, "readings"), cluster_by=["event_id"])
    rows = adapters.readings(spark, folder).select("event_id", "date", "hour", "site", "actual_power")
    stored.create(rows)
    return stored, rows


def _recomputed(rows: DataFrame, first: dt.date) -> DataFrame:
    """New values from ``first`` on; one day of the window has no rows any more."""
    return rows.where((F.col("date") >= F.lit(first)) & (F.col("date") != F.lit(dt.date(2024, 1, 27)))).withColumn(
        "actual_power", F.col("actual_power") + 1
    )


_READINGS = "SELECT event_id, date, hour, site, actual_power FROM readings"


def _new(first: str, last: str = "2024-12-31") -> str:
    return f"""SELECT event_id, date, hour, site, actual_power + 1 AS actual_power FROM stored
      WHERE date BETWEEN DATE '{first}' AND DATE '{last}' AND date <> DATE '2024-01-27'"""


@query(
    over(
        "readings",
        "SELECT * FROM stored WHERE date < DATE '2024-01-24' UNION ALL SELECT * FROM fresh",
        stored=_READINGS,
        fresh=_new("2024-01-24"),
    )
)
def replace_rolling_window(spark, folder):
    stored, rows = _event_days(spark, folder)
    first = AS_OF - dt.timedelta(days=7)
    stored.replace_window(_recomputed(rows, first), first)
    return stored.read()


@query(
    over(
        "readings",
        """SELECT * FROM stored WHERE date NOT BETWEEN DATE '2024-01-06' AND DATE '2024-01-20'
        UNION ALL SELECT * FROM fresh""",
        stored=_READINGS,
        fresh=_new("2024-01-06", "2024-01-20"),
    )
)
def replace_two_sided_window(spark, folder):
    stored, rows = _event_days(spark, folder)
    last = dt.date(2024, 1, 20)
    first = last - dt.timedelta(days=14)
    stored.replace_window(_recomputed(rows, first).where(F.col("date") <= F.lit(last)), first, last)
    return stored.read()


@query(
    over(
        "predictions energy",
        """SELECT execution_id, CAST(p.created_at AS DATE) AS prediction_run_date,
          p.created_at AS prediction_run_datetime, prediction_date, prediction_hour,
          predicted_power_kwh AS predicted_power, actual_power,
          abs(predicted_power_kwh - actual_power) AS error_absolute,
          abs(predicted_power_kwh - actual_power) / nullif(actual_power, 0) * 100 AS error_percentage,
          date_diff('day', CAST(p.created_at AS DATE), prediction_date) AS days_ahead FROM predictions p
        JOIN energy e ON p.prediction_date = e.date AND p.prediction_hour = e.hour
        WHERE CAST(p.created_at AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-31' AND e.date < DATE '2024-01-31'
          AND (CAST(p.created_at AS DATE) >= DATE '2024-01-17' OR e.date < DATE '2024-01-17')
          AND (CAST(p.created_at AS DATE) >= DATE '2024-01-17' OR e.date >= DATE '2024-01-03')
          AND (CAST(p.created_at AS DATE) < DATE '2024-01-17' OR e.date >= DATE '2024-01-17')""",
    )
)
def refresh_accuracy_window(spark, folder):
    """Accuracy as of two weeks before, then refreshed by run date as of the last day."""
    stored = DatedTable(spark, new_folder(spark, "accuracy"), date="prediction_run_date")
    runs, energy = adapters.predictions(spark, folder), adapters.energy(spark, folder)
    earlier = AS_OF - dt.timedelta(days=14)
    stored.create(prediction_accuracy(runs, energy, earlier))
    stored.replace_window(prediction_accuracy(runs, energy, AS_OF), earlier, AS_OF)
    return stored.read()


@query(
    over(
        "readings",
        """SELECT * FROM stored WHERE date < DATE '2024-01-24' OR date = DATE '2024-01-27'
        UNION ALL SELECT * FROM fresh""",
        stored=_READINGS,
        fresh=_new("2024-01-24"),
    )
)
def overwrite_partitions(spark, folder):
    """Unlike a window replacement, the day without new rows keeps its old ones."""
    stored, rows = _event_days(spark, folder)
    stored.overwrite_partitions(_recomputed(rows, AS_OF - dt.timedelta(days=7)))
    return stored.read()


@query(over("", "SELECT * FROM stored WHERE date >= DATE '2001-06-15' - 1095", stored=_ORDERS))
def retention(spark, folder):
    stored = _order_months(spark, folder)
    stored.retain(dt.date(2001, 6, 15), 1095)
    return stored.read()


@query(
    """SELECT o_orderpriority, COUNT(*) AS orders, MAX(CAST(o_orderdate AS DATE)) AS last_date FROM orders GROUP BY 1"""
)
def snapshot_replace(spark, folder):
    path = new_folder(spark, "snapshot")
    orders = adapters.table(spark, folder, "orders")
    for statuses in (("O",), ("O", "F", "P")):
        board = orders.where(F.col("o_orderstatus").isin(*statuses)).groupBy("o_orderpriority")
        replace_snapshot(
            board.agg(F.count("*").alias("orders"), F.max(F.col("o_orderdate").cast("date")).alias("last_date")), path
        )
    return spark.read.parquet(path)


@query(
    over(
        "energy weather calendar predictions",
        _DASHBOARD.replace("GRAIN", "date, hour"),
        shown_reading="SELECT date, hour, actual_power, supply_capacity FROM energy WHERE date < DATE '2024-01-21'",
        shown_weather="""SELECT date, CAST(hour AS INT) AS hour, temperature_2m, relative_humidity_2m, precipitation,
          weather_code FROM weather WHERE prefecture = 'view'""",
        shown_forecast="""SELECT prediction_date AS date, prediction_hour AS hour,
          arg_max(predicted_power_kwh, created_at) AS predicted_power_kwh FROM predictions GROUP BY ALL""",
    )
)
def historical_load(spark, folder):
    """The first load of the dashboard table: all days before today."""
    stored = DatedTable(spark, new_folder(spark, "dashboard"), cluster_by=["hour"])
    stored.create(
        dashboard_history(
            adapters.energy(spark, folder),
            adapters.weather(spark, folder),
            adapters.calendar(spark, folder),
            adapters.predictions(spark, folder),
            dt.date(2024, 1, 21),
            ("prefecture", adapters.SITE),
        )
    )
    return stored.read()


@query(
    over(
        "",
        f"""SELECT (SELECT COUNT(*) FROM stored WHERE {_SPAN}) AS deleted, (SELECT COUNT(*) FROM batch) AS inserted,
        (SELECT COUNT(*) FROM stored WHERE NOT ({_SPAN})) + (SELECT COUNT(*) FROM batch) AS rows_after""",
        stored=_ORDERS,
        batch=_BATCH,
    )
)
def refresh_counts(spark, folder):
    stored = _order_months(spark, folder)
    counts = stored.replace_loaded_range(_batch(spark, folder))
    return stored.read().agg(
        F.lit(counts.deleted).cast("long").alias("deleted"),
        F.lit(counts.inserted).cast("long").alias("inserted"),
        F.count("*").alias("rows_after"),
    )
