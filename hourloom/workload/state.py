"""Reports from stored daily state, after some of the table's dates were replaced."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.operators.daily_state import (
    DailyState,
    gaps_by_previous_day_of,
    missing_by_day_of,
    missing_summary_of,
    missing_verdict_of,
    null_profile_of,
    range_profile_of,
)
from hourloom.operators.refresh import DatedTable
from hourloom.shared import new_folder
from hourloom.workload import adapters
from hourloom.workload.registry import query
from hourloom.workload.sql import over

FIRST, LAST = dt.date(2024, 1, 8), dt.date(2024, 1, 22)
REPLACED = (dt.date(2024, 1, 15), dt.date(2024, 1, 16))
_TYPES = {"site": "string", "actual_power": "double", "supply": "bigint"}

_DONE: dict[tuple[str, str], tuple[DailyState, list[dt.date]]] = {}


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events with NULLs by rule, and whether their day is a holiday."""
    key, kind = F.col("event_id"), F.col("event_type")
    day = F.col("ts").cast("date")
    return adapters.events(spark, folder).select(
        day.alias("date"),
        F.nullif(kind, F.lit("error")).alias("site"),
        F.when(key % 7 != 0, F.col("value")).alias("actual_power"),
        F.when((key % 5 != 0) & (kind != "error"), F.col("user_id")).alias("supply"),
        day.isin(*adapters.HOLIDAYS).alias("is_holiday"),
        "event_id",
    )


_EVENTS = """SELECT CAST(ts AS DATE) AS date, nullif(event_type, 'error') AS site,
    CASE WHEN event_id % 7 <> 0 THEN value END AS actual_power,
    CASE WHEN event_id % 5 <> 0 AND event_type <> 'error' THEN user_id END AS supply, event_id,
    CAST(ts AS DATE) IN (DATE '2024-01-01', DATE '2024-01-08', DATE '2024-02-12') AS is_holiday FROM events"""
_VIEWS = {
    "given": _EVENTS,
    "loaded": """SELECT * FROM given WHERE date NOT BETWEEN DATE '2024-01-15' AND DATE '2024-01-16'
      UNION ALL SELECT * REPLACE (CASE WHEN event_id % 3 <> 0 THEN actual_power * 2 END AS actual_power) FROM given
      WHERE date = DATE '2024-01-15'""",
    "part": f"SELECT * FROM loaded WHERE date BETWEEN DATE '{FIRST}' AND DATE '{LAST}'",
    "flagged": "SELECT *, (site IS NULL)::INT + (actual_power IS NULL)::INT + (supply IS NULL)::INT AS n FROM part",
}


def _state(spark: SparkSession, folder: str) -> tuple[DailyState, list[dt.date]]:
    """State of all days, then of two replaced ones, the second left without rows; made once."""
    place = (spark.sparkContext.applicationId, folder)
    if place not in _DONE:
        table = DatedTable(spark, new_folder(spark, "gappy"))
        rows = _rows(spark, folder)
        table.create(rows)
        state = DailyState(table, new_folder(spark, "state"), list(_TYPES), ["actual_power", "supply"], "is_holiday")
        state.refresh()
        doubled = F.when(F.col("event_id") % 3 != 0, F.col("actual_power") * 2).alias("actual_power")
        again = rows.where(F.col("date") == F.lit(REPLACED[0]))
        table.replace_window(again.select(*[doubled if c == "actual_power" else c for c in rows.columns]), *REPLACED)
        _DONE[place] = state, state.refresh()
    return _DONE[place]


def _days(spark, folder) -> DataFrame:
    return _state(spark, folder)[0].days(FIRST, LAST)


@query(f"SELECT DISTINCT CAST(ts AS DATE) AS date FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '{REPLACED[0]}' AND DATE '{REPLACED[1]}'")
def stored_state_touched(spark, folder):
    """Dates whose state was made again after the replacement."""
    state, touched = _state(spark, folder)
    return state.source.spark.createDataFrame([(d,) for d in touched], "date date")


@query(
    over(
        "",
        """SELECT c AS "column", n AS missing_count, n / total * 100 AS missing_percentage, t AS data_type FROM (
        SELECT unnest(['site', 'actual_power', 'supply']) AS c, unnest(['string', 'double', 'bigint']) AS t,
          unnest([COUNT(*) - COUNT(site), COUNT(*) - COUNT(actual_power), COUNT(*) - COUNT(supply)]) AS n,
          COUNT(*) AS total FROM part)""",
        **_VIEWS,
    )
)
def stored_null_profile(spark, folder):
    return null_profile_of(_days(spark, folder), _TYPES)


@query(
    over(
        "",
        """SELECT COUNT(*) AS total_rows, CAST(3 AS BIGINT) AS total_columns, COUNT(*) * 3 AS total_cells,
        CAST(SUM(n) AS BIGINT) AS total_missing, SUM(n) / (COUNT(*) * 3) * 100 AS missing_percentage,
        COUNT(*) FILTER (WHERE n = 0) AS complete_rows, COUNT(*) FILTER (WHERE n > 0 AND n < 3) AS partial_rows,
        COUNT(*) FILTER (WHERE n = 3) AS empty_rows FROM flagged""",
        **_VIEWS,
    )
)
def stored_missing_summary(spark, folder):
    return missing_summary_of(_days(spark, folder), len(_TYPES))


@query(
    over(
        "",
        """SELECT date AS day, COUNT(*) FILTER (WHERE n > 0) AS missing_rows, CAST(SUM(n) AS BIGINT) AS missing_cells,
          COUNT(*) FILTER (WHERE site IS NULL) AS site_missing, COUNT(*) FILTER (WHERE actual_power IS NULL)
          AS actual_power_missing, COUNT(*) FILTER (WHERE supply IS NULL) AS supply_missing FROM flagged GROUP BY date""",
        **_VIEWS,
    )
)
def stored_missing_by_day(spark, folder):
    return missing_by_day_of(_days(spark, folder), list(_TYPES))


@query(
    over(
        "",
        """SELECT rows AS missing_rows, cells AS missing_cells, cells / rows AS cells_per_row,
        CASE WHEN cells / rows >= 3 * 0.8 THEN 'all' WHEN cells / rows <= 3 THEN 'partial' ELSE 'mixed' END AS pattern
        FROM (SELECT COUNT(*) FILTER (WHERE n > 0) AS rows, CAST(SUM(n) AS BIGINT) AS cells FROM flagged)""",
        **_VIEWS,
    )
)
def stored_missing_pattern(spark, folder):
    return missing_verdict_of(_days(spark, folder), len(_TYPES))


@query(
    over(
        "",
        """SELECT a.day, CAST(isodow(a.day) - 1 AS INT) AS weekday, a.missing_count,
        CASE WHEN b.flag THEN 'holiday' WHEN NOT b.flag THEN 'workday' ELSE 'unknown' END AS previous_day
        FROM gaps a LEFT JOIN gaps b ON b.day = a.day - 1 WHERE a.missing_count > 0""",
        **_VIEWS,
        gaps="""SELECT date AS day, COUNT(*) FILTER (WHERE actual_power IS NULL) AS missing_count,
          bool_or(is_holiday) AS flag FROM part GROUP BY date""",
    )
)
def stored_gaps_by_day(spark, folder):
    return gaps_by_previous_day_of(_days(spark, folder), "actual_power")


_SHARES = {"median": 0.5, "p1": 0.01, "p99": 0.99}


@query(
    over(
        "",
        """SELECT MIN(actual_power) AS actual_power_min, MAX(actual_power) AS actual_power_max,
          round(AVG(actual_power), 6) AS actual_power_avg, COUNT(*) - COUNT(actual_power) AS actual_power_nulls,
          true AS median_near, true AS p1_near, true AS p99_near FROM part""",
        **_VIEWS,
    )
)
def stored_quantiles(spark, folder):
    """Range and quantiles of a fortnight from the days' sketches; ranks within one percent of the exact ones."""
    found = range_profile_of(_days(spark, folder), {"actual_power": _SHARES})
    table = _state(spark, folder)[0].source.read().where(F.col("date").between(FIRST, LAST) & F.col("actual_power").isNotNull())
    value = F.col("actual_power")

    def near(name: str, share: float):
        at = found.select(f"actual_power_{name}").scalar()
        below, upto = F.avg((value < at).cast("int")), F.avg((value <= at).cast("int"))
        return ((below <= share + 0.01) & (upto >= share - 0.01)).alias(f"{name}_near")

    ranks = table.agg(*[near(n, q) for n, q in _SHARES.items()])
    return found.select(
        "actual_power_min",
        "actual_power_max",
        F.round("actual_power_avg", 6).alias("actual_power_avg"),
        "actual_power_nulls",
        *[ranks.select(f"{n}_near").scalar().alias(f"{n}_near") for n in _SHARES],
    )
