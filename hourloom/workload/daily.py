"""Two successive daily runs over stored tables, the second with a file that comes late.

Each query compares one table, as the runs left it, with the same table made from everything
in one go.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.operators.profile import null_counts
from hourloom.plans.daily import Warehouse, daily_run
from hourloom.plans.forecast import same_hour_last_week
from hourloom.plans.quality import power_rules, weather_rules
from hourloom.plans.status import PROCESSES
from hourloom.shared import new_folder, written
from hourloom.sources.tables import PREDICTION_COLUMNS
from hourloom.workload import adapters
from hourloom.workload.marts import _FEATURES, _dashboard_sql, _rounded
from hourloom.workload.registry import query
from hourloom.workload.rows import _STATUS_SQL
from hourloom.workload.sql import half_up, over

KEY = "event_type"
FIRST, SECOND = dt.date(2024, 1, 20), dt.date(2024, 1, 21)
# A Friday: the days after it, the Monday's business lag and the week's lag look at it.
LATE = dt.date(2024, 1, 12)
_LIMITS = ((1, 500), (60, 1200))

_DONE: dict[tuple[str, str], Warehouse] = {}


def _with_every_hour(weather: DataFrame, first: dt.date) -> DataFrame:
    """The 14 days from ``first`` hour by hour, empty where unknown."""
    hours = F.explode(F.sequence(F.lit(0), F.lit(14 * 24 - 1))).alias("i")
    frame = weather.select(KEY).distinct().select(KEY, hours)
    frame = frame.select(
        KEY,
        F.date_add(F.lit(first), (F.col("i") / 24).cast("int")).alias("date"),
        F.lpad((F.col("i") % 24).cast("string"), 2, "0").alias("hour"),
    )
    return frame.join(weather, [KEY, "date", "hour"], "left")


def _ticks():
    """A clock that moves on by a second each time it is read."""
    at = dt.datetime(2024, 1, 21, 7)
    while True:
        at += dt.timedelta(seconds=1)
        yield at


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The tables after both runs; made once per application."""
    place = (spark.sparkContext.applicationId, folder)
    if place in _DONE:
        return _DONE[place]
    clock = _ticks()
    w = Warehouse(
        spark,
        new_folder(spark, "daily"),
        adapters.calendar(spark, folder),
        adapters.lag_mapping(spark, folder),
        [KEY],
        power_rules=power_rules(*_LIMITS),
        weather_rules=weather_rules(),
        clock=lambda: next(clock),
    )
    # The files of both runs are cut from these; the events behind them are read once for each.
    energy = written(adapters.energy(spark, folder, [KEY]), "daily-readings")
    weather = written(adapters.weather(spark, folder, KEY, KEY), "daily-weather")
    date = F.col("date")
    earlier = adapters.predictions_of(energy, [KEY]).where(F.col("prediction_date") < F.lit(FIRST))
    run_date = F.col("created_at").cast("date")
    w.predictions.append(earlier.withColumn("prediction_run_date", run_date).select(KEY, *PREDICTION_COLUMNS))
    known = energy.where((date < F.lit(FIRST)) & ~((date == F.lit(LATE)) & (F.col("hour") >= 12)))
    past = weather.where(date < F.lit(FIRST))
    daily_run(w, FIRST, [known], [past, _with_every_hour(weather, FIRST)], same_hour_last_week)
    w.features.take_note("watch", w.features.changes("watch").upto)
    late, new = energy.where(date == F.lit(LATE)), energy.where(date == F.lit(FIRST))
    daily_run(w, SECOND, [new, late], [_with_every_hour(weather, SECOND)], same_hour_last_week)
    _DONE[place] = w
    return w


_BY_KEY = {
    "key_energy": """SELECT event_type, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INT) AS hour,
      CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS actual_power,
      CAST(COUNT(*) * 60 AS DOUBLE) AS supply_capacity, MAX(ts) AS created_at
      FROM events WHERE ts < TIMESTAMP '2024-01-21' GROUP BY ALL""",
    "key_weather": """SELECT prefecture AS event_type, * EXCLUDE (prefecture) FROM weather
      WHERE date < DATE '2024-02-04'""",
}
_ALL = _FEATURES.format(
    keys="e.event_type,",
    energy="key_energy",
    weather="key_weather",
    **{x: f"AND {x}.event_type = e.event_type" for x in "abpw"},
)


@query(over("weather mapping calendar", _ALL, **_BY_KEY))
def daily_features(spark, folder):
    """The feature mart after a late file is the one made from all files."""
    return _rounded(warehouse(spark, folder).features.read())


_REACHED = """SELECT DISTINCT base_date AS date FROM mapping WHERE base_date IN (SELECT d FROM loaded)
    OR lag_1_day_date IN (SELECT d FROM loaded) OR lag_7_day_date IN (SELECT d FROM loaded)
    OR lag_1_business_date IN (SELECT d FROM loaded) OR base_date BETWEEN DATE '2024-01-21' AND DATE '2024-02-03'"""


@query(
    over(
        "mapping energy",
        f"SELECT date FROM ({_REACHED})",
        loaded="SELECT unnest([DATE '2024-01-12', DATE '2024-01-20']) AS d",
    )
)
def daily_touched(spark, folder):
    """Dates of the feature mart that the second run made again."""
    w = warehouse(spark, folder)
    dates = w.features.changes("watch").dates
    return w.mapping.where(F.col("base_date").isin(dates)).select(F.col("base_date").alias("date"))


# An hour without a reading a week (or two) before is forecast as unknown.
_NAIVE = " UNION ALL ".join(
    f"""SELECT s.event_type, 'run-{day}' AS execution_id, s.date AS prediction_date, s.hour AS prediction_hour,
      e.actual_power AS predicted_power_kwh, TIMESTAMP '{day} 07:00:00' AS created_at
    FROM (SELECT event_type, DATE '{day}' + CAST(t AS INT) AS date, CAST(h AS INT) AS hour, t
      FROM (SELECT DISTINCT event_type FROM events) CROSS JOIN generate_series(0, 13) a(t)
        CROSS JOIN generate_series(0, 23) b(h)) s
    LEFT JOIN key_energy e ON e.event_type = s.event_type AND e.hour = s.hour
      AND e.date = s.date - CASE WHEN t < 7 THEN 7 ELSE 14 END"""
    for day in (FIRST, SECOND)
)
_EARLIER = f"""SELECT event_type, 'run-' || CAST(k AS VARCHAR) AS execution_id, date AS prediction_date,
    hour AS prediction_hour, {half_up('actual_power * (100 + (hour % 5) - 2 + k) / 100', 2)} AS predicted_power_kwh,
    CAST(date AS TIMESTAMP) - INTERVAL 1 DAY * k AS created_at
  FROM key_energy CROSS JOIN (VALUES (1), (3), (7)) r(k) WHERE date < DATE '2024-01-20'"""
_RUNS = {"key_runs": f"{_EARLIER} UNION ALL {_NAIVE}"}


@query(
    over(
        "weather",
        "SELECT *, CAST(created_at AS DATE) AS prediction_run_date FROM key_runs",
        **_BY_KEY,
        **_RUNS,
    )
)
def daily_predictions(spark, folder):
    """Two forecasts appended to the earlier ones."""
    return warehouse(spark, folder).predictions.read()


@query(
    over(
        "weather",
        """SELECT p.event_type, execution_id, CAST(p.created_at AS DATE) AS prediction_run_date,
          p.created_at AS prediction_run_datetime, prediction_date, prediction_hour,
          predicted_power_kwh AS predicted_power, actual_power,
          abs(predicted_power_kwh - actual_power) AS error_absolute,
          abs(predicted_power_kwh - actual_power) / nullif(actual_power, 0) * 100 AS error_percentage,
          date_diff('day', CAST(p.created_at AS DATE), prediction_date) AS days_ahead
        FROM key_runs p JOIN key_energy e ON p.prediction_date = e.date AND p.prediction_hour = e.hour
          AND p.event_type = e.event_type""",
        **_BY_KEY,
        **_RUNS,
    )
)
def daily_accuracy(spark, folder):
    """Every forecast against the readings there are now, those of the late file too."""
    return warehouse(spark, folder).accuracy.read()


_VIEWS, _SHOWN = _dashboard_sql("key_energy", "key_weather", "key_runs", key="event_type, ")


@query(over("weather calendar", _SHOWN, **_BY_KEY, **_RUNS, **_VIEWS))
def daily_dashboard(spark, folder):
    return warehouse(spark, folder).dashboard.read()


def _findings_sql(source: str, kind: str, day: dt.date, first: dt.date, last: dt.date, rules) -> str:
    expected = 24 * ((last - first).days + 1)
    found = [
        f"""{{'t': 'missing', 'c': '全体', 'n': {expected} - COUNT(*),
          'd': '期待レコード数: {expected}, 実際: ' || COUNT(*) || ', 欠損: ' || ({expected} - COUNT(*))}}"""
    ]
    for check, column, hit, limits in rules:
        text = f"{column}がNULLのレコード: " if check == "null" else f"{column}が異常範囲（{limits}）: "
        n = f"COUNT(*) FILTER (WHERE {hit})"
        found.append(f"{{'t': '{check}', 'c': '{column}', 'n': {n}, 'd': '{text}' || {n} || '件'}}")
    return f"""SELECT event_type, DATE '{day}' AS check_date, TIMESTAMP '{day}' AS check_timestamp, '{kind}' AS data_type,
      f.t AS check_type, f.c AS check_target, f.n AS issue_count, f.d AS issue_detail,
      DATE '{first}' AS check_period_start, DATE '{last}' AS check_period_end
    FROM (SELECT event_type, unnest([{", ".join(found)}]) AS f FROM {source}
      WHERE date BETWEEN DATE '{first}' AND DATE '{last}' GROUP BY event_type)"""


_POWER = [
    ("null", "actual_power", "actual_power IS NULL", ""),
    ("null", "supply_capacity", "supply_capacity IS NULL", ""),
    ("outlier", "actual_power", "actual_power < 1 OR actual_power > 500", "<1 or >500"),
    (
        "outlier",
        "supply_capacity",
        "supply_capacity < 60 OR supply_capacity > 1200 OR supply_capacity < actual_power",
        "<60 or >1200 or <actual_power",
    ),
]
_WEATHER = [
    ("null", "temperature_2m", "temperature_2m IS NULL", ""),
    ("null", "relative_humidity_2m", "relative_humidity_2m IS NULL", ""),
    ("outlier", "temperature_2m", "temperature_2m < -10 OR temperature_2m > 50", "<-10 or >50"),
    ("outlier", "relative_humidity_2m", "relative_humidity_2m < 0 OR relative_humidity_2m > 100", "<0 or >100"),
    ("outlier", "precipitation", "precipitation < 0 OR precipitation > 40", "<0 or >40"),
]
_WEEK = dt.timedelta(days=7)
_FOUND = {
    # What a run saw: the late file came with the second run; weather ahead hour by hour.
    "hours": """SELECT event_type, DATE '2024-01-20' + CAST(i AS INT) AS date, lpad(CAST(h AS VARCHAR), 2, '0') AS hour
      FROM (SELECT DISTINCT event_type FROM events) CROSS JOIN generate_series(0, 14) g(i) CROSS JOIN generate_series(0, 23) t(h)""",
    "weather_then": """SELECT * FROM hours LEFT JOIN key_weather USING (event_type, date, hour)
      UNION ALL BY NAME SELECT * FROM key_weather WHERE date < DATE '2024-01-20'""",
    "energy_then": "SELECT * FROM key_energy WHERE date < DATE '2024-01-20' AND NOT (date = DATE '2024-01-12' AND hour >= 12)",
    "found": " UNION ALL ".join(
        [
            _findings_sql("energy_then", "power", FIRST, FIRST - _WEEK, FIRST - dt.timedelta(days=1), _POWER),
            _findings_sql("key_energy", "power", SECOND, SECOND - _WEEK, SECOND - dt.timedelta(days=1), _POWER),
            _findings_sql("weather_then", "weather", FIRST, FIRST - _WEEK, FIRST + dt.timedelta(days=13), _WEATHER),
            _findings_sql("weather_then", "weather", SECOND, SECOND - _WEEK, SECOND + dt.timedelta(days=13), _WEATHER),
        ]
    ),
    "graded": f"SELECT *, {_STATUS_SQL} FROM found",
}


@query(over("weather", "SELECT * FROM graded", **_BY_KEY, **_FOUND))
def daily_findings(spark, folder):
    """The findings of both days, each as of its day."""
    return warehouse(spark, folder).findings.read()


@query(over("weather", "SELECT * FROM graded WHERE check_date = DATE '2024-01-21'", **_BY_KEY, **_FOUND))
def daily_findings_export(spark, folder):
    """The findings of the second day as they were exported, one JSON object a line."""
    w = warehouse(spark, folder)
    return spark.read.schema(w.findings.read().schema).json(f"{w.root}/findings-{SECOND}")


def _board_sql() -> str:
    shown = ", ".join(
        f"'OK' AS {p}_status, CAST(NULL AS VARCHAR) AS {p}_message, 1.0::DOUBLE AS {p}_duration_seconds" for p in PROCESSES
    )
    return f"""SELECT {shown}, f.status AS data_quality_status, f.issue_detail AS data_quality_message,
      CAST(NULL AS DOUBLE) AS data_quality_duration_seconds
    FROM (SELECT arg_max(g, (check_timestamp, list_position(['OK', 'WARNING', 'ERROR'], status), check_type, check_target,
      issue_detail)) AS f FROM graded g)"""


@query(over("weather", _board_sql(), **_BY_KEY, **_FOUND))
def daily_board(spark, folder):
    return spark.read.parquet(warehouse(spark, folder).status_path)


def _failures(mart: str, source: str) -> str:
    return f"""SELECT '{mart}' AS mart, unnest(['date', 'hour']) AS "column",
      unnest([COUNT(*) FILTER (WHERE date IS NULL), COUNT(*) FILTER (WHERE hour IS NULL)]) AS failures FROM ({source})"""


@query(
    over(
        "weather mapping calendar",
        f"{_failures('ml_features', _ALL)} UNION ALL {_failures('dashboard', _SHOWN)}",
        **_BY_KEY,
        **_RUNS,
        **_VIEWS,
    )
)
def daily_not_null_tests(spark, folder):
    """The not-null tests of both stored marts."""
    w = warehouse(spark, folder)
    tests = [
        null_counts(table.read(), ["date", "hour"]).select(F.lit(mart).alias("mart"), "column", "failures")
        for mart, table in (("ml_features", w.features), ("dashboard", w.dashboard))
    ]
    return tests[0].unionByName(tests[1])
