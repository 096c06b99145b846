"""Feature mart, dashboard, accuracy, status board and forecasts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.operators.refresh import append
from hourloom.plans.accuracy import prediction_accuracy
from hourloom.plans.dashboard import dashboard
from hourloom.plans.features import future_features, ml_features
from hourloom.plans.forecast import FEATURES, as_prediction_rows, forecast, model_input, same_hour_last_week
from hourloom.plans.status import system_status
from hourloom.shared import new_folder
from hourloom.workload import adapters
from hourloom.workload.adapters import AS_OF
from hourloom.workload.registry import query
from hourloom.workload.rows import CHECK_VIEWS, all_findings
from hourloom.workload.sql import half_up, over

PLACE = ("prefecture", adapters.SITE)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({"hour_sin": F.round("hour_sin", 6), "hour_cos": F.round("hour_cos", 6)})


_FEATURES = """SELECT {keys} e.date, e.hour, e.actual_power, e.supply_capacity, temperature_2m, relative_humidity_2m,
    precipitation, weather_code, day_of_week, is_weekend, is_holiday, month(e.date) AS month,
    round(sin(2 * pi() * e.hour / 24), 6) AS hour_sin, round(cos(2 * pi() * e.hour / 24), 6) AS hour_cos,
    a.actual_power AS lag_1_day, b.actual_power AS lag_7_day, p.actual_power AS lag_1_business_day
  FROM {energy} e LEFT JOIN mapping m ON e.date = m.base_date
  LEFT JOIN {energy} a ON a.date = m.lag_1_day_date AND a.hour = e.hour {a}
  LEFT JOIN {energy} b ON b.date = m.lag_7_day_date AND b.hour = e.hour {b}
  LEFT JOIN {energy} p ON p.date = m.lag_1_business_date AND p.hour = e.hour {p}
  LEFT JOIN {weather} w ON e.date = w.date AND e.hour = CAST(w.hour AS INT) {w}
  LEFT JOIN calendar c ON e.date = c.date"""
_AREA = _FEATURES.format(
    keys="", energy="energy", weather="weather", a="", b="", p="", w="AND w.prefecture = 'view'"
)
_SITES = _FEATURES.format(
    keys="e.user_id,",
    energy="site_energy",
    weather="site_weather",
    **{x: f"AND {x}.user_id = e.user_id" for x in "abpw"},
)
_RECENT = _FEATURES.format(
    keys="", energy="recent", weather="weather", a="", b="", p="", w="AND w.prefecture = 'view' AND w.date >= DATE '2024-01-17'"
)


@query(over("energy weather mapping calendar", _AREA))
def ml_features_full(spark, folder):
    cal = adapters.calendar(spark, folder)
    return _rounded(
        ml_features(
            adapters.energy(spark, folder),
            adapters.weather(spark, folder),
            cal,
            adapters.lag_mapping(spark, folder),
            PLACE,
            unique=True,
        )
    )


@query(
    over(
        "energy weather mapping calendar",
        _RECENT + " WHERE e.date >= DATE '2024-01-17'",
        recent="SELECT * FROM energy WHERE date >= DATE '2024-01-04'",
    )
)
def ml_features_incremental(spark, folder):
    """Seven days up to a day within the data; later days pass as well."""
    cal = adapters.calendar(spark, folder)
    return _rounded(
        ml_features(
            adapters.energy(spark, folder),
            adapters.weather(spark, folder),
            cal,
            adapters.lag_mapping(spark, folder),
            PLACE,
            as_of=dt.date(2024, 1, 24),
            unique=True,
        )
    )


def site_features(spark: SparkSession, folder: str) -> DataFrame:
    cal = adapters.calendar(spark, folder)
    return ml_features(
        adapters.energy(spark, folder, ["user_id"]),
        adapters.weather(spark, folder, "user_id", "user_id"),
        cal,
        adapters.lag_mapping(spark, folder),
        keys=["user_id"],
        unique=True,
    )


@query(over("site_energy site_weather mapping calendar", _SITES))
def ml_features_by_site(spark, folder):
    return _rounded(site_features(spark, folder))


# Fixed value: what stands for a missing input.
_INPUTS = ", ".join(f"coalesce(CAST({c} AS DOUBLE), -1e9) AS {c}" for c in FEATURES)


@query(
    over(
        "site_energy site_weather mapping calendar",
        f"SELECT actual_power, {_INPUTS} FROM mart WHERE date < DATE '2024-01-16' AND actual_power IS NOT NULL",
        mart=_SITES,
    )
)
def training_input(spark, folder):
    """What the trees of ``forecast_trees`` are fitted to."""
    return _rounded(model_input(site_features(spark, folder), START))


_RATE = half_up("actual_power / supply_capacity * 100", 1)
_DASHBOARD = f"""SELECT * EXCLUDE (predicted_power_kwh), predicted_power_kwh AS predicted_power,
    abs(predicted_power_kwh - actual_power) AS error_absolute,
    if(actual_power > 0, abs(predicted_power_kwh - actual_power) / actual_power * 100, NULL) AS error_percentage,
    if(supply_capacity > 0, {_RATE}, NULL) AS usage_rate,
    map(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'],
      ['月', '火', '水', '木', '金', '土', '日'])[day_of_week] AS weekday_jp
  FROM shown_reading LEFT JOIN shown_weather USING (GRAIN) LEFT JOIN shown_forecast USING (GRAIN)
  LEFT JOIN calendar USING (date)"""


def _dashboard_sql(readings: str, weather: str, runs: str, key: str = "", since: str = "2023-01-01", place: str = "TRUE"):
    """Each source cut to its newest row of an hour, then joined on the hour."""
    grain = f"{key}date, hour"

    def newest(columns: str, source: str) -> str:
        return f"SELECT DISTINCT ON ({grain}) {grain}, {columns} FROM {source} WHERE date >= DATE '{since}' ORDER BY created_at DESC"

    conditions = "temperature_2m, relative_humidity_2m, precipitation, weather_code"
    return {
        "numbered_weather": f"SELECT * REPLACE (CAST(hour AS INT) AS hour) FROM {weather} WHERE {place}",
        "targets": f"SELECT * RENAME (prediction_date AS date, prediction_hour AS hour) FROM {runs}",
        "shown_reading": newest("actual_power, supply_capacity", readings),
        "shown_weather": newest(conditions, "numbered_weather"),
        "shown_forecast": newest("predicted_power_kwh", "targets"),
    }, _DASHBOARD.replace("GRAIN", grain)


_AREA_VIEWS, _AREA_DASHBOARD = _dashboard_sql("readings", "weather", "predictions", place="prefecture = 'view'")
_WEEK_VIEWS, _WEEK_DASHBOARD = _dashboard_sql(
    "readings", "weather", "predictions", since="2024-01-24", place="prefecture = 'view'"
)
_SITE_VIEWS, _SITE_DASHBOARD = _dashboard_sql("site_energy", "site_weather", "site_predictions", key="user_id, ")


@query(over("readings weather calendar predictions", _AREA_DASHBOARD, **_AREA_VIEWS))
def dashboard_full(spark, folder):
    """Readings come in many versions; the latest of each hour counts."""
    return dashboard(
        adapters.readings(spark, folder),
        adapters.weather(spark, folder),
        adapters.calendar(spark, folder),
        adapters.predictions(spark, folder),
        PLACE,
    )


@query(over("readings weather calendar predictions", _WEEK_DASHBOARD, **_WEEK_VIEWS))
def dashboard_incremental(spark, folder):
    return dashboard(
        adapters.readings(spark, folder),
        adapters.weather(spark, folder),
        adapters.calendar(spark, folder),
        adapters.predictions(spark, folder),
        PLACE,
        as_of=AS_OF,
    )


@query(over("site_energy site_weather calendar site_predictions", _SITE_DASHBOARD, **_SITE_VIEWS))
def dashboard_by_site(spark, folder):
    keys = ["user_id"]
    return dashboard(
        adapters.energy(spark, folder, keys),
        adapters.weather(spark, folder, "user_id", "user_id"),
        adapters.calendar(spark, folder),
        adapters.predictions(spark, folder, keys),
        keys=keys,
    )


_ACCURACY = """SELECT {keys} execution_id, CAST(p.created_at AS DATE) AS prediction_run_date,
    p.created_at AS prediction_run_datetime, prediction_date, prediction_hour,
    predicted_power_kwh AS predicted_power, actual_power,
    abs(predicted_power_kwh - actual_power) AS error_absolute,
    abs(predicted_power_kwh - actual_power) / nullif(actual_power, 0) * 100 AS error_percentage,
    date_diff('day', CAST(p.created_at AS DATE), prediction_date) AS days_ahead
  FROM {predictions} p JOIN {energy} e ON p.prediction_date = e.date AND p.prediction_hour = e.hour {more}
  WHERE CAST(p.created_at AS DATE) BETWEEN DATE '2024-01-17' AND DATE '2024-01-31'
    AND prediction_date < DATE '2024-01-31' AND e.date >= DATE '2024-01-17' AND e.date < DATE '2024-01-31'"""


@query(over("energy predictions", _ACCURACY.format(keys="", predictions="predictions", energy="energy", more="")))
def forecast_accuracy(spark, folder):
    return prediction_accuracy(adapters.predictions(spark, folder), adapters.energy(spark, folder), AS_OF)


@query(
    over(
        "site_energy site_predictions",
        _ACCURACY.format(
            keys="p.user_id,", predictions="site_predictions", energy="site_energy", more="AND p.user_id = e.user_id"
        ),
    )
)
def forecast_accuracy_by_site(spark, folder):
    keys = ["user_id"]
    return prediction_accuracy(
        adapters.predictions(spark, folder, keys), adapters.energy(spark, folder, keys), AS_OF, keys
    )


PROCESSES = {
    "click": "CLICK",
    "error": "ERROR",
    "purchase": "PURCHASE",
    "unknown": "NOT_LOGGED",
    "signup": "SIGNUP",
    "view": "VIEW",
}


def _status_sql() -> str:
    newest = ", ".join(
        f"arg_max(run, started_at) FILTER (WHERE process_type = '{process}') AS {name}"
        for name, process in PROCESSES.items()
    )
    shown = ", ".join(
        f"""CASE {name}.status WHEN 'SUCCESS' THEN 'OK' WHEN 'FAILED' THEN 'ERROR' ELSE 'WARNING' END AS {name}_status,
        {name}.message AS {name}_message, {name}.seconds AS {name}_duration_seconds"""
        for name in PROCESSES
    )
    return f"""SELECT {shown}, coalesce(finding.status, 'WARNING') AS data_quality_status,
        finding.issue_detail AS data_quality_message, CAST(NULL AS DOUBLE) AS data_quality_duration_seconds
      FROM (SELECT {newest} FROM runs),
        (SELECT arg_max(f, (check_timestamp, rank, check_type, check_target)) AS finding FROM graded f)"""


@query(
    over(
        "energy weather run_log",
        _status_sql(),
        **CHECK_VIEWS,
        graded="""SELECT *, list_position(['OK', 'WARNING', 'ERROR'], status) AS rank FROM findings""",
        runs="""SELECT process_type, started_at, struct_pack(status := status, message := error_message,
          seconds := date_diff('microsecond', started_at, completed_at) / 1000000.0) AS run
          FROM run_log WHERE date >= DATE '2024-01-29'""",
    )
)
def status_board(spark, folder):
    return system_status(adapters.run_log(spark, folder), all_findings(spark, folder), AS_OF, PROCESSES)


# The day the forecasts start: two weeks of "future" follow it in the data.
START = dt.date(2024, 1, 16)


@query(
    over(
        "weather calendar",
        """SELECT w.date, CAST(w.hour AS INT) AS hour, temperature_2m, relative_humidity_2m, precipitation, weather_code,
        day_of_week, is_weekend, is_holiday, month(w.date) AS month, round(sin(2 * pi() * CAST(hour AS INT) / 24), 6)
          AS hour_sin, round(cos(2 * pi() * CAST(hour AS INT) / 24), 6) AS hour_cos
        FROM (SELECT * FROM weather WHERE prefecture = 'view' AND date BETWEEN DATE '2024-01-16' AND DATE '2024-01-29') w
        LEFT JOIN calendar c ON w.date = c.date""",
    )
)
def future_frame(spark, folder):
    return _rounded(
        future_features(adapters.weather(spark, folder), adapters.calendar(spark, folder), START, PLACE)
    )


def _every_hour(weather: DataFrame, sites: DataFrame) -> DataFrame:
    """Weather with a row for each hour of the 14 days of each site, empty where unknown."""
    hours = F.explode(F.sequence(F.lit(0), F.lit(14 * 24 - 1))).alias("i")
    frame = sites.select("*", hours).select(
        *sites.columns,
        F.date_add(F.lit(START), (F.col("i") / 24).cast("int")).alias("date"),
        F.lpad((F.col("i") % 24).cast("string"), 2, "0").alias("hour"),
    )
    return frame.join(weather, [*sites.columns, "date", "hour"], "left")


def site_future(spark: SparkSession, folder: str, cal: DataFrame) -> DataFrame:
    weather = adapters.weather(spark, folder, "user_id", "user_id")
    sites = adapters.events(spark, folder).select("user_id").distinct()
    return future_features(_every_hour(weather, sites), cal, START, keys=["user_id"])


def _site_history(spark: SparkSession, folder: str, cal: DataFrame) -> DataFrame:
    return adapters.energy(spark, folder, ["user_id"]).join(cal, "date", "left")


_SPINE = """SELECT user_id, DATE '2024-01-16' + CAST(t AS INT) AS date, CAST(h AS INT) AS hour, t
  FROM (SELECT DISTINCT user_id FROM events), generate_series(0, 13) a(t), generate_series(0, 23) b(h)"""


@query(
    over(
        "site_energy",
        """SELECT s.user_id, s.date AS prediction_date, s.hour AS prediction_hour, e.actual_power AS prediction
        FROM spine s LEFT JOIN site_energy e ON e.user_id = s.user_id AND e.hour = s.hour
          AND e.date = s.date - CASE WHEN t < 7 THEN 7 ELSE 14 END""",
        spine=_SPINE,
    )
)
def forecast_seasonal_naive(spark, folder):
    cal = adapters.calendar(spark, folder)
    history, future = _site_history(spark, folder, cal), site_future(spark, folder, cal)
    return forecast(same_hour_last_week, history, future, START, ["user_id"])


def _blend(df: DataFrame) -> DataFrame:
    """A model made of all three lags, to see each of them in the recursion."""
    lags = [F.coalesce(F.col(c), F.lit(0.0)) for c in ("lag_1_day", "lag_7_day", "lag_1_business_day")]
    return df.withColumn("prediction", lags[0] * 0.5 + lags[1] * 0.25 + lags[2] * 0.25)


def _blend_steps() -> dict[str, str]:
    """One SQL view per forecast day, reading the views of the days before it."""
    views = {
        "spine": _SPINE,
        "work": "SELECT date FROM calendar WHERE NOT is_weekend AND NOT is_holiday",
        "known_0": """SELECT user_id, date, hour, actual_power AS v FROM site_energy
          WHERE date BETWEEN DATE '2024-01-16' - 20 AND DATE '2024-01-15'""",
    }
    for t in range(14):
        views[f"step_{t}"] = f"""SELECT s.user_id, s.date, s.hour, coalesce(a.v, 0.0::DOUBLE) * 0.5::DOUBLE
            + coalesce(b.v, 0.0::DOUBLE) * 0.25::DOUBLE + coalesce(w.v, 0.0::DOUBLE) * 0.25::DOUBLE AS v
          FROM (SELECT * FROM spine WHERE t = {t}) s
          LEFT JOIN known_{t} a ON a.user_id = s.user_id AND a.hour = s.hour AND a.date = s.date - 1
          LEFT JOIN known_{t} b ON b.user_id = s.user_id AND b.hour = s.hour AND b.date = s.date - 7
          LEFT JOIN (SELECT user_id, hour, arg_max(v, date) AS v FROM known_{t} SEMI JOIN work USING (date)
            WHERE date >= DATE '2024-01-16' + {t} - 20 GROUP BY 1, 2) w ON w.user_id = s.user_id AND w.hour = s.hour"""
        views[f"known_{t + 1}"] = f"SELECT * FROM known_{t} UNION ALL SELECT * FROM step_{t}"
    return views


@query(
    over(
        "site_energy calendar",
        """SELECT user_id, date AS prediction_date, hour AS prediction_hour, v AS prediction FROM known_14
        WHERE date >= DATE '2024-01-16'""",
        **_blend_steps(),
    )
)
def forecast_of_lags(spark, folder):
    cal = adapters.calendar(spark, folder)
    history, future = _site_history(spark, folder, cal), site_future(spark, folder, cal)
    return forecast(_blend, history, future, START, ["user_id"])


@query(
    over(
        "site_energy",
        """SELECT s.user_id, 'run' AS execution_id, DATE '2024-01-16' AS prediction_run_date, s.date AS prediction_date,
          s.hour AS prediction_hour, e.actual_power AS predicted_power_kwh, TIMESTAMP '2024-01-16 07:01:00' AS created_at
        FROM spine s LEFT JOIN site_energy e ON e.user_id = s.user_id AND e.hour = s.hour
          AND e.date = s.date - CASE WHEN t < 7 THEN 7 ELSE 14 END""",
        spine=_SPINE,
    )
)
def forecast_published(spark, folder):
    """A forecast appended to the prediction table, partitioned by run date."""
    path = new_folder(spark, "predictions")
    rows = as_prediction_rows(
        forecast_seasonal_naive(spark, folder), "run", dt.datetime(2024, 1, 16, 7, 1), ["user_id"]
    )
    append(rows, path, ["prediction_run_date"])
    return spark.read.parquet(path)
