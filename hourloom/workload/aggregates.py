"""Profiles, pivots and missing-value reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.operators.profile import (
    count_gaps_by_previous_day,
    gaps_by_previous_day,
    missing_by_day,
    missing_summary,
    missing_verdict,
    null_counts,
    null_profile,
    range_profile,
    worst_days,
)
from hourloom.plans.accuracy import accuracy_by_days_ahead, prediction_accuracy
from hourloom.plans.features import weather_at
from hourloom.workload import adapters
from hourloom.workload.adapters import AS_OF
from hourloom.workload.marts import site_features
from hourloom.workload.registry import query
from hourloom.workload.sql import over


def _rounded_averages(df):
    """Sums of doubles differ in the last digits with the order of the rows."""
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c.endswith("_avg")})


def _profile_sql(column: str, quantiles: dict[str, float]) -> str:
    parts = [f"MIN({column}) AS {column}_min", f"MAX({column}) AS {column}_max", f"round(AVG({column}), 6) AS {column}_avg"]
    parts += [f"quantile_disc({column}, {q}) AS {column}_{name}" for name, q in quantiles.items()]
    parts.append(f"COUNT(*) FILTER (WHERE {column} IS NULL) AS {column}_nulls")
    return ", ".join(parts)


_POWER = {"median": 0.5, "p1": 0.01, "p99": 0.99}
_RAIN = {"median": 0.5, "p1": 0.01, "p95": 0.95, "p99": 0.99}
# Half of all quantities are 25 or less, so a sketch may give 25 or 26 as their median.
_TAILS = {"p1": 0.01, "p95": 0.95, "p99": 0.99}


@query(over("energy", f"SELECT {_profile_sql('actual_power', _POWER)}, {_profile_sql('supply_capacity', _POWER)} FROM energy"))
def power_profile(spark, folder):
    return _rounded_averages(range_profile(adapters.energy(spark, folder), ["actual_power", "supply_capacity"]))


@query(
    over(
        "weather",
        f"""SELECT {_profile_sql('precipitation', _RAIN)},
        COUNT(*) FILTER (WHERE precipitation < 0) AS precipitation_negative_count, COUNT(*) AS total_records
        FROM weather WHERE prefecture = 'view'""",
    )
)
def precipitation_profile(spark, folder):
    rows = adapters.weather(spark, folder).where(F.col("prefecture") == adapters.SITE)
    return _rounded_averages(range_profile(rows, {"precipitation": _RAIN}, ["precipitation"], "total_records"))


@query(
    f"""SELECT {_profile_sql('l_quantity', _TAILS)}, {_profile_sql('l_discount', _RAIN)},
    COUNT(*) AS total_records FROM lineitem"""
)
def line_profile(spark, folder):
    rows = adapters.table(spark, folder, "lineitem")
    return _rounded_averages(range_profile(rows, {"l_quantity": _TAILS, "l_discount": _RAIN}, total="total_records"))


@query(
    """SELECT MIN(l_extendedprice) AS l_extendedprice_min, MAX(l_extendedprice) AS l_extendedprice_max,
    TRUE AS p1_close, TRUE AS median_close, TRUE AS p99_close FROM lineitem"""
)
def quantiles_are_close(spark, folder):
    """Prices have too many values for exact quantiles: their ranks are within the bound."""
    rows = adapters.table(spark, folder, "lineitem").select("l_extendedprice")
    profile = range_profile(rows, {"l_extendedprice": _POWER}, accuracy=10_000)
    below = rows.agg(
        *[
            F.avg((F.col("l_extendedprice") <= profile.select(f"l_extendedprice_{name}").scalar()).cast("int")).alias(name)
            for name in _POWER
        ]
    )
    return profile.select(
        "l_extendedprice_min",
        "l_extendedprice_max",
        *[
            (F.abs(below.select(name).scalar() - F.lit(q)) <= 2 / 10_000).alias(f"{name}_close")
            for name, q in _POWER.items()
        ],
    )


@query(
    """SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE l_discount < 0.02 OR l_discount > 0.08) AS odd_discounts,
    COUNT(*) FILTER (WHERE l_quantity < 2 OR l_quantity > 49) AS odd_quantities,
    COUNT(*) FILTER (WHERE l_tax IS NULL) AS null_taxes FROM lineitem"""
)
def filtered_counts(spark, folder):
    discount, quantity = F.col("l_discount"), F.col("l_quantity")
    return adapters.table(spark, folder, "lineitem").agg(
        F.count("*").alias("rows"),
        F.count_if((discount < 0.02) | (discount > 0.08)).alias("odd_discounts"),
        F.count_if((quantity < 2) | (quantity > 49)).alias("odd_quantities"),
        F.count_if(F.col("l_tax").isNull()).alias("null_taxes"),
    )


_PRIORITIES = {"urgent": "1-URGENT", "high": "2-HIGH", "low": "5-LOW", "absent": "9-NONE"}


@query(
    f"""SELECT {', '.join(
        f"arg_max(o_orderstatus, (o_orderdate, o_orderkey)) FILTER (WHERE o_orderpriority = '{v}') AS {k}_status"
        for k, v in _PRIORITIES.items()
    )} FROM orders"""
)
def conditional_pivot(spark, folder):
    """The latest status of each priority, side by side; one row whatever there is."""
    latest = F.struct("o_orderdate", "o_orderkey")

    def of(priority: str):
        here = F.col("o_orderpriority") == priority
        return F.max_by(F.when(here, F.col("o_orderstatus")), F.when(here, latest))

    return adapters.table(spark, folder, "orders").agg(
        *[of(value).alias(f"{name}_status") for name, value in _PRIORITIES.items()]
    )


_GAPPY = """SELECT CAST(ts AS DATE) AS date, nullif(event_type, 'error') AS site,
  CASE WHEN event_id % 7 <> 0 THEN value END AS actual_power,
  CASE WHEN event_id % 5 <> 0 AND event_type <> 'error' THEN user_id END AS supply FROM events"""
_GAP_COLUMNS = ["date", "site", "actual_power", "supply"]
_NULLS = "(site IS NULL)::INT + (actual_power IS NULL)::INT + (supply IS NULL)::INT"


def _gappy(spark, folder):
    """Events with NULLs by rule."""
    key = F.col("event_id")
    kind = F.col("event_type")
    return adapters.events(spark, folder).select(
        F.col("ts").cast("date").alias("date"),
        F.nullif(kind, F.lit("error")).alias("site"),
        F.when(key % 7 != 0, F.col("value")).alias("actual_power"),
        F.when((key % 5 != 0) & (kind != "error"), F.col("user_id")).alias("supply"),
    )


@query(
    over(
        "",
        """SELECT c AS "column", n AS missing_count, n / total * 100 AS missing_percentage, t AS data_type FROM (
        SELECT unnest(['date', 'site', 'actual_power', 'supply']) AS c,
          unnest(['date', 'string', 'double', 'bigint']) AS t,
          unnest([COUNT(*) - COUNT(date), COUNT(*) - COUNT(site), COUNT(*) - COUNT(actual_power),
            COUNT(*) - COUNT(supply)]) AS n, COUNT(*) AS total FROM gappy)""",
        gappy=_GAPPY,
    )
)
def missing_value_profile(spark, folder):
    return null_profile(_gappy(spark, folder))


@query(
    over(
        "",
        f"""SELECT COUNT(*) AS total_rows, CAST(4 AS BIGINT) AS total_columns, COUNT(*) * 4 AS total_cells,
        CAST(SUM(n) AS BIGINT) AS total_missing, SUM(n) / (COUNT(*) * 4) * 100 AS missing_percentage,
        COUNT(*) FILTER (WHERE n = 0) AS complete_rows, COUNT(*) FILTER (WHERE n > 0 AND n < 4) AS partial_rows,
        COUNT(*) FILTER (WHERE n = 4) AS empty_rows FROM (SELECT {_NULLS} AS n FROM gappy)""",
        gappy=_GAPPY,
    )
)
def missing_value_summary(spark, folder):
    return missing_summary(_gappy(spark, folder))


_BY_DAY = f"""SELECT date AS day, COUNT(*) FILTER (WHERE n > 0) AS missing_rows, CAST(SUM(n) AS BIGINT) AS missing_cells,
  COUNT(*) FILTER (WHERE site IS NULL) AS site_missing, COUNT(*) FILTER (WHERE actual_power IS NULL)
  AS actual_power_missing, COUNT(*) FILTER (WHERE supply IS NULL) AS supply_missing
  FROM (SELECT *, {_NULLS} AS n FROM gappy) GROUP BY date"""


@query(over("", _BY_DAY, gappy=_GAPPY))
def missing_values_by_day(spark, folder):
    return missing_by_day(_gappy(spark, folder), _GAP_COLUMNS[1:])


@query(
    over(
        "",
        f"SELECT day, missing_rows FROM ({_BY_DAY}) WHERE missing_rows > 0 ORDER BY missing_rows DESC, day LIMIT 10",
        gappy=_GAPPY,
    )
)
def worst_days_by_rows(spark, folder):
    by_day = missing_by_day(_gappy(spark, folder), _GAP_COLUMNS[1:])
    return worst_days(by_day, "missing_rows", 10).select("day", "missing_rows")


@query(
    over("", f"SELECT * FROM ({_BY_DAY}) WHERE missing_cells > 0 ORDER BY missing_cells DESC, day LIMIT 5", gappy=_GAPPY)
)
def worst_days_by_cells(spark, folder):
    return worst_days(missing_by_day(_gappy(spark, folder), _GAP_COLUMNS[1:]), "missing_cells", 5)


@query(
    over(
        "",
        f"""SELECT rows AS missing_rows, cells AS missing_cells, cells / rows AS cells_per_row,
        CASE WHEN cells / rows >= 4 * 0.8 THEN 'all' WHEN cells / rows <= 3 THEN 'partial' ELSE 'mixed' END AS pattern
        FROM (SELECT COUNT(*) FILTER (WHERE n > 0) AS rows, CAST(SUM(n) AS BIGINT) AS cells
          FROM (SELECT {_NULLS} AS n FROM gappy))""",
        gappy=_GAPPY,
    )
)
def missing_pattern(spark, folder):
    return missing_verdict(_gappy(spark, folder))


_LAG_GAPS = """SELECT date AS day, isodow(date) - 1 AS weekday,
    COUNT(*) FILTER (WHERE lag_1_business_day IS NULL) AS missing_count, bool_or(is_holiday) AS flag
  FROM features GROUP BY date"""
_SITE_LAG = """SELECT e.user_id, e.date, e.hour, c.is_holiday, p.actual_power AS lag_1_business_day
  FROM site_energy e LEFT JOIN mapping m ON e.date = m.base_date
  LEFT JOIN site_energy p ON p.user_id = e.user_id AND p.hour = e.hour AND p.date = m.lag_1_business_date
  LEFT JOIN calendar c ON e.date = c.date"""


@query(
    over(
        "site_energy mapping calendar",
        """SELECT a.day, CAST(a.weekday AS INT) AS weekday, a.missing_count,
        CASE WHEN b.flag THEN 'holiday' WHEN NOT b.flag THEN 'workday' ELSE 'unknown' END AS previous_day
        FROM gaps a LEFT JOIN gaps b ON b.day = a.day - 1 WHERE a.missing_count > 0""",
        features=_SITE_LAG,
        gaps=_LAG_GAPS,
    )
)
def lag_gaps_by_day(spark, folder):
    return gaps_by_previous_day(site_features(spark, folder), "lag_1_business_day")


@query(
    over(
        "site_energy mapping calendar",
        """SELECT CASE WHEN b.flag THEN 'holiday' WHEN NOT b.flag THEN 'workday' ELSE 'unknown' END AS previous_day,
        COUNT(*) AS days, CAST(SUM(a.missing_count) AS BIGINT) AS missing_count, MIN(a.day) AS first_day,
        MAX(a.day) AS last_day FROM gaps a LEFT JOIN gaps b ON b.day = a.day - 1 WHERE a.missing_count > 0 GROUP BY 1""",
        features=_SITE_LAG,
        gaps=_LAG_GAPS,
    )
)
def lag_gaps_by_previous_day(spark, folder):
    return count_gaps_by_previous_day(gaps_by_previous_day(site_features(spark, folder), "lag_1_business_day"))


@query(
    over(
        "site_energy site_predictions",
        """SELECT date_diff('day', CAST(p.created_at AS DATE), prediction_date) AS days_ahead, COUNT(*) AS forecasts,
        round(AVG(abs(predicted_power_kwh - actual_power) / nullif(actual_power, 0) * 100), 6) AS mape,
        round(AVG(abs(predicted_power_kwh - actual_power)), 6) AS mae
        FROM site_predictions p JOIN site_energy e ON p.user_id = e.user_id AND p.prediction_date = e.date
          AND p.prediction_hour = e.hour
        WHERE CAST(p.created_at AS DATE) BETWEEN DATE '2024-01-17' AND DATE '2024-01-31'
          AND e.date >= DATE '2024-01-17' AND e.date < DATE '2024-01-31' GROUP BY 1""",
    )
)
def mape_by_days_ahead(spark, folder):
    keys = ["user_id"]
    accuracy = prediction_accuracy(
        adapters.predictions(spark, folder, keys), adapters.energy(spark, folder, keys), AS_OF, keys
    )
    return accuracy_by_days_ahead(accuracy).select(
        "days_ahead", "forecasts", F.round("mape", 6).alias("mape"), F.round("mae", 6).alias("mae")
    )


@query(
    over(
        "weather",
        """SELECT unnest(['date', 'hour', 'precipitation']) AS "column",
        unnest([COUNT(*) - COUNT(date), COUNT(*) - COUNT(CAST(hour AS INT)), COUNT(*) - COUNT(precipitation)]) AS failures
        FROM weather""",
    )
)
def not_null_tests(spark, folder):
    return null_counts(weather_at(adapters.weather(spark, folder), None), ["date", "hour", "precipitation"])
