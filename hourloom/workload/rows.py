"""Row-level work: projections, filters, sorts, unions and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hourloom.functions.measures import usage_rate, weekday_label
from hourloom.functions.times import (
    elapsed_seconds,
    hour_cos,
    hour_sin,
    hour_timestamp,
    in_last_days,
    month_key,
    two_digits,
)
from hourloom.operators.profile import null_profile
from hourloom.plans.quality import overall_status, power_period, power_rules, quality_checks, weather_period, weather_rules
from hourloom.workload import adapters
from hourloom.workload.adapters import AS_OF
from hourloom.workload.registry import query
from hourloom.workload.sql import half_up, over


@query("SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS date, o_totalprice AS predicted_power FROM orders")
def projection_rename(spark, folder):
    return adapters.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("predicted_power"),
    )


@query(over("readings", "SELECT date, hour, actual_power FROM readings WHERE date >= DATE '2024-01-31' - 7"))
def rolling_window(spark, folder):
    return adapters.readings(spark, folder).where(in_last_days("date", AS_OF, 7)).select("date", "hour", "actual_power")


@query(
    """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date, l_quantity FROM lineitem
    WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1997-02-01' AND DATE '1997-02-28'"""
)
def closed_range(spark, folder):
    day = F.col("l_shipdate").cast("date")
    return (
        adapters.table(spark, folder, "lineitem")
        .where(day.between(dt.date(1997, 2, 1), dt.date(1997, 2, 28)))
        .select("l_orderkey", "l_linenumber", day.alias("date"), "l_quantity")
    )


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'view'")
def key_filter(spark, folder):
    return (
        adapters.events(spark, folder).where(F.col("event_type") == adapters.SITE).select("event_id", "user_id", "value")
    )


@query(
    over(
        "weather",
        """SELECT prefecture, date, hour, precipitation IS NULL AS dry, (precipitation < 20) IS NULL AS unknown
        FROM weather WHERE precipitation IS NULL OR NOT (precipitation < 20)""",
    )
)
def null_predicates(spark, folder):
    rain = F.col("precipitation")
    return (
        adapters.weather(spark, folder)
        .where(rain.isNull() | ~(rain < 20))
        .select("prefecture", "date", "hour", rain.isNull().alias("dry"), (rain < 20).isNull().alias("unknown"))
    )


@query(
    over(
        "site_energy",
        """SELECT user_id, date, hour, actual_power, supply_capacity FROM site_energy
        WHERE supply_capacity < 100 OR supply_capacity > 300 OR supply_capacity < actual_power""",
    )
)
def out_of_range(spark, folder):
    low = F.col("supply_capacity")
    return (
        adapters.energy(spark, folder, ["user_id"])
        .where((low < 100) | (low > 300) | (low < F.col("actual_power")))
        .select("user_id", "date", "hour", "actual_power", "supply_capacity")
    )


@query(
    over(
        "ship_calendar",
        """SELECT o_orderkey, date, day_of_week FROM orders JOIN ship_calendar ON CAST(o_orderdate AS DATE) = date
        WHERE NOT is_holiday AND NOT is_weekend""",
    )
)
def business_days_only(spark, folder):
    cal = adapters.ship_calendar(spark, folder).where(~F.col("is_holiday") & ~F.col("is_weekend"))
    orders = adapters.table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    return orders.join(cal, "date").select("o_orderkey", "date", "day_of_week")


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CASE WHEN l_discount > 0 THEN l_tax / l_discount END AS tax_share,
      CASE WHEN l_quantity > 0 THEN {half_up('l_extendedprice / l_quantity', 1)} END AS unit_price FROM lineitem"""
)
def guarded_case(spark, folder):
    return adapters.table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.when(F.col("l_discount") > 0, F.col("l_tax") / F.col("l_discount")).alias("tax_share"),
        F.when(F.col("l_quantity") > 0, F.round(F.col("l_extendedprice") / F.col("l_quantity"), 1)).alias("unit_price"),
    )


_LABEL_SQL = """CASE dayname(%s) WHEN 'Monday' THEN '月' WHEN 'Tuesday' THEN '火' WHEN 'Wednesday' THEN '水'
  WHEN 'Thursday' THEN '木' WHEN 'Friday' THEN '金' WHEN 'Saturday' THEN '土' WHEN 'Sunday' THEN '日' END"""


@query(f"SELECT o_orderkey, {_LABEL_SQL % 'o_orderdate'} AS weekday_jp FROM orders")
def weekday_labels(spark, folder):
    return adapters.table(spark, folder, "orders").select(
        "o_orderkey", weekday_label(F.date_format("o_orderdate", "EEEE")).alias("weekday_jp")
    )


@query(over("site_energy", "SELECT user_id, date, hour, actual_power FROM site_energy ORDER BY date, hour, user_id"))
def ordered_by_time(spark, folder):
    rows = adapters.energy(spark, folder, ["user_id"]).select("user_id", "date", "hour", "actual_power")
    return rows.orderBy("date", "hour", "user_id")


@query(
    """SELECT CAST(l_shipdate AS DATE) AS date, COUNT(*) AS rows FROM lineitem GROUP BY 1
    ORDER BY rows DESC, date LIMIT 10"""
)
def busiest_days(spark, folder):
    days = adapters.table(spark, folder, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("date"))
    return days.agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "date").limit(10)


@query(
    over(
        "weather",
        """SELECT c AS "column", n AS missing_count FROM (
          SELECT unnest(['date', 'hour', 'precipitation', 'prefecture']) AS c,
            unnest([COUNT(*) - COUNT(date), COUNT(*) - COUNT(hour), COUNT(*) - COUNT(precipitation),
              COUNT(*) - COUNT(prefecture)]) AS n FROM weather) ORDER BY n DESC, c""",
    )
)
def null_counts_sorted(spark, folder):
    rows = adapters.weather(spark, folder)
    return null_profile(rows, ["date", "hour", "precipitation", "prefecture"]).select("column", "missing_count")


def all_findings(spark, folder):
    power = quality_checks(
        adapters.energy(spark, folder),
        "power",
        power_rules((200, 1400), (300, 1700)),
        power_period(AS_OF, 7),
        AS_OF,
    )
    weather = quality_checks(
        adapters.weather(spark, folder).where(F.col("prefecture") == adapters.SITE),
        "weather",
        weather_rules(),
        weather_period(AS_OF, 7),
        AS_OF,
    )
    return power.unionByName(weather)


def _counted(checks: list[tuple[str, str, str, str]], source: str, data_type: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{data_type}' AS data_type, '{kind}' AS check_type, '{target}' AS check_target, "
        f"{count} AS issue_count, {text} AS issue_detail FROM {source}"
        for kind, target, count, text in checks
    )


def _counted_rules(source: str, data_type: str, expected: int, rules: list[tuple[str, str, str, str]]) -> str:
    found = [
        (
            "missing",
            "全体",
            f"{expected} - COUNT(*)",
            f"'期待レコード数: {expected}, 実際: ' || COUNT(*) || ', 欠損: ' || ({expected} - COUNT(*))",
        )
    ]
    for kind, target, hit, limits in rules:
        count = f"COUNT(*) FILTER (WHERE {hit})"
        text = f"'{target}がNULLのレコード: '" if kind == "null" else f"'{target}が異常範囲（{limits}）: '"
        found.append((kind, target, count, f"{text} || {count} || '件'"))
    return _counted(found, source, data_type)


_STATUS_SQL = """CASE WHEN issue_count = 0 THEN 'OK' WHEN issue_count < CASE check_type WHEN 'missing' THEN 24
  WHEN 'null' THEN 10 ELSE 5 END THEN 'WARNING' ELSE 'ERROR' END AS status"""

POWER_COUNTS = _counted_rules(
    "power_rows",
    "power",
    24 * 7,
    [
        ("null", "actual_power", "actual_power IS NULL", ""),
        ("null", "supply_capacity", "supply_capacity IS NULL", ""),
        ("outlier", "actual_power", "actual_power < 200 OR actual_power > 1400", "<200 or >1400"),
        (
            "outlier",
            "supply_capacity",
            "supply_capacity < 300 OR supply_capacity > 1700 OR supply_capacity < actual_power",
            "<300 or >1700 or <actual_power",
        ),
    ],
)
WEATHER_COUNTS = _counted_rules(
    "weather_rows",
    "weather",
    24 * 21,
    [
        ("null", "temperature_2m", "temperature_2m IS NULL", ""),
        ("null", "relative_humidity_2m", "relative_humidity_2m IS NULL", ""),
        ("outlier", "temperature_2m", "temperature_2m < -10 OR temperature_2m > 50", "<-10 or >50"),
        ("outlier", "relative_humidity_2m", "relative_humidity_2m < 0 OR relative_humidity_2m > 100", "<0 or >100"),
        ("outlier", "precipitation", "precipitation < 0 OR precipitation > 40", "<0 or >40"),
    ],
)
CHECK_VIEWS = {
    "power_rows": "SELECT * FROM energy WHERE date BETWEEN DATE '2024-01-24' AND DATE '2024-01-30'",
    "weather_rows": """SELECT * FROM weather WHERE prefecture = 'view'
        AND date BETWEEN DATE '2024-01-24' AND DATE '2024-02-13'""",
    "counts": f"{POWER_COUNTS} UNION ALL {WEATHER_COUNTS}",
    "findings": f"""SELECT DATE '2024-01-31' AS check_date, TIMESTAMP '2024-01-31' AS check_timestamp, *,
        DATE '2024-01-24' AS check_period_start,
        CASE data_type WHEN 'power' THEN DATE '2024-01-30' ELSE DATE '2024-02-13' END AS check_period_end,
        {_STATUS_SQL} FROM counts""",
}


@query(over("energy weather", "SELECT * FROM findings", **CHECK_VIEWS))
def quality_findings(spark, folder):
    """Power and weather findings in one list."""
    return all_findings(spark, folder)


@query(
    over(
        "energy weather",
        """SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE status = 'ERROR') AS error_count,
        COUNT(*) FILTER (WHERE status = 'WARNING') AS warning_count, COUNT(*) FILTER (WHERE status = 'OK') AS ok_count,
        CASE MAX(CASE status WHEN 'ERROR' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END)
          WHEN 2 THEN 'ERROR' WHEN 1 THEN 'WARNING' ELSE 'OK' END AS overall_status FROM findings""",
        **CHECK_VIEWS,
    )
)
def quality_overall(spark, folder):
    return overall_status(all_findings(spark, folder))


_TEXTS = """CASE check_type
    WHEN 'missing' THEN '期待レコード数: 720, 実際: ' || found || ', 欠損: ' || issue_count
    WHEN 'null' THEN check_target || 'がNULLのレコード: ' || issue_count || '件'
    ELSE check_target || 'が異常範囲（' || limits || '）: ' || issue_count || '件' END"""


@query(
    over(
        "site_energy",
        f"""SELECT user_id, DATE '2024-01-31' AS check_date, TIMESTAMP '2024-01-31' AS check_timestamp, 'power' AS data_type,
          check_type, check_target, issue_count, {_TEXTS} AS issue_detail,
          DATE '2024-01-01' AS check_period_start, DATE '2024-01-30' AS check_period_end, {_STATUS_SQL} FROM (
          SELECT user_id, COUNT(*) AS found, unnest(['missing', 'null', 'null', 'outlier', 'outlier']) AS check_type,
            unnest(['全体', 'actual_power', 'supply_capacity', 'actual_power', 'supply_capacity']) AS check_target,
            unnest(['', '', '', '<1 or >90', '<60 or >120 or <actual_power']) AS limits,
            unnest([720 - COUNT(*), COUNT(*) FILTER (WHERE actual_power IS NULL),
              COUNT(*) FILTER (WHERE supply_capacity IS NULL),
              COUNT(*) FILTER (WHERE actual_power < 1 OR actual_power > 90),
              COUNT(*) FILTER (WHERE supply_capacity < 60 OR supply_capacity > 120 OR supply_capacity < actual_power)
            ]) AS issue_count
          FROM site_energy WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' GROUP BY user_id)""",
    )
)
def quality_by_site(spark, folder):
    return quality_checks(
        adapters.energy(spark, folder, ["user_id"]),
        "power",
        power_rules((1, 90), (60, 120)),
        power_period(AS_OF, 30),
        AS_OF,
        by=["user_id"],
    )


@query("SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS month FROM orders")
def distinct_months(spark, folder):
    return adapters.table(spark, folder, "orders").select(month_key(F.col("o_orderdate")).alias("month")).distinct()


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) - 30 AS a_month_before,
      date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days_ahead,
      month(l_shipdate) AS month, CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
      last_day(l_shipdate) AS month_end, CAST(isodow(l_shipdate) - 1 AS INT) AS weekday,
      CAST(l_shipdate AS DATE) + to_hours(CAST(l_linenumber AS INT)) AS hour_of_day
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def date_functions(spark, folder):
    day = F.col("l_shipdate").cast("date")
    orders = adapters.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    rows = adapters.table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.date_sub(day, 30).alias("a_month_before"),
        F.datediff(day, F.col("o_orderdate").cast("date")).cast("long").alias("days_ahead"),
        F.month(day).cast("long").alias("month"),
        F.trunc(day, "month").alias("month_start"),
        F.last_day(day).alias("month_end"),
        F.weekday(day).alias("weekday"),
        hour_timestamp(day, F.col("l_linenumber").cast("int")).alias("hour_of_day"),
    )


@query(
    over(
        "run_log",
        """SELECT execution_id, date_diff('microsecond', started_at, completed_at) / 1000000.0 AS seconds,
        CAST(started_at AS DATE) AS date, lpad(CAST(hour(started_at) AS VARCHAR), 2, '0') AS hour,
        CAST(lpad(CAST(hour(started_at) AS VARCHAR), 2, '0') AS INT) AS hour_number,
        CAST(strptime(strftime(started_at, '%Y/') || month(started_at) || '/' || day(started_at), '%Y/%m/%d') AS DATE)
          AS parsed_date FROM run_log""",
    )
)
def time_functions(spark, folder):
    started = F.col("started_at")
    text = two_digits(F.hour(started))
    return adapters.run_log(spark, folder).select(
        "execution_id",
        elapsed_seconds(started, F.col("completed_at")).alias("seconds"),
        started.cast("date").alias("date"),
        text.alias("hour"),
        text.cast("int").alias("hour_number"),
        F.to_date(F.date_format(started, "y/M/d"), "y/M/d").alias("parsed_date"),
    )


@query(
    f"""SELECT event_id, round(sin(2 * pi() * hour(ts) / 24), 6) AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 6)
      AS hour_cos, abs(value - 20) AS distance, {half_up('value', 1)} AS one_digit,
      value / nullif(user_id % 3, 0) AS share FROM events"""
)
def math_functions(spark, folder):
    hour, value = F.hour("ts"), F.col("value")
    return adapters.events(spark, folder).select(
        "event_id",
        F.round(hour_sin(hour), 6).alias("hour_sin"),
        F.round(hour_cos(hour), 6).alias("hour_cos"),
        F.abs(value - 20).alias("distance"),
        F.round(value, 1).alias("one_digit"),
        (value / F.nullif(F.col("user_id") % 3, F.lit(0))).alias("share"),
    )


@query(
    """SELECT event_id, '{"user":' || user_id || ',"type":"' || event_type || '"}' AS details,
      CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'k=' || CAST(json_extract(props, '$.k') AS BIGINT) || '件' AS text,
      left(props || event_type, 8) AS cut, coalesce(nullif(event_type, 'view'), 'WARNING') AS status FROM events"""
)
def text_functions(spark, folder):
    k = F.get_json_object("props", "$.k").cast("long")
    return adapters.events(spark, folder).select(
        "event_id",
        F.to_json(F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type"))).alias("details"),
        k.alias("k"),
        F.format_string("k=%d件", k).alias("text"),
        F.left(F.concat("props", "event_type"), F.lit(8)).alias("cut"),
        F.coalesce(F.nullif(F.col("event_type"), F.lit("view")), F.lit("WARNING")).alias("status"),
    )


@query(
    over(
        "site_energy",
        f"""SELECT user_id, date, hour, CASE WHEN supply_capacity > 0
          THEN {half_up('actual_power / supply_capacity * 100', 1)} END AS usage_rate FROM site_energy""",
    )
)
def usage_rates(spark, folder):
    rate = usage_rate(F.col("actual_power"), F.col("supply_capacity"))
    return adapters.energy(spark, folder, ["user_id"]).select("user_id", "date", "hour", rate.alias("usage_rate"))
