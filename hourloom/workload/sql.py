"""Common table expressions of the SQL each query is compared with (DuckDB dialect)."""

from __future__ import annotations

_HOUR = "CAST(hour(ts) AS INT)"


def half_up(expression: str, digits: int) -> str:
    """Round the decimal value a double prints as, halves away from zero."""
    return f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)"


_PREDICTED = half_up("actual_power * (100 + (hour % 5) - 2 + k) / 100", 2)

# In dependency order; each text may use the names before it.
VIEWS = {
    "readings": f"""
SELECT CAST(ts AS DATE) AS date, {_HOUR} AS hour, event_type AS site,
       value AS actual_power, value * 1.25 AS supply_capacity, ts AS created_at, event_id
FROM events""",
    "energy": f"""
SELECT CAST(ts AS DATE) AS date, {_HOUR} AS hour,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS actual_power,
       CAST(COUNT(*) * 60 AS DOUBLE) AS supply_capacity, MAX(ts) AS created_at
FROM events GROUP BY 1, 2""",
    "site_energy": f"""
SELECT user_id, CAST(ts AS DATE) AS date, {_HOUR} AS hour,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS actual_power,
       CAST(COUNT(*) * 60 AS DOUBLE) AS supply_capacity, MAX(ts) AS created_at
FROM events GROUP BY 1, 2, 3""",
    "weather": f"""
SELECT event_type AS prefecture, CAST(ts AS DATE) AS date, lpad(CAST(hour(ts) AS VARCHAR), 2, '0') AS hour,
       CAST(MIN(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS temperature_2m,
       CAST(MAX(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS relative_humidity_2m,
       CASE WHEN COUNT(*) > 1 THEN CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) END AS precipitation,
       CAST(COUNT(*) AS BIGINT) AS weather_code, MAX(ts) AS created_at
FROM events GROUP BY 1, 2, 3""",
    "site_weather": f"""
SELECT user_id, CAST(ts AS DATE) AS date, lpad(CAST(hour(ts) AS VARCHAR), 2, '0') AS hour,
       CAST(MIN(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS temperature_2m,
       CAST(MAX(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS relative_humidity_2m,
       CASE WHEN COUNT(*) > 1 THEN CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) END AS precipitation,
       CAST(COUNT(*) AS BIGINT) AS weather_code, MAX(ts) AS created_at
FROM events GROUP BY 1, 2, 3""",
    "days": """
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
FROM (SELECT date_trunc('month', MIN(ts)) - INTERVAL 1 MONTH AS lo,
             CAST(last_day(MAX(ts) + INTERVAL 1 MONTH) AS TIMESTAMP) AS hi FROM events) b""",
    "calendar": """
SELECT d AS date, dayname(d) AS day_of_week, isodow(d) >= 6 AS is_weekend,
       d IN (DATE '2024-01-01', DATE '2024-01-08', DATE '2024-02-12') AS is_holiday
FROM days""",
    "ship_days": """
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
FROM (SELECT date_trunc('month', MIN(l_shipdate)) - INTERVAL 1 MONTH AS lo,
             CAST(last_day(MAX(l_shipdate) + INTERVAL 1 MONTH) AS TIMESTAMP) AS hi FROM lineitem) b""",
    "ship_calendar": """
SELECT d AS date, dayname(d) AS day_of_week, isodow(d) >= 6 AS is_weekend,
       d IN (DATE '2024-01-01', DATE '2024-01-08', DATE '2024-02-12') AS is_holiday
FROM ship_days""",
    "predictions": f"""
SELECT 'run-' || CAST(k AS VARCHAR) AS execution_id, date AS prediction_date, hour AS prediction_hour,
       {_PREDICTED} AS predicted_power_kwh,
       CAST(date AS TIMESTAMP) - INTERVAL 1 DAY * k AS created_at
FROM energy CROSS JOIN (VALUES (1), (3), (7)) r(k)""",
    "site_predictions": f"""
SELECT user_id, 'run-' || CAST(k AS VARCHAR) AS execution_id, date AS prediction_date, hour AS prediction_hour,
       {_PREDICTED} AS predicted_power_kwh,
       CAST(date AS TIMESTAMP) - INTERVAL 1 DAY * k AS created_at
FROM site_energy CROSS JOIN (VALUES (1), (3), (7)) r(k)""",
    "run_log": """
SELECT CAST(event_id AS VARCHAR) AS execution_id, CAST(ts AS DATE) AS date, upper(event_type) AS process_type,
       CASE WHEN event_id % 5 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       CASE WHEN event_id % 5 = 0 THEN props END AS error_message,
       ts AS started_at, ts + to_seconds(user_id) AS completed_at,
       value AS duration_seconds, user_id AS records_processed, props AS additional_info
FROM events""",
    "business": """
SELECT date, ROW_NUMBER() OVER (ORDER BY date) AS n FROM calendar WHERE NOT is_holiday AND NOT is_weekend""",
    "mapping": """
SELECT c.date AS base_date, c.date - 1 AS lag_1_day_date, c.date - 7 AS lag_7_day_date, p.date AS lag_1_business_date
FROM calendar c LEFT JOIN business b ON c.date = b.date LEFT JOIN business p ON p.n = b.n - 1""",
    "ship_business": """
SELECT date, ROW_NUMBER() OVER (ORDER BY date) AS n FROM ship_calendar
WHERE NOT is_holiday AND NOT is_weekend""",
    "revenue": """
SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date,
       SUM(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)))
         AS revenue
FROM lineitem GROUP BY 1, 2""",
}

_NEEDS = {
    "calendar": ["days"],
    "ship_calendar": ["ship_days"],
    "predictions": ["energy"],
    "site_predictions": ["site_energy"],
    "business": ["calendar"],
    "mapping": ["calendar", "business"],
    "ship_business": ["ship_calendar"],
}


def _needed(names, seen: set[str]) -> set[str]:
    for name in names:
        if name not in seen:
            seen.add(name)
            _needed(_NEEDS.get(name, ()), seen)
    return seen


def over(names: str, query: str, **more: str) -> str:
    """``query`` after a WITH clause holding the named views, then ``more`` in order."""
    wanted = _needed(names.split(), set())
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in VIEWS if name in wanted]
    parts += [f"{name} AS ({text.strip()})" for name, text in more.items()]
    return f"WITH {', '.join(parts)} {query.strip()}" if parts else query.strip()
