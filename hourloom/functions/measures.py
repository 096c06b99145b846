"""Error measures, rates, labels and grades as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Short Japanese weekday labels by English weekday name.
WEEKDAY_LABELS = {
    "Monday": "月",
    "Tuesday": "火",
    "Wednesday": "水",
    "Thursday": "木",
    "Friday": "金",
    "Saturday": "土",
    "Sunday": "日",
}

# How a run's logged status is shown on the status board.
RUN_GRADES = {"SUCCESS": "OK", "FAILED": "ERROR"}


def absolute_error(predicted: Column, actual: Column) -> Column:
    return F.abs(predicted - actual)


def error_share_of_positive(predicted: Column, actual: Column) -> Column:
    """Percent error for the dashboard: only where the actual value is above zero."""
    return F.when(actual > 0, F.abs(predicted - actual) / actual * 100)


def error_share_of_nonzero(predicted: Column, actual: Column) -> Column:
    """Percent error for the accuracy table: a negative actual gives a negative share."""
    return F.abs(predicted - actual) / F.nullif(actual, F.lit(0.0)) * 100


def usage_rate(actual: Column, capacity: Column) -> Column:
    return F.when(capacity > 0, F.round(actual / capacity * 100, 1))


def value_map(key: Column, mapping: dict[str, str]) -> Column:
    """Look ``key`` up in a literal map; anything unlisted is NULL."""
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])[key]


def weekday_label(name: Column) -> Column:
    return value_map(name, WEEKDAY_LABELS)


def run_grade(status: Column) -> Column:
    """OK / ERROR for a known run status, WARNING for none or any other."""
    return F.coalesce(value_map(status, RUN_GRADES), F.lit("WARNING"))


def finding_grade(issue_count: Column, warning_below: int) -> Column:
    """0 is OK, anything under the limit (also a negative count) WARNING, the rest ERROR."""
    return (
        F.when(issue_count == 0, "OK").when(issue_count < warning_below, "WARNING").otherwise("ERROR")
    )
