"""Rule-based quality findings, all rules in one pass over the data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.functions.measures import finding_grade
from hourloom.functions.times import moment

# Counts below these are a warning, from these on an error.
WARNING_BELOW = {"missing": 24, "null": 10, "outlier": 5}
HOURS_PER_DAY = 24
FORECAST_DAYS = 14

# Finding texts and the target name of a check on whole rows.
ALL_ROWS = "全体"
MISSING_TEXT = "期待レコード数: %d, 実際: %d, 欠損: %d"
NULL_TEXT = "%sがNULLのレコード: %d件"
OUTLIER_TEXT = "%sが異常範囲（%s）: %d件"

_SEVERITY = {"ERROR": 2, "WARNING": 1, "OK": 0}


@dataclass(frozen=True)
class Rule:
    """``hit`` marks a faulty row; NULL is not a hit."""

    check_type: str
    target: str
    hit: Column
    limits: str = ""


def null_rule(column: str) -> Rule:
    return Rule("null", column, F.col(column).isNull())


def range_rule(column: str, low: float, high: float, at_least: str | None = None) -> Rule:
    """Below ``low``, above ``high`` or, if named, below another column."""
    hit = (F.col(column) < low) | (F.col(column) > high)
    limits = f"<{low} or >{high}"
    if at_least is not None:
        hit = hit | (F.col(column) < F.col(at_least))
        limits += f" or <{at_least}"
    return Rule("outlier", column, hit, limits)


# The limits of the standing rules.
def power_rules(actual=(1500, 10000), capacity=(1500, 10000)) -> list[Rule]:
    return [
        null_rule("actual_power"),
        null_rule("supply_capacity"),
        range_rule("actual_power", *actual),
        range_rule("supply_capacity", *capacity, at_least="actual_power"),
    ]


def weather_rules(temperature=(-10, 50), humidity=(0, 100), precipitation=(0, 40)) -> list[Rule]:
    return [
        null_rule("temperature_2m"),
        null_rule("relative_humidity_2m"),
        range_rule("temperature_2m", *temperature),
        range_rule("relative_humidity_2m", *humidity),
        range_rule("precipitation", *precipitation),
    ]


def power_period(as_of: dt.date, days: int) -> tuple[dt.date, dt.date]:
    """The ``days`` days up to yesterday."""
    return as_of - dt.timedelta(days=days), as_of - dt.timedelta(days=1)


def weather_period(as_of: dt.date, days: int) -> tuple[dt.date, dt.date]:
    """The ``days`` days up to yesterday, today and the days forecast with it."""
    return as_of - dt.timedelta(days=days), as_of + dt.timedelta(days=FORECAST_DAYS - 1)


def quality_checks(
    df: DataFrame,
    data_type: str,
    rules: Sequence[Rule],
    period: tuple[dt.date, dt.date],
    as_of: dt.date,
    checked_at: dt.datetime | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """One finding per rule, plus one for hours that are not there, in ten columns.

    The rows of the period are read once and counted per rule. Repeated rows make the
    missing count negative, which is a warning. With ``by`` there is one set of findings
    per group that has any row in the period.
    """
    first, last = period
    expected = HOURS_PER_DAY * ((last - first).days + 1)
    counts = (
        df.where(F.col("date").between(first, last))
        .groupBy(*by)
        .agg(
            F.count("*").alias("__rows"),
            *[F.count_if(rule.hit).alias(f"__hits_{i}") for i, rule in enumerate(rules)],
        )
    )
    found = F.col("__rows")
    absent = F.lit(expected).cast("long") - found
    findings = [
        _finding("missing", ALL_ROWS, absent, F.format_string(MISSING_TEXT, F.lit(expected), found, absent))
    ]
    for i, rule in enumerate(rules):
        hits = F.col(f"__hits_{i}")
        if rule.check_type == "null":
            text = F.format_string(NULL_TEXT, F.lit(rule.target), hits)
        else:
            text = F.format_string(OUTLIER_TEXT, F.lit(rule.target), F.lit(rule.limits), hits)
        findings.append(_finding(rule.check_type, rule.target, hits, text))
    at = checked_at or dt.datetime.combine(as_of, dt.time())
    return counts.select(*by, F.inline(F.array(*findings))).select(
        *by,
        F.lit(as_of).alias("check_date"),
        moment(at).alias("check_timestamp"),
        F.lit(data_type).alias("data_type"),
        "check_type",
        "check_target",
        "issue_count",
        "issue_detail",
        F.lit(first).alias("check_period_start"),
        F.lit(last).alias("check_period_end"),
        "status",
    )


def _finding(check_type: str, target: str, count: Column, text: Column) -> Column:
    return F.struct(
        F.lit(check_type).alias("check_type"),
        F.lit(target).alias("check_target"),
        count.cast("long").alias("issue_count"),
        text.alias("issue_detail"),
        finding_grade(count, WARNING_BELOW[check_type]).alias("status"),
    )


def severity(status: Column) -> Column:
    """ERROR above WARNING above OK."""
    return F.create_map(*[F.lit(x) for pair in _SEVERITY.items() for x in pair])[status]


def overall_status(checks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Tally of findings and the worst status among them."""
    return (
        checks.groupBy(*by)
        .agg(
            F.count("*").alias("total_checks"),
            F.count_if(F.col("status") == "ERROR").alias("error_count"),
            F.count_if(F.col("status") == "WARNING").alias("warning_count"),
            F.count_if(F.col("status") == "OK").alias("ok_count"),
        )
        .withColumn(
            "overall_status",
            F.when(F.col("error_count") > 0, "ERROR").when(F.col("warning_count") > 0, "WARNING").otherwise("OK"),
        )
    )
