"""Hourly rows out of sectioned text files.

A file holds several tables one under the other. The hourly one starts after the line
that contains ``MARKER``: date, time, actual, two fields not used, capacity.
A file is one row from reading to unpacking, so nothing here shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Section header, file encoding, and the hours a section must hold.
MARKER = "DATE,TIME,当日実績(万kW)"
ENCODING = "Shift_JIS"
HOURS = 24

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


@contextmanager
def legacy_charsets(spark: SparkSession) -> Iterator[None]:
    """Spark 4 knows Shift_JIS only under this setting, which is read on analysis."""
    name = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_files(
    spark: SparkSession, paths: str | list[str], pattern: str = "*.csv", times: bool = False
) -> DataFrame:
    """``(path, content)`` per file, not yet decoded; with ``times`` also ``modified``."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(paths)
        .select("path", *([F.col("modificationTime").alias("modified")] if times else []), "content")
    )


def decode_files(files: DataFrame, encoding: str = ENCODING) -> DataFrame:
    """``(path, text)`` from ``(path, content)``; other columns are carried along."""
    with legacy_charsets(files.sparkSession):
        return files.select(*_without(files, "content"), F.decode("content", encoding).alias("text"))


def _without(df: DataFrame, column: str) -> list[str]:
    return [c for c in df.columns if c != column]


def _field(parts: Column, i: int) -> Column:
    return F.trim(F.get(parts, F.lit(i)))


def _number(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.cast("double"))


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _split_line(line: Column) -> Column:
    return F.struct((line == "").alias("blank"), F.split(line, ",", -1).alias("parts"))


def _parse_line(line: Column) -> Column:
    parts = line["parts"]
    day = _field(parts, 0)
    hour = F.split_part(_field(parts, 1), F.lit(":"), F.lit(1))
    enough = F.size(parts) >= 6
    return F.struct(
        line["blank"].alias("blank"),
        enough.alias("enough"),
        F.when(enough, day).alias("date_text"),
        F.when(day.rlike(r"^\d{4}/\d{1,2}/\d{1,2}$"), F.try_to_date(day, "y/M/d")).alias("date"),
        F.when(enough, F.trim(hour).try_cast("int")).alias("hour"),
        F.when(enough, _number(_field(parts, 2))).alias("actual_power"),
        F.when(enough, _number(_field(parts, 5))).alias("supply_capacity"),
    )


def _flaw(line: Column) -> Column:
    readable = (
        line["date"].isNotNull()
        & line["hour"].isNotNull()
        & line["actual_power"].isNotNull()
        & line["supply_capacity"].isNotNull()
    )
    return (
        F.when(line["blank"], "blank line")
        .when(~line["enough"], "too few fields")
        .when(~readable, "unreadable field")
    )


def _section(texts: DataFrame, marker: str, hours: int) -> DataFrame:
    carried, lines = _without(texts, "text"), F.split("text", "\n")
    at = F.array_position(F.transform(lines, lambda x: x.contains(marker)), True)
    return (
        texts.select(*carried, lines.alias("lines"), at.alias("at"))
        .select(*carried, "at", F.slice("lines", (F.col("at") + 1).cast("int"), hours).alias("block"))
        # One function per step, so that each value is worked out once per line.
        .select(*carried, "at", F.transform("block", _strip).alias("block"))
        .select(*carried, "at", F.transform("block", _split_line).alias("block"))
        .select(*carried, "at", F.transform("block", _parse_line).alias("parsed"))
    )


def extract_strict(texts: DataFrame, marker: str = MARKER, hours: int = HOURS) -> DataFrame:
    """``(path, reason, rows)`` per file; any flaw in the section empties the whole file.

    The reason is that of the first bad line.
    """
    parsed = F.col("parsed")
    flaws = F.array_compact(F.transform(parsed, _flaw))
    reason = (
        F.when(F.col("at") == 0, "no header line")
        .when(F.size(flaws) > 0, F.get(flaws, F.lit(0)))
        .when(F.size(parsed) < hours, "section too short")
        .when(F.get(parsed, F.lit(hours - 1))["hour"] != hours - 1, "last hour missing")
    )
    rows = F.transform(
        parsed,
        lambda r: F.struct(
            r["date"].alias("date"),
            r["hour"].alias("hour"),
            r["actual_power"].alias("actual_power"),
            r["supply_capacity"].alias("supply_capacity"),
        ),
    )
    return _section(texts, marker, hours).select(*_without(texts, "text"), reason.alias("reason"), rows.alias("rows"))


def extract_lenient(texts: DataFrame, marker: str = MARKER, hours: int = HOURS) -> DataFrame:
    """``(path, reason, rows)`` per file; unusable lines are left out, a missing header fails.

    Dates stay text: year as written, month and day padded. Hours become two digits.
    """
    reason = F.when(F.col("at") == 0, "no header line")

    def padded(x: Column) -> Column:
        return F.when(F.length(x) < 2, F.lpad(x, 2, "0")).otherwise(x)

    def day_text(r: Column) -> Column:
        bits = F.split(r["date_text"], "/", -1)
        return F.when(
            F.size(bits) == 3,
            F.concat_ws("-", F.get(bits, F.lit(0)), padded(F.get(bits, F.lit(1))), padded(F.get(bits, F.lit(2)))),
        ).otherwise(r["date_text"])

    usable = F.filter(
        "parsed",
        lambda r: r["enough"]
        & r["hour"].isNotNull()
        & r["actual_power"].isNotNull()
        & r["supply_capacity"].isNotNull(),
    )
    rows = F.transform(
        usable,
        lambda r: F.struct(
            day_text(r).alias("date"),
            padded(r["hour"].cast("string")).alias("hour"),
            r["actual_power"].alias("actual_power"),
            r["supply_capacity"].alias("supply_capacity"),
        ),
    )
    return _section(texts, marker, hours).select(*_without(texts, "text"), reason.alias("reason"), rows.alias("rows"))


def unpack(extracted: DataFrame, fail: bool = False) -> DataFrame:
    """The rows of all good files. With ``fail``, a bad file fails the query instead.

    Bad files are emptied inside the generator. As a filter the condition would be pushed
    below the extraction, and every file parsed again for each of its terms.
    """
    rows = F.when(F.col("reason").isNull(), F.col("rows"))
    if fail:
        rows = rows.otherwise(F.raise_error(F.concat("path", F.lit(": "), "reason")))
    carried = [c for c in extracted.columns if c not in ("reason", "rows")]
    return extracted.select(*carried, F.inline(rows))


def outcome_per_file(extracted: DataFrame) -> DataFrame:
    """``(path, status, error, row_count)``: one bad file does not stop the others."""
    good = F.col("reason").isNull()
    return extracted.select(
        "path",
        F.when(good, "success").otherwise("failed").alias("status"),
        F.col("reason").alias("error"),
        F.when(good, F.size("rows")).otherwise(0).cast("long").alias("row_count"),
    )


def read_sectioned(
    spark: SparkSession, paths: str | list[str], strict: bool = True, pattern: str = "*.csv"
) -> DataFrame:
    texts = decode_files(read_files(spark, paths, pattern))
    return extract_strict(texts) if strict else extract_lenient(texts)
