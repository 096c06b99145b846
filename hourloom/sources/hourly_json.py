"""Hourly rows out of JSON documents that hold one array per variable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.sources.filenames import PREFECTURES, parse_file_name
from hourloom.sources.sectioned import unpack

# The variables of a document and their types.
VARIABLES = {
    "temperature_2m": "double",
    "relative_humidity_2m": "double",
    "precipitation": "double",
    "weather_code": "bigint",
}


def read_documents(spark: SparkSession, paths: str | list[str], pattern: str = "*.json") -> DataFrame:
    """``(path, text)``: a document per row."""
    return (
        spark.read.option("wholetext", "true")
        .option("pathGlobFilter", pattern)
        .text(paths)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )


def _schema(variables: dict[str, str]) -> str:
    # Values are read as text: a number that does not fit is then one value's fault.
    arrays = ", ".join(f"{name}: array<string>" for name in variables)
    return f"hourly struct<time: array<string>, {arrays}>, _bad string"


def _document(documents: DataFrame, variables: dict[str, str]) -> DataFrame:
    parsed = F.from_json("text", _schema(variables), {"columnNameOfCorruptRecord": "_bad"})
    carried = [c for c in documents.columns if c != "text"]
    return documents.select(*carried, parsed.alias("doc")).select(
        *carried,
        (F.col("doc").isNull() | F.col("doc._bad").isNotNull()).alias("bad"),
        F.col("doc.hourly").alias("hourly"),
    )


def _lengths(variables: Sequence[str]) -> dict[str, Column]:
    return {v: F.when(F.col(f"hourly.{v}").isNull(), 0).otherwise(F.size(f"hourly.{v}")) for v in variables}


def _number(text: Column, kind: str) -> Column:
    """A value as a number of its kind; whole numbers may be written with a point."""
    number = text.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast(kind)) if kind == "bigint" else number.cast(kind)


def _unreadable(variables: dict[str, str]) -> Column:
    """Names of the variables with a value that is not such a number; NULL if none."""

    def wrong(kind: str):
        return lambda x: x.isNotNull() & _number(x, kind).isNull()

    named = [F.when(F.exists(f"hourly.{v}", wrong(kind)), v) for v, kind in variables.items()]
    found = F.array_compact(F.array(*named))
    return F.when(F.size(found) > 0, F.concat_ws(", ", found))


def _mismatch(variables: Sequence[str], hours: Column) -> Column:
    """``name: length`` of every array that is not as long as ``time``; NULL if none."""
    named = F.array_compact(
        F.array(
            *[
                F.when(n != hours, F.concat(F.lit(f"{v}: "), n.cast("string")))
                for v, n in _lengths(variables).items()
            ]
        )
    )
    return F.when(F.size(named) > 0, F.concat_ws(", ", named))


def _hours() -> Column:
    time = F.col("hourly.time")
    return F.when(time.isNull(), 0).otherwise(F.size(time))


def extract_hourly(documents: DataFrame, variables: dict[str, str] = VARIABLES) -> DataFrame:
    """``reason`` and ``rows`` per document, in place of its text.

    Lengths are compared before the arrays are zipped, since zipping pads short arrays
    with NULL. The reason names the arrays that do not fit.
    """
    hours = _hours()
    mismatch = _mismatch(list(variables), hours)
    time_of = F.transform("hourly.time", lambda t: t.try_cast("timestamp_ntz"))
    reason = (
        F.when(F.col("bad"), "not valid JSON")
        .when(hours == 0, "no time values")
        .when(mismatch.isNotNull(), F.concat(F.lit("expected "), hours.cast("string"), F.lit(" values, got "), mismatch))
        .when(F.exists(time_of, lambda t: t.isNull()), "unreadable time")
        .when(_unreadable(variables).isNotNull(), F.concat(F.lit("unreadable value of "), _unreadable(variables)))
    )
    zipped = F.arrays_zip(
        time_of.alias("at"), *[F.col(f"hourly.{v}").alias(v) for v in variables]
    )
    rows = F.transform(
        zipped,
        lambda r: F.struct(
            r["at"].cast("date").alias("date"),
            F.date_format(r["at"], "HH").alias("hour"),
            *[_number(r[v], kind).alias(v) for v, kind in variables.items()],
        ),
    )
    carried = [c for c in documents.columns if c != "text"]
    return _document(documents, variables).select(*carried, reason.alias("reason"), rows.alias("rows"))


def with_key(rows: DataFrame, name: str, value: str | Column) -> DataFrame:
    """Add the key column the documents do not carry themselves, as first column."""
    key = value if isinstance(value, Column) else F.lit(value)
    return rows.select(key.alias(name), *[c for c in rows.columns if c != name])


def on_date(rows: DataFrame, date_filter=None) -> DataFrame:
    """Rows of one date, or all of them without a filter."""
    return rows if date_filter is None else rows.where(F.col("date") == F.lit(date_filter).cast("date"))


def convert_documents(
    documents: DataFrame, date_filter=None, prefectures: Sequence[str] = PREFECTURES, max_parts: int = 3
) -> DataFrame:
    """``(path, output, prefecture, reason, rows)``: documents named after their prefecture.

    ``output`` is what the converted file is called. Rows of other dates than
    ``date_filter`` are left out; a document left without rows is neither good nor bad.
    """
    named = parse_file_name(documents, "path", prefectures, max_parts)
    extracted = extract_hourly(named)
    rows = F.col("rows")
    if date_filter is not None:
        rows = F.filter(rows, lambda r: r["date"] == F.lit(date_filter).cast("date"))
    output = F.concat_ws("_", "prefecture", F.col("year").cast("string"), F.date_format("file_date", "MMdd"))
    return extracted.select(
        "path",
        F.when(F.col("name_error").isNull(), output).alias("output"),
        "prefecture",
        F.coalesce("name_error", "reason").alias("reason"),
        rows.alias("rows"),
    )


def converted_rows(converted: DataFrame) -> DataFrame:
    """Rows to be written, one file per ``output``."""
    return unpack(converted).drop("path")


def conversion_report(converted: DataFrame) -> DataFrame:
    """``(path, status, output, error)`` of documents that gave rows or failed."""
    failed = F.col("reason").isNotNull()
    line = F.struct(
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(~failed, F.col("output")).alias("output"),
        F.col("reason").alias("error"),
    )
    return converted.select("path", F.inline(F.when(failed | (F.size("rows") > 0), F.array(line))))


def validate_documents(documents: DataFrame, variables: dict[str, str] = VARIABLES) -> DataFrame:
    """``(path, valid, issues, total_hours)``; the first kind of problem found is reported.

    ``total_hours`` is NULL when the document is too broken to count them.
    """
    absent = F.array_compact(
        F.array(*[F.when(F.col(f"hourly.{v}").isNull(), v) for v in variables])
    )
    hours = _hours()
    issue = (
        F.when(F.col("bad"), "not valid JSON")
        .when(F.col("hourly").isNull(), "no hourly data")
        .when(F.size(absent) > 0, F.concat(F.lit("missing variables: "), F.concat_ws(", ", absent)))
        .when(F.col("hourly.time").isNull(), "no time data")
    )
    mismatch = _mismatch(list(variables), hours)
    checked = _document(documents, variables).select(
        "path",
        issue.alias("structure"),
        mismatch.alias("lengths"),
        hours.alias("hours"),
    )
    problem = F.coalesce(
        "structure",
        F.concat(F.lit("expected "), F.col("hours").cast("string"), F.lit(" values, got "), F.col("lengths")),
    )
    return checked.select(
        "path",
        problem.isNull().alias("valid"),
        problem.alias("issues"),
        F.when(F.col("structure").isNull(), F.col("hours")).cast("long").alias("total_hours"),
    )
