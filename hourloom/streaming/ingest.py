"""Files that arrive in a folder are loaded once for each time they are delivered.

A record table keeps path, modification time and outcome of every file that was read. A
run reads the files whose path and time it does not hold, all together; a file delivered
again with another time is read again. A bad file is recorded, left where it is, and never
in the way of others. The record is written after the table, and loading the same files
twice gives the same table, so a run cut short is simply repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.functions.times import moment
from hourloom.operators.dependencies import stretches
from hourloom.operators.refresh import DatedTable
from hourloom.shared import written
from hourloom.sources import hourly_json, sectioned

_RECORD = "path string, modified timestamp, status string, error string, row_count bigint"


class Loaded(NamedTuple):
    """Files of a run that gave rows, and files that failed."""

    good: int
    bad: int


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def read_record(spark: SparkSession, record: str) -> DataFrame:
    """``(path, modified, status, error, row_count)`` of all files read so far."""
    files, at = _file_system(spark, record)
    return spark.read.schema(_RECORD).parquet(record) if files.exists(at) else spark.createDataFrame([], _RECORD)


def new_files(spark: SparkSession, folder: str, record: str, pattern: str) -> DataFrame:
    """``(path, modified)`` of files delivered since; only names and times are read."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    found = listing.load(folder).select("path", F.col("modificationTime").alias("modified"))
    return found.join(read_record(spark, record).select("path", "modified"), ["path", "modified"], "left_anti")


def _load(
    spark: SparkSession,
    fresh: DataFrame,
    extracted: DataFrame,
    record: str,
    put: Callable[[DataFrame], None],
    archive: str | None,
    delete: bool,
) -> Loaded:
    """Unpack the files, hand all rows to ``put``, then record every file's outcome."""
    if fresh.isEmpty():
        return Loaded(0, 0)
    extracted = written(extracted, "extracted")
    outcome = sectioned.outcome_per_file(extracted).join(extracted.select("path", "modified"), "path")
    outcome = written(outcome.select("path", "modified", "status", "error", "row_count"), "outcome")
    counts = outcome.agg(F.count_if(F.col("status") == "success").alias("good"), F.count(F.lit(1)).alias("all")).first()
    if counts["good"]:
        put(extracted)
    if counts["all"]:
        outcome.write.mode("append").parquet(record)
    if archive or delete:
        # Names of this run's good files; a bad one stays for whoever mends it.
        for row in outcome.where("status = 'success'").select("path").toLocalIterator():
            files, at = _file_system(spark, row["path"])
            if archive:
                _, to = _file_system(spark, archive)
                files.mkdirs(to)
                files.rename(at, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to, at.getName()))
            else:
                files.delete(at, False)
    return Loaded(counts["good"], counts["all"] - counts["good"])


def _stamped(rows: DataFrame, loaded_at: dt.datetime | None) -> DataFrame:
    return rows if loaded_at is None else rows.withColumn("created_at", moment(loaded_at))


def ingest_sectioned(
    spark: SparkSession,
    folder: str,
    table: DatedTable,
    record: str,
    loaded_at: dt.datetime | None = None,
    delete: bool = False,
    pattern: str = "*.csv",
) -> Loaded:
    """Load new sectioned files, replacing the dates they span together.

    Of files with the same date the newest one's rows are taken. Rows get ``loaded_at`` as
    ``created_at`` if it is given, as the marts want it.
    """
    fresh = new_files(spark, folder, record, pattern)
    contents = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    files = contents.load(folder).select("path", F.col("modificationTime").alias("modified"), "content")
    files = files.join(fresh, ["path", "modified"], "left_semi")
    extracted = sectioned.extract_strict(sectioned.decode_files(files.select("path", "content")))
    extracted = extracted.join(fresh, "path")

    def put(good: DataFrame) -> None:
        rows = _of_newest(sectioned.unpack(good), F.col("date"))
        table.replace_loaded_range(_stamped(rows, loaded_at))

    return _load(spark, fresh, extracted, record, put, None, delete)


def ingest_documents(
    spark: SparkSession,
    folder: str,
    table: DatedTable,
    record: str,
    key: tuple[str, str],
    loaded_at: dt.datetime | None = None,
    archive: str | None = None,
    pattern: str = "*.json",
) -> Loaded:
    """Load new weather documents for one key value, archiving the good ones if a folder is given.

    A document replaces the dates it spans, also those of older documents of the run. Rows
    get ``loaded_at`` as ``created_at`` if it is given.
    """
    fresh = new_files(spark, folder, record, pattern)
    reader = spark.read.option("wholetext", "true").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    documents = reader.text(folder).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    extracted = hourly_json.extract_hourly(documents.join(fresh, "path"))

    def put(good: DataFrame) -> None:
        rows = sectioned.unpack(good)
        spans = rows.groupBy("path", "modified").agg(F.min("date").alias("first"), F.max("date").alias("last"))
        days = spans.select("path", "modified", F.explode(F.sequence("first", "last")).alias("date"))
        newest = days.groupBy("date").agg(F.max(F.struct("modified", "path")).alias("by"))
        rows = rows.join(newest, "date").where("path = by.path AND modified = by.modified").drop("by")
        rows = written(hourly_json.with_key(rows.drop("path", "modified"), *key), "documents")
        # One date per day that documents span; each stretch of days is one replacement.
        for first, last in stretches([r["date"] for r in newest.select("date").orderBy("date").collect()]):
            stretch = rows.where(F.col("date").between(first, last))
            table.replace_window(_stamped(stretch, loaded_at), first, last, key)

    return _load(spark, fresh, extracted, record, put, archive, False)


def _of_newest(rows: DataFrame, day: Column) -> DataFrame:
    """Rows of the newest file of each day, without the columns that say so."""
    newest = rows.groupBy(day.alias("__day")).agg(F.max(F.struct("modified", "path")).alias("__by"))
    kept = rows.join(newest, day == F.col("__day")).where("path = __by.path AND modified = __by.modified")
    return kept.drop("__day", "__by", "path", "modified")
