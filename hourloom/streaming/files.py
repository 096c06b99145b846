"""Sectioned files as they arrive: as a stream, or month folder by month folder.

The stream remembers in its checkpoint which files it has read, so a run reads new files only. A
micro-batch writes the outcome of its files under its own number and replaces exactly the
dates (of the keys) its good files hold. Doing a batch twice gives the same table and the same
record, so a run that stops between the table and the checkpoint is simply run again. Files that
have been read can be moved out of the folder by the stream itself, which keeps listings short.

A stream knows a file by its path: a file delivered again comes under another path, such as
a folder per delivery. Of files for the same date the one modified last counts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hourloom.functions.times import moment
from hourloom.operators.refresh import DatedTable
from hourloom.shared import written
from hourloom.sources import sectioned
from hourloom.sources.discovery import read_recent_files
from hourloom.streaming.ingest import Loaded

# Fixed value: the columns of Spark's binary files, which a stream wants to be told.
_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def _extracted(files: DataFrame, keys: Mapping[str, Column], encoding: str) -> DataFrame:
    """One row per file, from ``(path, modified, content)``, computed once. Keys come from the path."""
    named = files.withColumns(dict(keys)) if keys else files
    return written(sectioned.extract_strict(sectioned.decode_files(named, encoding)), "extracted")


def newest_rows(extracted: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Rows of the file modified last among those of the same date (and keys)."""
    grain = [*keys, "date"]
    rows = sectioned.unpack(extracted)
    newest = rows.groupBy(*grain).agg(F.max(F.struct("modified", "path")).alias("__by"))
    kept = rows.join(newest, grain).where("path = __by.path AND modified = __by.modified")
    return kept.drop("__by", "path", "modified")


def _outcomes(extracted: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    good = F.col("reason").isNull()
    return extracted.select(
        "path",
        "modified",
        *keys,
        F.when(good, "success").otherwise("failed").alias("status"),
        F.col("reason").alias("error"),
        F.when(good, F.size("rows")).otherwise(0).cast("long").alias("row_count"),
    )


def _put(table: DatedTable, extracted: DataFrame, keys: Mapping[str, Column], loaded_at: dt.datetime | None) -> None:
    rows = newest_rows(extracted, keys)
    table.replace_groups(rows if loaded_at is None else rows.withColumn("created_at", moment(loaded_at)), list(keys))


def stream_files(
    spark: SparkSession,
    inbox: str,
    table: DatedTable,
    record: str,
    checkpoint: str,
    keys: Mapping[str, Column] | None = None,
    loaded_at: dt.datetime | None = None,
    pattern: str = "*.csv",
    encoding: str = sectioned.ENCODING,
    files_at_once: int = 10_000,
    archive: str | None = None,
) -> StreamingQuery:
    """Load all files that are there and new, some thousands at a time; ends by itself.

    keys: columns that tell series apart, as expressions over ``path``. ``record`` gets the outcome
    of each file, in a folder per batch. With ``archive`` files that were read are moved there.
    """
    keys = keys or {}
    source = (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_at_once)
    )
    if archive:
        source = source.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    files = source.load(inbox).select("path", F.col("modificationTime").alias("modified"), "content")

    def batch(fresh: DataFrame, number: int) -> None:
        extracted = _extracted(fresh, keys, encoding)
        _outcomes(extracted, keys).write.mode("overwrite").parquet(f"{record}/batch={number}")
        _put(table, extracted, keys, loaded_at)

    return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def load_recent_months(
    spark: SparkSession,
    root: str,
    as_of: dt.date,
    days: int,
    table: DatedTable,
    record: str,
    keys: Mapping[str, Column] | None = None,
    loaded_at: dt.datetime | None = None,
    pattern: str = "*_power_usage.csv",
    encoding: str = sectioned.ENCODING,
) -> Loaded:
    """Load all files of the months that the last ``days`` days touch; other months are not listed.

    Each good file replaces its date (of its keys); bad files are recorded and in nobody's way.
    Fails if there is no good file at all.
    """
    keys = keys or {}
    extracted = _extracted(read_recent_files(spark, root, as_of, days, pattern, times=True), keys, encoding)
    outcomes = _outcomes(extracted, keys)
    counts = outcomes.agg(F.count_if(F.col("status") == "success").alias("good"), F.count("*").alias("all")).first()
    outcomes.write.mode("overwrite").parquet(record)
    if not counts["good"]:
        raise ValueError(f"none of {counts['all']} files in {root} could be read")
    _put(table, extracted, keys, loaded_at)
    return Loaded(counts["good"], counts["all"] - counts["good"])
