"""What the operators of this package share: reading, storing, words of a text."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.shared import map_batches, new_folder, send_library  # noqa: F401

#: Characters that separate words: space, and tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"

#: Rows and bytes of text turned into Python objects at a time, beside the Arrow batch. A
#: longer text is taken alone.
SLICE, SLICE_BYTES = 256, 2 << 20


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, computed once and written to the shared folder; later reads start from there."""
    return stored_at(df, label)[0]


#: Folders written inside of the innermost ``scratch``.
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def stored_at(df: DataFrame, label: str, codec: str | None = None) -> tuple[DataFrame, str]:
    """As ``stored``, with the folder, for a caller that discards it when its last reader is done."""
    spark = df.sparkSession
    path = new_folder(spark, f"llm-{label}")
    if (made := _SCRATCH.get()) is not None:
        made.append(path)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Folders that are stored inside are deleted at the end, but for those taken off the list."""
    made: list[str] = []
    token = _SCRATCH.set(made)
    try:
        yield made
    finally:
        _SCRATCH.reset(token)
        for path in made:
            discard(spark, path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are done: it does when the driver collects its garbage."""
    spark.sparkContext._jvm.System.gc()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``stored_at`` wrote and nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def words_of(text: Column) -> Column:
    """Words of a text, in order; none for an empty or null text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def remainder(doc_id: Column, n: int = 5) -> Column:
    """crc32 of an id written as text, modulo n; null ids count as the text 'null'."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % n


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of a batch, a bounded number at a time; nulls are empty texts."""
    texts = batch.column(column)
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        n = int(np.searchsorted(ends, before + SLICE_BYTES, side="right")) - at
        n = max(1, min(n, SLICE, batch.num_rows - at))
        yield at, [t or "" for t in texts.slice(at, n).to_pylist()]
        at += n
