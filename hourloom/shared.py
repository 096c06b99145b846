"""Where tables that cut lineage, or that a later step reads back, are written; Python in tasks.

The cluster names a folder every executor can reach in ``spark.checkpoint.dir``.
Only a local-mode session without that setting (a test) gets a folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_CHECKPOINT_KEY = "spark.checkpoint.dir"

# Folders of local-mode applications that name none, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder all executors can reach")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="hourloom-")
    return _LOCAL_ROOTS[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_root(spark).rstrip('/')}/hourloom/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, computed once into the shared folder; a lost executor loses nothing."""
    return written_at(df, label)[0]


def written_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As ``written``, with the folder, for a caller that discards it when its last reader is done."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``written_at`` wrote and nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


# Applications whose executors have been sent the library.
_SENT: set[str] = set()


def send_library(spark: SparkSession) -> None:
    """Send the library's modules to the executors, whose Python may not find them otherwise."""
    context, top = spark.sparkContext, os.path.dirname(os.path.abspath(__file__))
    if context.applicationId in _SENT or not os.path.isdir(top):
        return
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="hourloom-code-")), "hourloom-code.zip")
    with zipfile.ZipFile(path, "w") as code:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                code.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)  # the driver serves it; executors fetch it
    _SENT.add(context.applicationId)


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """mapInArrow, with the library at hand on the executors."""
    send_library(df.sparkSession)
    return df.mapInArrow(function, schema)
