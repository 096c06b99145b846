"""Run-log details: JSON whose keys differ from process to process, read as VARIANT."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_details(log: DataFrame, text: str = "additional_info", name: str = "details") -> DataFrame:
    """The text as a VARIANT; NULL where it is no JSON."""
    return log.withColumn(name, F.try_parse_json(F.col(text)))


def typed_details(
    log: DataFrame, fields: Mapping[str, Mapping[str, tuple[str, str]]], process: str = "process_type", name: str = "details"
) -> DataFrame:
    """Add a column per field, from the details of the processes that have it.

    fields: new column -> process -> (path, type). A field that a process does not have, that is
    absent, or whose value is not of the type is NULL; a column has one type.
    """
    columns = {}
    for column, sources in fields.items():
        value = F.lit(None)
        for which, (path, kind) in sources.items():
            value = F.when(F.col(process) == which, F.try_variant_get(F.col(name), path, kind)).otherwise(value)
        columns[column] = value
    return log.withColumns(columns)


def shapes(log: DataFrame, process: str = "process_type", name: str = "details") -> DataFrame:
    """Per process: rows, rows without readable details, and the schema that fits all its details."""
    return log.groupBy(process).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(name).isNull()).alias("unreadable"),
        F.schema_of_variant_agg(F.col(name)).alias("shape"),
    )
