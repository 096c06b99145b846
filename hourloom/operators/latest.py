"""Latest version per key, and the latest row of all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str = "created_at",
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the greatest ``order_by``, NULL counting as oldest.

    Ties fall to ``tie_breakers`` (by default every other column), greatest first,
    so the answer does not depend on how the input was partitioned. Spark cuts each
    map task's output to one row per key before the shuffle (window group limit), so
    a key holding a large share of the rows does not land whole in one task.
    """
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in keys and c != order_by]
    order = [F.desc_nulls_last(c) for c in [order_by, *tie_breakers]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def latest_row(df: DataFrame, *order: Column) -> DataFrame:
    """The first row under ``order``: a top-1 per task, then one merge of those."""
    return df.orderBy(*order).limit(1)
