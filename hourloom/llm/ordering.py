"""Places of rows in a sorted order, found without a task that holds all rows or a whole group.

Rows are dealt to partitions by range, sorted there and stored with their partition and the
place inside it. What came before a partition is then a sum over one row per partition (and
group), which is all that is ever ordered in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.common import stored
from hourloom.operators.joins import small_side

_IN_PARTITION = (1 << 33) - 1


def in_order(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """The rows stored in the order of some columns, with ``__part`` and ``__at`` inside the part."""
    n = F.monotonically_increasing_id()
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(
        rows.withColumns({"__part": F.shiftright(n, 33), "__at": n.bitwiseAND(F.lit(_IN_PARTITION))}), label
    )


def numbered(df: DataFrame, order: Sequence[str], place: str, label: str) -> DataFrame:
    """Rows with their place, from 0, in the order of all rows."""
    rows = in_order(df, order, label)
    counts = rows.groupBy("__part").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    before = counts.select("__part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    found = rows.join(small_side(before), "__part")
    return found.withColumn(place, F.col("__before") + F.col("__at")).drop("__part", "__at", "__before")


def numbered_within(
    df: DataFrame, group: str, order: Sequence[str], place: str, total: str, label: str
) -> DataFrame:
    """Rows with their place, from 0, among the rows of their group, and the group's size.

    A group's rows lie in consecutive partitions; it is known by its runs, one row per
    partition. ``group`` must not be null.
    """
    rows = in_order(df, [group, *order], label)
    runs = rows.groupBy("__part", group).agg(F.min("__at").alias("__first"), F.count("*").alias("n"))
    of_group = Window.partitionBy(group)
    earlier = of_group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "__part",
        group,
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("n").over(of_group).alias(total),
    )
    found = rows.join(small_side(runs), ["__part", group])
    return found.withColumn(place, F.col("__shift") + F.col("__at")).drop("__part", "__at", "__shift")
