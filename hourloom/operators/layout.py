"""How a table's rows lie in files: few files of a good size, and near values close together.

Both rewrite only the partitions concerned, under the table's note, so a call that stops
leaves the old files or is finished by the next one, and no reader is told of a change.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.operators.refresh import NO_DATE, DatedTable

#: Size of a file that reads well.
TARGET = 128 << 20
#: Steps of the ladder that each column's values are put on, as a power of two.
BITS = 6


def compact(table: DatedTable, target: int = TARGET) -> list[str]:
    """Put the small files of each partition together to files of about ``target`` bytes.

    Partitions that would not get fewer files are left alone. Returns those that were rewritten.
    """
    wanted = {}
    for label, sizes in table.file_sizes().items():
        files = max(1, math.ceil(sum(sizes) / target))
        if files < len(sizes):
            wanted[label] = files
    table.rewrite(wanted, lambda rows: _dealt(rows, table, wanted))
    return sorted(wanted)


def _dealt(rows: DataFrame, table: DatedTable, files: dict[str, int]) -> DataFrame:
    """The rows of a partition in as many tasks as it is to have files, or fewer."""
    label = F.coalesce(F.col(table.partition).cast("string"), F.lit(NO_DATE))
    # Few partitions have more than one file: one number each for these, one for all others.
    several = {x: n for x, n in files.items() if n > 1}
    count = F.lit(1)
    for x, n in several.items():
        count = F.when(label == x, n).otherwise(count)
    part = F.pmod(F.xxhash64(*[c for c in rows.columns if c != table.partition]), count)
    out = rows.withColumn("__part", part).repartition(sum(files.values()), table.partition, "__part")
    return out.sortWithinPartitions(table.partition, *table.cluster_by).drop("__part")


def z_value(steps: Sequence[Column], bits: int = BITS) -> Column:
    """Whole numbers below 2^bits as one number: their bits in turn, the first column's first."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for i, step in enumerate(steps):
            bit = F.shiftright(step.cast("long"), b).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(steps) + len(steps) - 1 - i))
    return out


def ladder(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[Column]:
    """Per column the step of a value among its quantiles, so that each step has about as many rows.

    Text goes by its first characters, which keeps its order; NULL is the first step. Runs one
    aggregate over the columns now.
    """
    numbers = [_as_number(df, c) for c in columns]
    shares = F.array(*[F.lit(i / 2**bits) for i in range(1, 2**bits)])
    edges = df.agg(*[F.percentile_approx(x, shares, F.lit(10_000)).alias(f"e{i}") for i, x in enumerate(numbers)]).first()
    steps = []
    for i, x in enumerate(numbers):
        cuts = sorted(set(edges[f"e{i}"] or []))
        # Spread over the whole ladder, so that few values use its upper steps as well.
        steps.append(F.when(x.isNull(), 0).otherwise(F.floor(_below(x, cuts) * 2**bits / (len(cuts) + 1))))
    return steps


def _below(x: Column, cuts: Sequence[float]) -> Column:
    """How many of the cuts are below a value."""
    found = F.array(*[F.lit(float(e)) for e in cuts]).cast("array<double>")
    return F.size(F.filter(found, lambda e: e < x))


def _as_number(df: DataFrame, name: str) -> Column:
    if dict(df.dtypes)[name] != "string":
        return F.col(name).cast("double")
    # Six bytes, which a double holds exactly.
    return F.conv(F.rpad(F.hex(F.substring(F.encode(F.col(name), "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")


def interleave(
    table: DatedTable, columns: Sequence[str], labels: Sequence[str] | None = None, files: int = 1, bits: int = BITS
) -> list[str]:
    """Order the rows of partitions by the interleaved steps of some columns.

    A filter on any of the columns then finds its rows in few row groups, as each covers a
    small part of every column's range. ``files`` are written per partition, each with a range
    of the order.
    """
    wanted = sorted(labels if labels is not None else set(table.file_sizes()))
    if not wanted:
        return []

    def arranged(rows: DataFrame) -> DataFrame:
        ordered = rows.withColumn("__z", z_value(ladder(rows, columns, bits), bits))
        spread = ordered.repartitionByRange(files * len(wanted), table.partition, "__z", *columns)
        return spread.sortWithinPartitions(table.partition, "__z", *columns).drop("__z")

    table.rewrite(wanted, arranged)
    return wanted
