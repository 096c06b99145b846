"""Vectors as codes of their parts, with codebooks learnt by active-entry Lloyd rounds.

A vector is cut into equal parts, and each part position has a codebook of a few entries,
so a vector becomes one entry index per part. All numbers are integers, so every result is
exact and does not depend on how rows are dealt to tasks.

A round assigns every part to its nearest entry, ties to the lower index, and replaces the
entries by the means of their parts. Each part keeps its entry and the exact distance to it.
In the next round a part whose entry stayed fixed needs only the entries that moved: the
others are as far as before, and lost before. A part whose entry moved compares all entries.

The state of a round is a table beside the vectors, written by the pass that also adds up the
parts of each entry: one more row per task holds these sums, so a round reads and writes the
vectors once and shuffles only sums. The driver sees codebooks, never rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.llm.common import discard, map_batches, stored_at
from hourloom.operators.joins import is_small

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Integer components stay below this, so that sums of squares fit 64 bits.
LIMIT = 1 << 27
#: Components of the vectors compared at a time.
BLOCK = 1 << 19
#: A label's total is found by this many salted keys where labels are too many to broadcast.
SALTS = 32


class Codes(NamedTuple):
    """rows: the id and carried columns, ``entries`` (one index per part), ``error`` (squared
    distance over all parts). codebooks: integers by part, entry, position within the part."""

    rows: DataFrame
    codebooks: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & fine


def nearest(
    x: np.ndarray, book: np.ndarray, moved: np.ndarray | None, entry: np.ndarray, distance: np.ndarray
) -> None:
    """Assign one part (rows x width) to the entries of its book, in place.

    moved: flags of entries that moved since ``entry`` and ``distance`` were found; None if
    nothing was found yet.
    """
    again = np.ones(len(x), bool) if moved is None else moved[entry]
    if again.any():
        d = ((x[again, None, :] - book[None]) ** 2).sum(2)
        entry[again] = d.argmin(1)  # the lowest index among equals
        distance[again] = d.min(1)
    if moved is None or not moved.any() or again.all():
        return
    rest, active = ~again, np.flatnonzero(moved)
    d = ((x[rest, None, :] - book[None, active]) ** 2).sum(2)
    best, least = active[d.argmin(1)], d.min(1)
    a, b = entry[rest], distance[rest]
    better = (least < b) | ((least == b) & (best < a))
    entry[rest], distance[rest] = np.where(better, best, a), np.where(better, least, b)


def _assign(books: np.ndarray, moved: np.ndarray | None):
    """One pass: rows with their new entries and distances, then a row of sums per task."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), np.int64)
        kinds = None
        for whole in batches:
            step = max(1, BLOCK // (parts * width))
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                n, kinds = batch.num_rows, [batch.schema.field(c).type for c in ("id", "carried")]
                x = batch.column("vector").flatten().to_numpy().reshape(n, parts, width).astype(np.int64)
                if moved is None:
                    entry, distance = np.zeros((n, parts), np.int32), np.zeros((n, parts), np.int64)
                else:
                    entry = batch.column("entries").flatten().to_numpy().reshape(n, parts).copy()
                    distance = batch.column("distances").flatten().to_numpy().reshape(n, parts).copy()
                for p in range(parts):
                    e, d = entry[:, p].copy(), distance[:, p].copy()
                    nearest(x[:, p], books[p], None if moved is None else moved[p], e, d)
                    entry[:, p], distance[:, p] = e, d
                    np.add.at(sums[p, :, :width], e, x[:, p])
                    sums[p, :, width] += np.bincount(e, minlength=entries)
                ends = np.arange(0, n * parts + 1, parts, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        batch.column("carried"),
                        batch.column("vector"),
                        pa.ListArray.from_arrays(ends, pa.array(entry.ravel(), pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(distance.ravel(), pa.int64())),
                        pa.nulls(n, pa.list_(pa.int64())),
                    ],
                    names=["id", "carried", "vector", "entries", "distances", "sums"],
                )
        if kinds is not None:
            nothing = [pa.nulls(1, k) for k in (*kinds, *map(pa.list_, (pa.int32(), pa.int32(), pa.int64())))]
            yield pa.RecordBatch.from_arrays(
                [*nothing, pa.array([sums.ravel().tolist()], pa.list_(pa.int64()))],
                names=["id", "carried", "vector", "entries", "distances", "sums"],
            )

    return run


def _means(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Entries replaced by the rounded-down means of their parts; unused ones stay."""
    parts, entries, width = books.shape
    each = state.where("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "value"))
    # A number per part, entry and position, whatever the rows are.
    found = each.groupBy("at").agg(F.sum("value").alias("value")).collect()
    sums = np.zeros(parts * entries * (width + 1), np.int64)
    sums[[r["at"] for r in found]] = [r["value"] for r in found]
    sums = sums.reshape(parts, entries, width + 1)
    count = sums[:, :, width:]
    return np.where(count > 0, sums[:, :, :width] // np.maximum(count, 1), books)


def vector_codes(
    df: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    carry: Sequence[str] = (),
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codes:
    """Codes of all usable vectors. Runs the rounds now.

    A component x counts as floor(scale * x). A codebook starts as that part of the ``entries``
    smallest ids (fewer rows: fewer entries); nulls come last, equal ids by their vectors.
    Left out: vectors that are null, or hold null or non-finite components; also those
    whose length is no multiple of ``parts`` or differs from that of the smallest id. A
    component whose integer is 2^27 or more fails the query, as squares would not fit. Repeated rows
    count each time; a row without an id is encoded like others. An empty table gives no rows.
    """
    x = F.col("vector")
    big = F.exists(x, lambda v: F.abs(v) >= LIMIT / scale)
    complaint = F.raise_error(F.lit(f"components of {LIMIT // scale} or more do not fit"))
    carried = F.struct(*[F.col(c) for c in carry]) if carry else F.struct(F.lit(0).alias("none"))
    whole = (
        df.select(F.col(id).alias("id"), carried.alias("carried"), F.col(vector).alias("vector"))
        .where(usable(x) & (F.size(x) > 0) & (F.size(x) % parts == 0))
        .select(
            "id",
            "carried",
            F.when(big, complaint.cast("array<int>"))
            .otherwise(F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("int")))
            .alias("vector"),
        )
    )
    place = [F.col("id").asc_nulls_last(), F.col("vector")]
    first = whole.orderBy(*place).select("vector").limit(entries).collect()
    size = len(first[0]["vector"]) if first else parts
    whole = whole.where(F.size("vector") == size)
    if any(len(r["vector"]) != size for r in first):
        first = whole.orderBy(*place).select("vector").limit(entries).collect()
    seeds = np.array([r["vector"] for r in first], np.int64).reshape(len(first), parts, size // parts)
    books, moved = np.ascontiguousarray(seeds.transpose(1, 0, 2)), None
    schema = T.StructType(
        [
            *[T.StructField(f.name, f.dataType) for f in whole.schema.fields],  # all null in a row of sums
            T.StructField("entries", T.ArrayType(T.IntegerType())),
            T.StructField("distances", T.ArrayType(T.LongType())),
            T.StructField("sums", T.ArrayType(T.LongType())),
        ]
    )
    state, old = whole, None
    for turn in range(rounds + 1):
        state, path = stored_at(map_batches(state, _assign(books, moved), schema), "codes")
        if old is not None:
            discard(df.sparkSession, old)
        if turn < rounds:
            new = _means(state, books)
            moved = (new != books).any(2)
            books = new
            if not moved.any():  # then no later round changes anything
                break
        state, old = state.where("sums IS NULL").drop("sums"), path
    rows = state.where("entries IS NOT NULL").select(
        F.col("id").alias(id),
        *[F.col("carried")[c].alias(c) for c in carry],
        "entries",
        F.aggregate("distances", F.lit(0).cast("long"), lambda a, d: a + d).alias("error"),
    )
    return Codes(rows, books)


def hex_code(entries: Column) -> Column:
    """Two hex digits for each index, in part order."""
    return F.concat_ws("", F.transform(entries, lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))))


def with_total(rows: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """Rows with the sum of a value over equal ``by``, nulls being equal.

    Few totals are broadcast, after a count; more are joined on salted keys, so rows of a hot
    key are dealt to many tasks.
    """
    totals = rows.groupBy(F.col(by).alias("__by")).agg(F.sum(value).alias(name))
    if is_small(totals):
        return rows.join(F.broadcast(totals), F.col(by).eqNullSafe(F.col("__by"))).drop("__by")
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    copies = totals.withColumn("__of", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    same = F.col(by).eqNullSafe(F.col("__by")) & (F.col("__salt") == F.col("__of"))
    return salted.join(copies, same).drop("__by", "__of", "__salt")
