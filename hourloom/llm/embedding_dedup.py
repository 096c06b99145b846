"""Near copies among vectors by sorted projection passes.

In a pass every vector gets the signs of its projections on random directions, and the rows are
sorted by these signs, read as one long number. Vectors at a small angle agree on long
prefixes, so they come to lie close to each other, and each is compared with the next ``WINDOW``
rows or more. The pairs that pass the exact test are united over passes with other
directions. How many passes are needed follows from the number of rows: a pair right at the
threshold must be missed with a chance of at most ``MISSED``; closer pairs are found more often.

The order of rows is cut into blocks of equal size with the window of the next block at
their end, so a hot direction or a thousand copies never make a task larger. A block gives a spanning
forest of its links, at most one row per vector.

The windows bound what a pass compares, so links inside of a component are then counted in
full. Components of up to ``CROWD`` vectors are compared whole. In a larger one, the vectors within half
the angle around its centre all link with each other, by the triangle inequality, and
are counted without a comparison; only the others are compared with all, in pairs of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.llm.common import map_batches, stored
from hourloom.llm.graph import components
from hourloom.llm.ordering import numbered
from hourloom.llm.vector_codes import usable
from hourloom.operators.joins import small_side

COSINE = 0.95
#: Rows a vector is compared with, at least, in each pass; rows of a block.
WINDOW, BLOCK = 128, 1024
#: Signs a row is sorted by, and the chance to miss a pair right at the threshold.
BITS, MISSED = 63, 0.01
#: Passes that are sorted together.
AT_ONCE = 4
#: Vectors of a component that are compared whole, and rows of a block of a larger one.
CROWD, CROWD_BLOCK = 256, 1024
#: Centres broadcast at most; a centre is as long as a vector.
CENTRES = 10_000
SEED = 20_240_131
#: Far above the rounding of a dot product, far below any difference that matters.
MARGIN = 1e-9


def passes_for(rows: int, cosine: float = COSINE, window: int = WINDOW, missed: float = MISSED) -> int:
    """Passes after which a pair at the threshold was missed with a chance of at most ``missed``.

    Two vectors share a window if they agree on the signs that tell ``rows / window`` windows apart.
    """
    agree = 1 - math.acos(cosine) / math.pi
    share = agree ** max(0.0, math.log2(max(rows, 1) / window))
    return 1 if share >= 1 else math.ceil(math.log(missed) / math.log1p(-share))


def unit_vectors(vectors: pa.Array) -> np.ndarray:
    """Rows of length one, in double precision; the lists have one length."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of any finite number then stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _signs(first: int, last: int, size: int):
    """Per vector a row for each pass, with its signs as a number that sorts like them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        planes = {t: np.random.default_rng([SEED, t]).standard_normal((size, BITS)) for t in range(first, last)}
        for batch in batches:
            step = max(1, (1 << 20) // max(size, BITS))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = unit_vectors(part.column("vector"))
                for t, plane in planes.items():
                    signs = ((x @ plane) > 0) @ powers
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), t, np.int32)), pa.array(signs, pa.int64()), part.column("id"), part.column("vector")],
                        names=["pass", "signs", "id", "vector"],
                    )

    return run


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of each key of a stream that is sorted by the key; a key's rows fit in memory."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and held[0].column(key)[0].as_py() != keys[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _forest(x: np.ndarray, ids: np.ndarray, pass_: np.ndarray, cosine: float, window: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among rows, each compared with the next ``window`` or more."""
    tree, links = np.arange(len(x)), []
    for s in range(0, len(x), window):
        near = np.triu(x[s : s + window] @ x[s : s + 2 * window].T >= cosine, 1)
        for i in np.flatnonzero(near.any(axis=1)):
            a = s + i
            others = s + np.flatnonzero(near[i])
            others = others[(tree[others] != tree[a]) & (pass_[others] == pass_[a]) & (ids[others] != ids[a])]
            if len(others):
                trees, first = np.unique(tree[others], return_index=True)
                links += [(ids[a], ids[b]) for b in others[first]]
                tree[np.isin(tree, trees)] = tree[a]
    return links


def _windows(cosine: float, window: int):
    """Links among the rows of each block, as a spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _groups(batches, "block"):
            block = block.take(np.argsort(block.column("place").to_numpy()))
            x = unit_vectors(block.column("vector").combine_chunks())
            links = _forest(x, block.column("id").to_numpy(), block.column("pass").to_numpy(), cosine, window)
            if links:
                a, b = np.array(links).T
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _found(rows: DataFrame, size: int, cosine: float, window: int, passes: int) -> DataFrame:
    """``(a, b)``: verified links that connect what the windows of all passes connect."""
    links = None
    kind = rows.schema["vector"].dataType
    schema = T.StructType(
        [
            T.StructField("pass", T.IntegerType()),
            T.StructField("signs", T.LongType()),
            T.StructField("id", T.LongType()),
            T.StructField("vector", kind),
        ]
    )
    for first in range(0, passes, AT_ONCE):
        signed = map_batches(rows, _signs(first, min(passes, first + AT_ONCE), size), schema)
        placed = numbered(signed, ["pass", "signs", "id"], "place", "signs")
        own = F.floor(F.col("place") / BLOCK)
        # The first rows of a block are also the end of the block before.
        blocks = F.when((F.col("place") % BLOCK < 2 * window) & (own > 0), F.array(own - 1, own)).otherwise(F.array(own))
        dealt = placed.withColumn("block", F.explode(blocks)).repartition("block").sortWithinPartitions("block")
        more = stored(map_batches(dealt, _windows(cosine, window), "a bigint, b bigint"), "window-links")
        links = more if links is None else links.unionByName(more)
    return links


def _counts(cosine: float):
    """Links of each row of whole components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "component"):
            x = unit_vectors(group.column("vector").combine_chunks())
            n = (x @ x.T >= cosine).sum(axis=1) - 1
            yield pa.RecordBatch.from_arrays(
                [group.column("row").combine_chunks(), pa.array(n, pa.int64())], names=["row", "n"]
            )

    return run


def _sums(size: int):
    """Per task and component of its rows, the sum of the unit vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["component", "sum"]
        for batch in batches:
            keys, first = np.unique(batch.column("component").to_numpy(), return_inverse=True)
            sums = np.zeros((len(keys), size))
            np.add.at(sums, first, unit_vectors(batch.column("vector")))
            ends = np.arange(0, sums.size + 1, size, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(sums.ravel()))], names=names
            )

    return run


def _cores(cosine: float):
    """Whether a row lies within half the angle around its component's centre."""
    half = math.sqrt((1 + cosine) / 2) + MARGIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, c = unit_vectors(batch.column("vector")), unit_vectors(batch.column("centre"))
            core = pa.array((x * c).sum(axis=1) >= half)
            columns = [batch.column(n) for n in ("component", "row", "vector")]
            yield pa.RecordBatch.from_arrays([*columns, core], names=["component", "row", "vector", "core"])

    return run


def _block_counts(cosine: float):
    """Links between the outer rows and the others of two blocks, for both sides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pair in _groups(batches, "pair"):
            x, rows = unit_vectors(pair.column("vector").combine_chunks()), pair.column("row").to_numpy()
            left, core = pair.column("left").to_numpy(), pair.column("core").to_numpy()
            a, b = np.flatnonzero(left), np.flatnonzero(~left)
            if not len(a) or not len(b):
                continue
            near = (x[a] @ x[b].T >= cosine) & (rows[a][:, None] != rows[b][None])
            # A core row is told of its outer partners here; an outer one asks for itself.
            found = np.concatenate([near.sum(axis=1), near[:, core[b]].sum(axis=0)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([rows[a], rows[b][core[b]]])), pa.array(found, pa.int64())], names=["row", "n"]
            )

    return run


def _crowded(members: DataFrame, size: int, cosine: float) -> DataFrame:
    """``(row, n)`` for members of components too large to be compared whole; partial counts."""
    partial = map_batches(members, _sums(size), "component bigint, sum array<double>")
    each = partial.select("component", F.posexplode("sum").alias("at", "x")).groupBy("component", "at").agg(F.sum("x").alias("x"))
    # One number per component and dimension.
    centres = each.groupBy("component").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("all"))
    centres = centres.select("component", F.transform("all", lambda p: p["x"]).alias("centre"))
    # Opposite vectors could cancel out; then there is no centre and no core.
    centres = stored(centres.where(F.exists("centre", lambda v: v != 0)), "centres")
    near = members.join(small_side(centres, CENTRES), "component")
    kind = members.schema["vector"].dataType
    schema = T.StructType(
        [
            T.StructField("component", T.LongType()),
            T.StructField("row", T.LongType()),
            T.StructField("vector", kind),
            T.StructField("core", T.BooleanType()),
        ]
    )
    placed = map_batches(near.select("component", "row", "vector", "centre"), _cores(cosine), schema)
    loose = members.join(centres.select("component"), "component", "left_anti").select("component", "row", "vector")
    placed = stored(placed.unionByName(loose.withColumn("core", F.lit(False))), "crowded")
    sizes = placed.groupBy("component").agg(
        F.count_if("core").alias("cores"), F.count_if(~F.col("core")).alias("outers"), F.count("*").alias("all")
    )
    placed = placed.join(small_side(stored(sizes, "crowded-sizes")), "component")
    inner = placed.where("core").select("row", (F.col("cores") - 1).alias("n"))
    blocks, outer_blocks = (F.ceil(F.col(c) / CROWD_BLOCK).cast("int") for c in ("all", "outers"))
    spread = F.xxhash64("row")
    columns = ["component", "row", "vector", "core"]
    key = F.xxhash64("component", "i", "j")
    left = placed.where("NOT core").select(
        *columns, F.pmod(spread, outer_blocks).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("j")
    )
    right = placed.where("outers > 0").select(
        *columns, F.explode(F.sequence(F.lit(0), outer_blocks - 1)).alias("i"), F.pmod(spread, blocks).cast("int").alias("j")
    )
    met = left.withColumn("left", F.lit(True)).unionByName(right.withColumn("left", F.lit(False)))
    met = met.select("row", "vector", "core", "left", key.alias("pair")).repartition("pair").sortWithinPartitions("pair")
    return inner.unionByName(map_batches(met, _block_counts(cosine), "row bigint, n bigint"))


def embedding_dedup(
    df: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    cosine: float = COSINE,
    window: int = WINDOW,
    missed: float = MISSED,
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row.

    Vectors link at a cosine of ``cosine`` or more. Those that are null, empty, all zeros, hold
    null or non-finite components, or have another length than most link with nothing; nor do
    rows without an id, whose component is null and which are kept. Copies link with each other. Rows of
    one id are one node: each counts its own links, and they share a component. An empty table
    gives no rows. Runs jobs now.
    """
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"))
    fine = usable(F.col("vector")) & F.exists("vector", lambda x: x != 0) & F.col("id").isNotNull()
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("size", F.when(fine, F.size("vector")))
    rows = stored(rows, "vectors")
    # One count per length; the commonest, then the greatest, is the one.
    usual = rows.where("size > 0").groupBy("size").count().agg(F.max(F.struct("count", "size")).alias("m")).first()["m"]
    size, count = (usual["size"], usual["count"]) if usual else (0, 0)
    good = rows.where(F.col("size") == size).select("id", "row", "vector")
    alone = rows.where(~F.coalesce(F.col("size") == size, F.lit(False)))
    links = _found(good, size, cosine, window, passes_for(count, cosine, window, missed)) if count else None
    if links is None or links.isEmpty():
        return _result(rows.select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("component")), id)
    labels = stored(components(links).toDF("id", "component"), "labels")
    linked = stored(good.join(labels, "id"), "linked")
    sizes = linked.groupBy("component").agg(F.count("*").alias("members"))
    crowds = stored(sizes.where(F.col("members") > CROWD).select("component"), "crowds")
    small = linked.join(small_side(crowds), "component", "left_anti").repartition("component").sortWithinPartitions("component")
    counts = map_batches(small.select("component", "row", "vector"), _counts(cosine), "row bigint, n bigint")
    counts = counts.unionByName(_crowded(linked.join(small_side(crowds), "component"), size, cosine))
    counts = counts.groupBy("row").agg(F.sum("n").alias("n"))
    found = linked.select("id", "row", "component").join(counts, "row", "left")
    lonely = good.join(labels, "id", "left_anti").select("id").unionByName(alone.select("id"))
    return _result(
        found.select("id", F.coalesce("n", F.lit(0)).alias("n"), "component").unionByName(
            lonely.select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("component"))
        ),
        id,
    )


def _result(found: DataFrame, id: str) -> DataFrame:
    kept = F.col("id").eqNullSafe(F.col("component"))
    return found.select(F.col("id").alias(id), F.col("n").alias("n_links"), F.col("component").alias("component_id"), kept.alias("kept"))
