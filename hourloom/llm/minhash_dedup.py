"""MinHash near-dedup with tensored banding.

A text is the set of its five-word shingles. Instead of one long MinHash signature per
table, a set gets a few small collections of MinHashes; every pair of collections makes a
table, whose key is both collections together. So 32 collections of 3 MinHashes stand for
496 tables of 6: 96 MinHashes where plain banding takes 2,976. Two sets meet in a table when
at least two collections agree; at a similarity of 0.75 the chance that fewer do is 6e-7.

Only collections that some other set shares are paired, since no other key can match, so
sets without any likeness make no table keys at all. Pairs that meet are verified on their
full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import SPACES, map_batches, stored, text_slices
from hourloom.llm.graph import merged_labels

SHINGLE = 5
COLLECTIONS, HASHES = 32, 3
#: Links need 100 * intersection >= 75 * union.
PERCENT = 75
#: Sets of a block that is compared with another.
BLOCK_SETS = 512
#: Shingles hashed at a time, and words remembered in a task.
BLOCK, REMEMBERED = 1 << 15, 500_000
#: Bits of the map that finds the texts asked for again.
MAP_BITS = 1 << 27

_MUL = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


def shingle_set(text: str, words: dict) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; only A-Z are lower-cased."""
    found = text.encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    width = min(SHINGLE, len(h))
    n = len(h) - width + 1
    mixed = np.full(n, width, np.uint64)
    for i in range(width):
        mixed = _mix(mixed * _MUL + h[i : i + n])
    return np.unique(mixed)


def _parameters() -> tuple[np.ndarray, np.ndarray]:
    seeds = _mix(np.arange(1, 2 * COLLECTIONS * HASHES + 1, dtype=np.uint64) * _MUL)
    return seeds[::2] | np.uint64(1), seeds[1::2]


def collection_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One row per non-empty set: a 64-bit key for each collection of MinHashes."""
    factor, shift = _parameters()
    lowest = np.full((len(sets), len(factor)), np.iinfo(np.uint64).max, np.uint64)
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    for at in range(0, len(flat), BLOCK):
        part = _mix(flat[at : at + BLOCK])
        lo = np.searchsorted(starts, at, side="right") - 1
        hi = np.searchsorted(starts, at + len(part), side="left")
        cuts = np.maximum(starts[lo:hi] - at, 0)
        for k in range(len(factor)):
            found = np.minimum.reduceat(part * factor[k] + shift[k], cuts)
            np.minimum(lowest[lo:hi, k], found, out=lowest[lo:hi, k])
    grouped = lowest.reshape(len(sets), COLLECTIONS, HASHES)
    key = np.tile(np.arange(1, COLLECTIONS + 1, dtype=np.uint64), (len(sets), 1))
    for i in range(HASHES):
        key = _mix(key * _MUL + grouped[:, :, i])
    return key


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that stand for the whole set."""
    return xxhash.xxh3_128_digest(shingles.astype("<u8").tobytes())


_SIGNED = "doc_id bigint, text_hash bigint, n_shingles bigint, set_key binary, collections array<bigint>"
_SETS = "set_key binary, shingles array<bigint>"


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _Words()
    for batch in batches:
        for at, texts in text_slices(batch, "text"):
            sets = [shingle_set(t, words) for t in texts]
            some = [s for s in sets if len(s)]
            keys = iter(collection_keys(some).astype(np.int64)) if some else iter(())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(at, len(texts)),
                    batch.column("text_hash").slice(at, len(texts)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "n_shingles", "set_key", "collections"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _Words()
    for batch in batches:
        for _, texts in text_slices(batch, "text"):
            sets = [s for s in (shingle_set(t, words) for t in texts) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_key(s) for s in sets], pa.binary()),
                    pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["set_key", "shingles"],
            )


def table_keys(classes: DataFrame) -> DataFrame:
    """(key, node): the tables' keys, from pairs of collections that other classes share."""
    cells = classes.select("node", F.posexplode("collections").alias("i", "k"))
    shared = cells.groupBy("i", "k").agg(F.count("*").alias("n")).where("n > 1").select("i", "k")
    of_node = (
        cells.join(shared, ["i", "k"])
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("i", "k"))).alias("c"))  # at most COLLECTIONS
        .where(F.size("c") > 1)
    )
    first = of_node.select("node", "c", F.posexplode("c").alias("p", "a"))
    both = first.select("node", "a", F.explode(F.slice("c", F.col("p") + 2, F.size("c"))).alias("b"))
    return both.select(F.xxhash64("a.i", "a.k", "b.i", "b.k").alias("key"), "node")


def _maybe_among(rows: DataFrame, key: str, asked: DataFrame, bits: int | None = None) -> DataFrame:
    """Rows whose key may be one of those asked for; all that are stay, a few others may.

    The keys' hashes are bits of a map of ``bits``, or ``MAP_BITS``, bits, 16 MB at most whatever the
    input, in pieces that are broadcast.
    """
    at = F.pmod(F.xxhash64(key), F.lit(bits or MAP_BITS)) + 1
    pieces = asked.select(F.bitmap_bucket_number(at).alias("__piece"), F.bitmap_bit_position(at).alias("__bit"))
    pieces = pieces.groupBy("__piece").agg(F.bitmap_construct_agg("__bit").alias("__map"))
    placed = rows.withColumns({"__piece": F.bitmap_bucket_number(at), "__bit": F.bitmap_bit_position(at)})
    byte = "conv(hex(substring(__map, cast(__bit div 8 as int) + 1, 1)), 16, 10)"
    hit = F.expr(f"getbit(cast({byte} as int), cast(__bit % 8 as int)) = 1")
    return placed.join(F.broadcast(pieces), "__piece").where(hit).select(*rows.columns)


def _sets_of(nodes: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, s): full shingle sets of the nodes, from the texts of one row of each class."""
    asked = stored(nodes.distinct().join(classes, "node").select("node", "set_key", "low_id"), "asked")
    # Texts that are not asked for are left behind before anything is shuffled.
    near = _maybe_among(wanted, "doc_id", asked.select(F.col("low_id").alias("doc_id")))
    rows = near.join(asked.select("low_id").distinct(), near["doc_id"].eqNullSafe(F.col("low_id")), "left_semi")
    sets = map_batches(rows.select("text"), _sets, _SETS).join(asked.select("node", "set_key"), "set_key")
    return stored(sets.groupBy("node").agg(F.first("shingles").alias("s")), "sets")


def _judged(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, link, open) of pairs (a, b, na, nb), on their full shingle sets.

    open: b may still link with a set that is no smaller than a. Such a link asks for more
    common shingles than b shares with a, so b must have enough of them outside of a.
    """
    both = pairs.join(sets.toDF("b", "sb"), "b").join(sets.toDF("a", "sa"), "a")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    counted = both.select("a", "b", "na", "nb", common.alias("common"))
    link = 100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))
    least = F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent)) - F.col("common")
    return counted.select("a", "b", link.alias("link"), (F.col("nb") - F.col("common") >= least).alias("open"))


def _compared(percent: int):
    """Links among the sets of two blocks of a group that join components, at most one per set."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, i, j = (k.as_py() for k in key)
        node, block = table["node"].to_numpy(), table["block"].to_numpy()
        component, open_ = table["c"].to_numpy(), table["open"].to_numpy(zero_copy_only=False).astype(bool)
        sets = table["s"].combine_chunks()
        size = pc.list_value_length(sets).to_numpy().astype(np.int64)
        flat, owner = sets.flatten().to_numpy(), np.repeat(np.arange(len(node)), size)
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        in_left, in_right = np.isin(owner, left), np.isin(owner, right)
        shared = np.intersect1d(flat[in_left], flat[in_right])
        common = np.zeros((len(left), len(right)), np.float32)
        place = np.zeros(len(node), np.int64)
        for at in range(0, len(shared), 4096):
            part = shared[at : at + 4096]
            sides = []
            for rows, inside in ((left, in_left), (right, in_right)):
                place[rows] = np.arange(len(rows))
                column = np.minimum(np.searchsorted(part, flat[inside]), len(part) - 1)
                hit = part[column] == flat[inside]
                m = np.zeros((len(rows), len(part)), np.float32)
                m[place[owner[inside][hit]], column[hit]] = 1
                sides.append(m)
            common += sides[0] @ sides[1].T
        total = size[left][:, None] + size[right][None, :]
        near = (100 + percent) * common.astype(np.int64) >= percent * total
        near &= (component[left][:, None] != component[right][None, :]) & (open_[left][:, None] | open_[right][None, :])
        parent = {c: c for c in component.tolist()}

        def find(c):
            while parent[c] != c:
                c = parent[c]
            return c

        found = []
        for x, y in zip(*np.nonzero(near)):
            p, q = find(component[left[x]]), find(component[right[y]])
            if p != q:
                parent[max(p, q)] = min(p, q)
                found.append((node[left[x]], node[right[y]]))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return run


def _linked(buckets: DataFrame, classes: DataFrame, wanted: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the classes that link, from the buckets (key, node) they meet in.

    What meets under one smallest set is a group. A group that fits a block is compared in
    one task. In a larger one the smallest set is compared with all others first; where
    that does not make one component, the sets are compared with each other in blocks, two
    to a task. Only links between components come out, so no link between sets that met is
    lost, and no pairs are listed.
    """
    sizes = classes.select("node", "n")
    sized = stored(buckets, "tables").join(sizes, "node")
    heads = sized.groupBy("key").agg(F.min(F.struct("n", "node")).alias("head"), F.count("*").alias("m"))
    heads = heads.where("m > 1").select("key", F.col("head.node").alias("a"), F.col("head.n").alias("na"))
    pairs = sized.join(heads, "key").where("node <> a")
    pairs = pairs.select("a", F.col("node").alias("b"), "na", F.col("n").alias("nb")).distinct()
    pairs = stored(pairs, "pairs")
    pairs = stored(pairs.join(pairs.groupBy("a").agg(F.count("*").alias("m")), "a"), "grouped-pairs")
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")), classes, wanted)

    fits = pairs.where(f"m > 1 AND m < {BLOCK_SETS}")
    members = fits.select("a", F.col("b").alias("node")).unionByName(fits.select("a", F.col("a").alias("node")).distinct())
    zero = F.lit(0)
    whole = members.select("a", zero.alias("i"), zero.alias("j"), "node", zero.alias("block"), F.col("node").alias("c"), F.lit(True).alias("open"))
    inside = _compare_blocks(whole, sets, percent)
    judged = stored(_judged(pairs.where(f"m = 1 OR m >= {BLOCK_SETS}"), sets, percent), "judged")
    labels = merged_labels(None, judged.where("link").select("a", "b").unionByName(inside))

    crowded = judged.join(pairs.where(f"m >= {BLOCK_SETS}").select("a", "b"), ["a", "b"])
    named = (
        crowded.join(labels.toDF("b", "cb"), "b", "left")
        .join(labels.toDF("a", "ca"), "a", "left")
        .select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("c"), "open")
    )
    apart = F.col("ca") != F.col("c")
    # A set apart from the smallest one that has too little outside of it is done with.
    named = named.where(~apart | F.col("open")).withColumn("open", apart)
    groups = named.groupBy("a").agg(F.count("*").alias("m"), F.max("open").alias("x")).where("m > 1 AND x")
    blocks = F.ceil(F.col("m") / BLOCK_SETS).cast("int")
    members = named.join(groups.select("a", blocks.alias("blocks")), "a")
    members = members.withColumn("block", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int"))
    copies = members.select(
        "a", F.col("b").alias("node"), "block", "c", "open", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")
    ).select("a", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "node", "block", "c", "open")
    return merged_labels(labels, _compare_blocks(copies, sets, percent))


def _compare_blocks(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of members (a, i, j, node, block, c, open) of groups, block i against block j."""
    found = members.join(sets, "node").groupBy("a", "i", "j").applyInArrow(_compared(percent), "a bigint, b bigint")
    return stored(found.distinct(), "found")


def near_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash, group_id; one row per row of the input.

    A text with fewer than five words is one shingle. Without words, or null, it links
    with nothing: component_id is its own doc_id. Rows with equal sets are one class and
    always in one component, repeated rows too; each row that has the component's
    smallest doc_id is kept. A null doc_id is never the smallest while others are there.
    group_id numbers the components, null for texts without words; text_hash is the text's
    xxhash64. Equal 128-bit set keys count as equal sets. Columns besides id and text are not read.
    """
    wanted = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    signed = stored(map_batches(wanted.withColumn("text_hash", F.xxhash64("text")), _signed, _SIGNED), "signed")
    full = signed.where("set_key IS NOT NULL")
    merged = full.groupBy("set_key").agg(F.min("doc_id").alias("low_id"), F.max("n_shingles").alias("n"))
    # Numbers given while the table is written, so they stay what they are.
    classes = stored(merged.withColumn("node", F.monotonically_increasing_id()), "classes")
    heads = (
        full.join(classes, "set_key")
        .where(F.col("doc_id").eqNullSafe(F.col("low_id")))
        .select("node", "collections")
        .groupBy("node")
        .agg(F.max("collections").alias("collections"))
    )

    labels = _linked(table_keys(heads), classes, wanted, percent)
    named = classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("low_id").alias("component_id"))
    of_set = named.join(lowest, "component").select("set_key", "component_id", F.col("component").alias("group_id"))
    return (
        signed.join(of_set, "set_key", "left")
        .withColumn("component_id", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash", "group_id")
    )


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` less all but one of each component; texts without words all stay.

    Of rows in a component that share its smallest id, one stays, that of the smallest
    text_hash. Columns stay as they are.
    """
    found = near_dedup(docs, text, doc_id, percent).where("kept AND group_id IS NOT NULL")
    first = found.groupBy("group_id").agg(F.min("text_hash").alias("__h"), F.min("doc_id").alias("__id"))
    copies = found.groupBy("group_id", F.col("text_hash").alias("__h")).agg(F.count("*").alias("__n"))
    stays = first.join(copies, ["group_id", "__h"]).groupBy("__id", "__h").agg(F.max("__n").alias("__n"))
    body = F.btrim(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(SPACES))
    keyed = docs.withColumn("__h", F.xxhash64(F.col(f"`{text}`")))
    same = F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col("__id")) & (keyed["__h"] == stays["__h"])
    rows = keyed.where(body != "").join(stays, same).drop(keyed["__h"]).drop("__id")
    once = rows.where("__n = 1").select(*docs.columns)
    repeated = rows.where("__n > 1").dropDuplicates([doc_id, "__h"]).select(*docs.columns)
    return once.unionByName(repeated).unionByName(docs.where(body == ""))
