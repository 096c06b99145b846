"""Exact dedup over a bucketed cuckoo-filter index of live digests.

The index is a table of live digests, dealt into buckets by digest. A task that works on a
bucket holds a cuckoo filter over its digests: a new digest that the filter does not know
is inserted at once; a hit is verified against the digests the bucket holds, since the
filter may err. A digest whose rows change is deleted and inserted again. When an insertion
finds no place the filter is built anew at twice the size from the stored digests.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import SPACES, map_batches, stored

#: Digests a bucket is meant to hold; the number of buckets follows the rows.
BUCKET_DIGESTS = 500_000
KICKS = 200
SLOTS = 4

_INDEX = "digest binary, keep_id bigint, keep_chars bigint, group_size bigint"
_LOAD, _DELETE, _ADD = 0, 1, 2


class CuckooFilter:
    """Membership with deletion: 15-bit fingerprints in two possible places of four slots each."""

    def __init__(self, places: int = 256):
        self.places = places  # a power of two
        self.table = [[] for _ in range(places)]
        self.size = 0

    def _spots(self, digest: bytes) -> tuple[int, int, int]:
        print_ = int.from_bytes(digest[:2], "little") % 32767 + 1
        first = int.from_bytes(digest[2:10], "little") & (self.places - 1)
        return print_, first, self._other(first, print_)

    def _other(self, place: int, print_: int) -> int:
        return place ^ ((print_ * 0x5BD1E995) & (self.places - 1))

    def __contains__(self, digest: bytes) -> bool:
        print_, a, b = self._spots(digest)
        return print_ in self.table[a] or print_ in self.table[b]

    def insert(self, digest: bytes) -> bool:
        """False where no place was found; the filter must then be built anew."""
        print_, a, b = self._spots(digest)
        for place in (a, b):
            if len(self.table[place]) < SLOTS:
                self.table[place].append(print_)
                self.size += 1
                return True
        place = a
        for kick in range(KICKS):
            slot = (print_ + kick) % SLOTS
            self.table[place][slot], print_ = print_, self.table[place][slot]
            place = self._other(place, print_)
            if len(self.table[place]) < SLOTS:
                self.table[place].append(print_)
                self.size += 1
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        """Only for digests known to be inside, else another one's fingerprint may go."""
        print_, a, b = self._spots(digest)
        for place in (a, b):
            if print_ in self.table[place]:
                self.table[place].remove(print_)
                self.size -= 1
                return True
        return False


class LiveIndex:
    """The digests of one bucket: a cuckoo filter before the stored entries."""

    def __init__(self):
        self.filter = CuckooFilter()
        self.entries: dict[bytes, tuple] = {}
        self.resized = 0

    def find(self, digest: bytes) -> tuple | None:
        return self.entries.get(digest) if digest in self.filter else None

    def put(self, digest: bytes, entry: tuple) -> None:
        """Inserts, or replaces the entry of a live digest."""
        live = self.find(digest) is not None
        self.entries[digest] = entry
        if live or self.filter.insert(digest):
            return
        places = self.filter.places
        while True:
            places *= 2
            self.resized += 1
            self.filter = CuckooFilter(places)
            if all(self.filter.insert(d) for d in self.entries):
                return

    def drop(self, digest: bytes) -> None:
        if self.find(digest) is not None:
            self.filter.delete(digest)
            del self.entries[digest]


def _order(entry: tuple) -> tuple:
    """Smaller is better: most characters, then smallest id, null ids last."""
    doc_id, chars, _ = entry
    return -chars, doc_id is None, doc_id or 0


def _merged(a: tuple | None, b: tuple) -> tuple:
    if a is None:
        return b
    best = min(a, b, key=_order)
    return best[0], best[1], a[2] + b[2]


def _columns(batch: pa.RecordBatch) -> Iterator[tuple]:
    names = ("op", "digest", "keep_id", "keep_chars", "group_size")
    return zip(*(batch.column(n).to_pylist() for n in names))


def _batch(ops: list[int] | None, rows: dict[bytes, tuple]) -> pa.RecordBatch:
    digests, entries = list(rows), list(rows.values())
    arrays = [pa.array(digests, pa.binary())] + [pa.array([e[i] for e in entries], pa.int64()) for i in range(3)]
    names = ["digest", "keep_id", "keep_chars", "group_size"]
    if ops is not None:
        arrays, names = [pa.array(ops, pa.int32()), *arrays], ["op", *names]
    return pa.RecordBatch.from_arrays(arrays, names)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest of a batch: copies meet before the shuffle."""
    for batch in batches:
        rows: dict[bytes, tuple] = {}
        for _, digest, *entry in _columns(batch):
            rows[digest] = _merged(rows.get(digest), tuple(entry))
        yield _batch([_ADD] * len(rows), rows)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = LiveIndex()
    for batch in batches:
        for op, digest, *entry in _columns(batch):
            if op == _DELETE:
                index.drop(digest)
            else:
                index.put(digest, _merged(index.find(digest), tuple(entry)))
    items = list(index.entries.items())
    for at in range(0, len(items), 10_000):
        yield _batch(None, dict(items[at : at + 10_000]))


def digested(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_chars, digest): SHA-256 of the text without spaces; null counts as empty."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.length(body).cast("long").alias("n_chars"),
        F.unhex(F.sha2(F.translate(body, SPACES, "").cast("binary"), 256)).alias("digest"),
    )


def maintain(index: DataFrame | None, added: DataFrame, deleted: DataFrame | None = None, buckets: int | None = None):
    """The index after deleting digests and adding rows of ``digested``, in this order.

    Columns: digest, keep_id, keep_chars, group_size. To take rows away, delete their
    digests and add the rows of these digests that remain. Null ids order after others.
    """
    count = added.count() + (index.count() if index is not None else 0)
    buckets = buckets or max(1, -(-count // BUCKET_DIGESTS), added.sparkSession.sparkContext.defaultParallelism)
    wide = "op int, " + _INDEX
    rows = added.select(
        F.lit(_ADD).alias("op"),
        "digest",
        F.col("doc_id").alias("keep_id"),
        F.col("n_chars").alias("keep_chars"),
        F.lit(1).cast("long").alias("group_size"),
    )
    rows = map_batches(rows, _summed, wide)
    if index is not None:
        rows = rows.unionByName(index.withColumn("op", F.lit(_LOAD)))
    if deleted is not None:
        gone = deleted.select("digest", F.lit(_DELETE).alias("op"))
        rows = rows.unionByName(gone, allowMissingColumns=True)
    dealt = rows.repartition(buckets, F.pmod(F.xxhash64("digest"), F.lit(buckets)))
    return map_batches(dealt.sortWithinPartitions("op"), _indexed, _INDEX)


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", buckets: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256; one row per row of the input.

    Texts are equal when identical without white space; null counts as empty. Of equal
    texts the row with the most characters, then the smallest id stays; null ids come
    last; of rows that repeat id and text one stays. An empty table gives no rows. Other
    columns are not read.
    """
    rows = stored(digested(docs, text, doc_id), "digests")
    index = stored(maintain(None, rows, buckets=buckets), "index")
    counted = rows.groupBy("digest", "doc_id", "n_chars").agg(F.count("*").alias("copies"))
    named = counted.join(index, "digest")
    best = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    return named.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("nth")).select(
        "doc_id",
        "keep_id",
        "group_size",
        (best & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
