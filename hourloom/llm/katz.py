"""Katz backoff language model over word bigrams.

Counts are discounted by Good-Turing; what the discounts free goes to words not seen after
a context, in proportion to their unigram probabilities, so that the probabilities after
every context add up to one. Unigrams are discounted the same way, and what they free is
the probability of an unknown word.

Documents are read once into a table of chunks: a few million tokens each, a sorted list of
its words' hashes and a code per token. A chunk asks for the counts of its words and then of
its word pairs, each once, by sending sorted lists to buckets of words or contexts; a bucket
adds up what all chunks sent and answers each list in its own order. So a pair crosses the
network once per chunk, not once per token, and no count goes through the driver. The
answers are stored as tables partitioned by bucket; a chunk evaluates its tokens on them,
bigram first, else backoff weight times unigram, else unknown word.

A context that is seen so often that its pairs could fill a task is split over several
buckets by the following word; the chunks add up what these buckets know of it.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import map_batches, remainder, send_library, stored, text_slices
from hourloom.shared import new_folder

#: Counts up to here are discounted.
DISCOUNTED = 5
#: Tokens of a chunk, bytes of text a task is meant to read, pairs of a bucket.
CHUNK_TOKENS, CHUNK_BYTES, BUCKET_PAIRS = 2_000_000, 24 << 20, 1_500_000
#: A context seen more often than this is split over so many buckets.
HOT = 2_000_000
END = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Bits of a following word's hash that tell it apart within a context.
NEXT_BITS = 48
#: Bits of a signed number that a sorting key may take.
KEY_BITS = 63
_MUL = np.uint64(0x9E3779B97F4A7C15)

_CHUNK = "chunk bigint, doc_ids array<bigint>, held array<boolean>, sizes array<int>, data binary"
_ASK = "chunk bigint, bucket int, data binary"
_STATS = 2 + DISCOUNTED + 1  # N, V, n_1 ... n_6


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string, byte planes apart."""
    out = [struct.pack("<B", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        body = zstandard.ZstdCompressor(level=1).compress(planes)
        out += [struct.pack("<3sQQ", a.dtype.str.encode()[:3], len(a), len(body)), body]
    return b"".join(out)


def unpacked(data: bytes) -> list[np.ndarray]:
    at, out = 1, []
    for _ in range(data[0]):
        kind, n, size = struct.unpack_from("<3sQQ", data, at)
        at += struct.calcsize("<3sQQ")
        kind = np.dtype(kind.decode())
        planes = zstandard.ZstdDecompressor().decompress(data[at : at + size], max_output_size=max(1, n * kind.itemsize))
        out.append(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T.copy().view(kind).reshape(n))
        at += size
    return out


def discounts(n: np.ndarray) -> np.ndarray:
    """Factors of the counts 1, 2, ... from the numbers n_1, n_2, ... of things counted so often.

    As many counts are discounted as give factors between 0 and 1; at least 1 is, by half if
    nothing else will do.
    """
    for k in range(min(DISCOUNTED, len(n) - 1), 0, -1):
        if (n[: k + 1] > 0).all():
            r = np.arange(1, k + 1)
            tail = (k + 1) * n[k] / n[0]
            d = ((r + 1) * n[1 : k + 1] / n[:k] / r - tail) / (1 - tail) if tail < 1 else np.zeros(k)
            if (d > 0).all() and (d < 1).all():
                return d
    return np.array([0.5])


class Unigrams:
    """Probabilities of words from their counts in the training texts."""

    def __init__(self, stats: np.ndarray):
        self.n, self.v = int(stats[0]), int(stats[1])
        self.d = discounts(stats[2:].astype(float))
        freed = sum((1 - d) * (r + 1) * stats[2 + r] for r, d in enumerate(self.d))
        if self.n and not freed:  # no word is so rare: one occurrence more is set aside
            self.scale, self.unknown = self.n / (self.n + 1), 1 / (self.n + 1)
        else:
            self.scale, self.unknown = 1.0, freed / self.n if self.n else 1.0

    def p(self, count: np.ndarray) -> np.ndarray:
        count = count.astype(np.float64)
        return np.where(count > 0, self.scale * discounted(count, self.d) / max(1, self.n), self.unknown)


def discounted(count: np.ndarray, d: np.ndarray) -> np.ndarray:
    factor = np.r_[1.0, d, 1.0]
    return count * factor[np.minimum(count, len(d) + 1).astype(np.int64)]


def backoff(total: np.ndarray, low: np.ndarray, seen: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Factor of a context's discounted shares, and its backoff weight.

    total: occurrences; low: numbers of successors seen once, twice, ...; seen: unigram
    probability of all successors. A context that frees nothing sets one occurrence aside.
    """
    freed = ((1 - d) * np.arange(1, len(d) + 1) * low[:, : len(d)]).sum(1)
    none = freed <= 0
    scale = np.where(none, total / np.maximum(total + 1, 1), 1.0)
    left = np.where(none, 1 / (total + 1), freed / np.maximum(total, 1))
    weight = np.where(total > 0, left / np.maximum(1 - seen, 1e-12), 1.0)
    return scale, weight


# Chunks


def _chunks(chunk_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids, held, sizes, hashes, tokens = [], [], [], [], 0
        known: dict[bytes, int] = {}

        def row() -> pa.RecordBatch:
            vocabulary, codes = np.unique(np.concatenate(hashes), return_inverse=True)
            data = packed(vocabulary, codes.astype(np.uint32))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task << 24 | number], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([held], pa.list_(pa.bool_())),
                    pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([data], pa.binary()),
                ],
                ["chunk", "doc_ids", "held", "sizes", "data"],
            )

        for batch in batches:
            for at, texts in text_slices(batch, "text"):
                if len(known) > 500_000:
                    known.clear()
                split = [t.encode().lower().split() for t in texts]
                for word in set().union(*split).difference(known):
                    known[word] = min(xxhash.xxh3_64_intdigest(word), int(END) - 1)
                for words in split:
                    h = np.empty(len(words) + 1, np.uint64)
                    h[:-1] = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
                    h[-1] = END
                    hashes.append(h)
                    sizes.append(len(h))
                    tokens += len(h)
                ids += batch.column("doc_id").slice(at, len(texts)).to_pylist()
                held += batch.column("held").slice(at, len(texts)).to_pylist()
                if tokens >= chunk_tokens:
                    yield row()
                    number += 1
                    ids, held, sizes, hashes, tokens = [], [], [], [], 0
        if ids:
            yield row()

    return run


class Chunk:
    """A chunk's tokens; words are numbered in the order of their hashes."""

    def __init__(self, table: pa.Table, hot: int = HOT):
        self.hot = hot
        row = table.slice(0, 1)
        self.id = row["chunk"][0].as_py()
        self.doc_ids = row["doc_ids"].combine_chunks().flatten()
        self.held = row["held"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(bool)
        self.sizes = row["sizes"].combine_chunks().flatten().to_numpy().astype(np.int64)
        self.words, codes = unpacked(row["data"][0].as_py())
        self.codes = codes.astype(np.int64)
        self.trained = np.repeat(~self.held, self.sizes)

    def pairs(self, counts: np.ndarray, buckets: int):
        """Distinct (bucket and context as one number, next) in this order, where each token's
        is, and how often training texts have it.

        The number is bucket * words + context. With the next word it mostly fits one more
        number, which sorts faster; where the chunk has too many words for that, both are sorted by.
        """
        size = len(self.words)
        before = np.r_[size - 1, self.codes[:-1]]  # the end mark has the greatest hash
        place_of = self._bucket(before, self.codes, counts, buckets) * size + before
        if buckets * size * size < 1 << KEY_BITS:
            order = np.argsort(place_of * size + self.codes, kind="stable")
        else:
            order = np.lexsort((self.codes, place_of))
        bc, code = place_of[order], self.codes[order]
        first = np.flatnonzero(np.r_[True, (bc[1:] != bc[:-1]) | (code[1:] != code[:-1])])
        times = np.add.reduceat(self.trained[order], first, dtype=np.int64)
        place = np.empty(len(order), np.int64)
        place[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(order)]))
        return bc[first], code[first], place, times

    def home(self, buckets: int) -> np.ndarray:
        return home(self.words, buckets)

    def _bucket(self, before: np.ndarray, after: np.ndarray, counts: np.ndarray, buckets: int) -> np.ndarray:
        parts = split_over(counts, self.hot)
        spread = (self.words >> np.uint64(16)).astype(np.int64) & 0xFFFFFFFF
        return (self.home(buckets)[before] + spread[after] % parts[before]) % buckets


def home(words: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by a word's highest bits, so buckets are stretches of a sorted list."""
    return ((words >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def split_over(counts: np.ndarray, hot: int) -> np.ndarray:
    return 1 + counts.astype(np.int64) // hot


def _answers(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    kinds = pa.int64(), pa.int32(), pa.binary()
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["chunk", "bucket", "data"])


def _batches(rows: list[tuple[int, int, bytes]]) -> list[pa.RecordBatch]:
    return _answers(rows).to_batches()


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as hold them."""
    return counts.astype(np.uint32 if counts.max(initial=0) < 2**32 else np.uint64)


# Words


def _ask_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                c = Chunk(pa.Table.from_batches([batch.slice(i, 1)]))
                counts = np.bincount(c.codes[c.trained], minlength=len(c.words)).astype(np.uint32)
                cuts = np.searchsorted(c.home(buckets), np.arange(buckets + 1))
                rows = [
                    (c.id, b, packed(c.words[lo:hi], counts[lo:hi]))
                    for b, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
                    if hi > lo
                ]
                yield from _batches(rows)

    return run


def _stats(total: int, counts: np.ndarray) -> np.ndarray:
    seen = counts[counts > 0]
    return np.r_[total, len(seen), [(seen == r).sum() for r in range(1, DISCOUNTED + 2)]].astype(np.int64)


def _add_words(table: pa.Table) -> pa.Table:
    """A bucket: the sums of all chunks, to each in the order of its list; totals under chunk -1."""
    chunks, bucket = table["chunk"].to_pylist(), table["bucket"][0].as_py()
    lists = [unpacked(d) for d in table["data"].to_pylist()]
    words, place = np.unique(np.concatenate([w for w, _ in lists]), return_inverse=True)
    sums = np.bincount(place, np.concatenate([n for _, n in lists]), len(words)).astype(np.int64)
    ends = np.cumsum([len(w) for w, _ in lists])
    rows = [(c, bucket, packed(sums[p])) for c, p in zip(chunks, np.split(place, ends[:-1]))]
    return _answers([*rows, (-1, bucket, packed(_stats(int(sums.sum()), sums)))])


def _words_known(chunk: Chunk, answers: pa.Table) -> np.ndarray:
    """Counts of the chunk's words, from the answers of the word buckets."""
    rows = sorted(zip(answers["bucket"].to_pylist(), answers["data"].to_pylist()))
    return np.concatenate([unpacked(d)[0] for _, d in rows])


def _contexts(keys: np.ndarray, chunk: Chunk, counts: np.ndarray, buckets: int):
    """Distinct (bucket, context) that a chunk asks for, and how many pairs follow each.

    A split context is asked for in all its buckets, with or without pairs of the chunk.
    """
    size = len(chunk.words)
    asked = np.flatnonzero(np.bincount(keys % size, minlength=size))
    parts = split_over(counts, chunk.hot)[asked]
    part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    context = np.repeat(asked, parts)
    bucket = (chunk.home(buckets)[context] + part) % buckets
    wanted = np.unique(bucket * size + context)
    runs = np.searchsorted(keys, wanted, side="right") - np.searchsorted(keys, wanted)
    return wanted, runs


def _ask_pairs(buckets: int, hot: int):
    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _answers([])
        c = Chunk(left, hot)
        counts = _words_known(c, right)
        keys, after, _, times = c.pairs(counts, buckets)
        wanted, runs = _contexts(keys, c, counts, buckets)
        ends = np.r_[0, np.cumsum(runs)]
        cuts = np.searchsorted(wanted // len(c.words), np.arange(buckets + 1))
        rows = []
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            contexts = slice(cuts[b], cuts[b + 1])
            pairs = slice(ends[cuts[b]], ends[cuts[b + 1]])
            w = c.words[after[pairs]]
            rows.append(
                (
                    c.id,
                    b,
                    packed(
                        c.words[wanted[contexts] % len(c.words)],
                        runs[contexts].astype(np.uint32),
                        (w & np.uint64(0xFFFFFFFF)).astype(np.uint32),
                        ((w >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.uint16),
                        _narrow(counts[after[pairs]]),
                        times[pairs].astype(np.uint32),
                    ),
                )
            )
        return _answers(rows)

    return run


def _add_pairs(unigrams: Unigrams):
    def run(table: pa.Table) -> pa.Table:
        """A bucket of contexts: to each chunk the counts of its pairs, and for each of its
        contexts the successors seen once, twice, ... and their unigram probability."""
        chunks, bucket = table["chunk"].to_pylist(), table["bucket"][0].as_py()
        lists = [unpacked(d) for d in table["data"].to_pylist()]
        contexts, context = np.unique(np.concatenate([x[0] for x in lists]), return_inverse=True)
        of_pair = np.repeat(context, np.concatenate([x[1] for x in lists]))
        after = np.concatenate([x[2].astype(np.uint64) | x[3].astype(np.uint64) << np.uint64(32) for x in lists])
        key = (of_pair.astype(np.uint64) + np.uint64(1)) * _MUL ^ after * np.uint64(0xD6E8FEB86659FD93)
        key = (key ^ key >> np.uint64(32)) * _MUL + of_pair.astype(np.uint64)
        _, first, place = np.unique(key, return_index=True, return_inverse=True)
        sums = np.bincount(place, np.concatenate([x[5] for x in lists]), len(first)).astype(np.int64)
        seen = sums > 0
        owner = of_pair[first][seen]
        p = unigrams.p(np.concatenate([x[4] for x in lists])[first][seen])
        share = np.bincount(owner, p, len(contexts))
        low = np.stack(
            [np.bincount(owner[sums[seen] == r], minlength=len(contexts)) for r in range(1, DISCOUNTED + 1)], 1
        ).astype(np.uint32)
        rows, pair, at = [], 0, 0
        for c, x in zip(chunks, lists):
            n, mine = len(x[2]), context[at : at + len(x[0])]
            data = packed(_narrow(sums[place[pair : pair + n]]), share[mine], *low[mine].T)
            rows.append((c, bucket, data))
            pair, at = pair + n, at + len(x[0])
        return _answers([*rows, (-1, bucket, packed(_stats(int(sums.sum()), sums)))])

    return run


_SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _score(buckets: int, hot: int, unigrams: Unigrams, d: np.ndarray):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names)
        c = Chunk(left, hot)
        of_pairs = right["pairs"].to_numpy().astype(bool)
        counts = _words_known(c, right.filter(pa.array(~of_pairs)))
        answers = right.filter(pa.array(of_pairs))
        answers = [unpacked(x) for _, x in sorted(zip(answers["bucket"].to_pylist(), answers["data"].to_pylist()))]
        keys, w, place, _ = c.pairs(counts, buckets)
        wanted, _ = _contexts(keys, c, counts, buckets)
        context = wanted % len(c.words)
        pair_counts = np.concatenate([a[0] for a in answers]).astype(np.float64)
        seen = np.bincount(context, np.concatenate([a[1] for a in answers]), len(c.words))
        low = np.stack(
            [np.bincount(context, np.concatenate([a[2 + r] for a in answers]), len(c.words)) for r in range(DISCOUNTED)], 1
        )
        total = counts.astype(np.float64)  # every occurrence of a word is followed by another token
        scale, weight = backoff(total, low, seen, d)
        word_p = unigrams.p(counts)
        v = keys % len(c.words)
        p = np.where(
            pair_counts > 0, scale[v] * discounted(pair_counts, d) / np.maximum(total[v], 1), weight[v] * word_p[w]
        )
        starts = np.cumsum(c.sizes) - c.sizes
        base = np.log10((counts + 0.5) / (unigrams.n + 0.5 * (unigrams.v + 1)))
        per_text = lambda x: np.add.reduceat(x, starts)
        columns = [
            c.doc_ids,
            c.held,
            c.sizes,
            per_text((counts > 0).astype(np.int64)[c.codes]),
            per_text(base[c.codes]),
            per_text(np.log10(p)[place]),
        ]
        return pa.table([pa.array(x, k) if not isinstance(x, pa.Array) else x for x, k in zip(columns, kinds)], names)

    return run


def _total(answers: DataFrame) -> np.ndarray:
    """Totals of all buckets: a few numbers for each."""
    rows = answers.where("chunk = -1").select("data").collect()
    return np.sum([unpacked(bytes(r["data"]))[0] for r in rows], 0) if rows else np.zeros(_STATS, np.int64)


def katz_scores(
    docs: DataFrame, held: Column, text: str = "text", doc_id: str = "doc_id", chunk_tokens: int = CHUNK_TOKENS,
    chunk_bytes: int = CHUNK_BYTES, bucket_pairs: int = BUCKET_PAIRS, hot: int = HOT,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; one row per row.

    ``held``: condition of the rows that are scored without training the model. A null text
    counts as empty: the end mark is its only token. Null ids pass through; repeated rows
    count and are scored each; an empty table gives no rows. Without training rows every
    token is an unknown word. Columns besides id, text and those of ``held`` are not read.
    """
    spark = docs.sparkSession
    send_library(spark)
    wanted = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.col(f"`{text}`").alias("text"),
        F.coalesce(held, F.lit(False)).alias("held"),
    )
    size = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    homes = max(1, 2 * (-(-size // chunk_bytes)))
    buckets = max(1, size // 10 // bucket_pairs)
    # Stored in buckets by chunk, so that answers travel to chunks and chunks stay in place.
    name = f"hourloom_chunks_{uuid.uuid4().hex}"
    chunked = map_batches(wanted, _chunks(chunk_tokens), _CHUNK).write.bucketBy(homes, "chunk").sortBy("chunk")
    chunked.option("path", new_folder(spark, "llm-chunks")).format("parquet").saveAsTable(name)
    chunks = spark.table(name)

    asked = map_batches(chunks, _ask_words(buckets), _ASK)
    words = stored(asked.groupBy("bucket").applyInArrow(_add_words, _ASK), "word-counts")
    unigrams = Unigrams(_total(words))
    by_chunk = lambda df: df.where("chunk >= 0").groupBy("chunk")
    asked = chunks.groupBy("chunk").cogroup(by_chunk(words)).applyInArrow(_ask_pairs(buckets, hot), _ASK)
    pairs = stored(asked.groupBy("bucket").applyInArrow(_add_pairs(unigrams), _ASK), "pair-counts")
    d = discounts(_total(pairs)[2:].astype(float))
    both = words.withColumn("pairs", F.lit(False)).unionByName(pairs.withColumn("pairs", F.lit(True)))
    scored = chunks.groupBy("chunk").cogroup(by_chunk(both)).applyInArrow(_score(buckets, hot, unigrams, d), _SCORES)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(unigrams.n).cast("long").alias("train_tokens"), "base_score", "score"
    )


def katz_of_folds(docs: DataFrame, **sizes: int) -> DataFrame:
    """Scores of all rows under a model of those whose crc32 modulo 5 is not 1."""
    return katz_scores(docs, remainder(F.col("doc_id")) == 1, **sizes)
