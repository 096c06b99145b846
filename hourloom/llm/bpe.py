"""BPE encoding and decoding with a vocabulary file of the tokenizers library.

A word is merged with a segment tree over the ranks of its adjacent pairs: the root holds
the lowest rank and, among equals, the leftmost pair; a merge changes three leaves and the
nodes above them; it ends when the root holds no pair. Short words are merged many at a
time, one tree per row of an array; a long word has a tree of its own.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hourloom.llm.common import map_batches, text_slices

#: Words of at most so many bytes are merged many at a time.
SHORT = 32
#: Words merged at a time, and words remembered in a task.
ROWS, REMEMBERED = 4096, 300_000
NONE = np.int64(1) << 40


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabularies of this kind."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one vocabulary file, given as its JSON text."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        parts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in parts] != ["Split", "ByteLevel"]:
            raise ValueError("not a lower-casing byte-level BPE vocabulary with word ends")
        # White space only separates words, so replacing it needs no step of its own.
        self.pattern = regex.compile(parts[0]["pattern"]["Regex"])
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        tokens: list[str | None] = [None] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            tokens[i] = token
        self.tokens = pa.array(tokens, pa.string())
        self.known: dict[str, bytes] = {}

    # Words of a text

    def words(self, text: str) -> list[str]:
        """Pieces that are merged on their own, and special tokens as they stand."""
        if "<" not in text or not self.split.search(text):
            return self._plain(text)
        out: list[str] = []
        for part in self.split.split(text):
            out += [f"\0{part}"] if part in self.special else self._plain(part)
        return out

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            # Each character by itself: a sigma at a word's end is no special case.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.pattern.findall(text.lower())

    # Merging

    def ids(self, text: str) -> np.ndarray:
        return self.many([text])[0]

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; repeated words are merged once."""
        split = [self.words(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = set().union(*split).difference(self.known) if split else set()
        self._learn(list(new))
        known = self.known.__getitem__
        return [np.frombuffer(b"".join(map(known, ws)), np.int32) for ws in split]

    def _learn(self, words: list[str]) -> None:
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            if word[0] == "\0" and word[1:] in self.special:
                self.known[word] = np.int32(self.special[word[1:]]).tobytes()
                continue
            raw = word.encode()
            if len(raw) > SHORT:
                self.known[word] = np.array(self.merge_long(raw), np.int32).tobytes()
            else:
                by_width.setdefault(1 << (len(raw) - 1).bit_length(), []).append((word, raw))
        for width, group in by_width.items():
            for at in range(0, len(group), ROWS):
                part = group[at : at + ROWS]
                for (word, _), ids in zip(part, self.merge_short([raw for _, raw in part], width)):
                    self.known[word] = ids

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; negative ids make no pair."""
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], NONE)

    def merge_short(self, raws: list[bytes], width: int) -> list[bytes]:
        """Little-endian ids of words of at most ``width`` bytes, a power of two."""
        n = len(raws)
        size = np.array([len(r) for r in raws])
        flat = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raws), np.uint8).reshape(n, width)
        column = np.arange(width)
        ids = np.where(column < size[:, None], self.inner[flat], -1)
        ids[np.arange(n), size - 1] = self.last[flat[np.arange(n), size - 1]]
        if width > 1:
            ids = np.concatenate([ids, np.full((n, 1), -1)], 1)  # a place that is never part of a pair
            after = np.tile(np.minimum(np.arange(1, width + 2), width), (n, 1))
            before = np.tile(np.maximum(np.arange(-1, width), -1), (n, 1))
            # A node holds rank * width + place, so the least is the leftmost of the lowest rank.
            tree = np.full((n, 2 * width), NONE * width)
            tree[:, width:] = self._rank(ids[:, :-1], ids[:, 1:]) * width + column
            for node in range(width - 1, 0, -1):
                tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
            row = np.arange(n)
            while len(row := row[tree[row, 1] < NONE * width]):
                rank, place = np.divmod(tree[row, 1], width)
                gone = after[row, place]
                then = after[row, gone]
                ids[row, place] = self.made[rank]
                ids[row, gone] = -1
                after[row, place] = then
                before[row, then] = place
                prior = before[row, place]
                left = np.where(prior >= 0, ids[row, prior], -1)
                tree[row, width + gone] = NONE * width
                tree[row, width + place] = self._rank(ids[row, place], ids[row, then]) * width + place
                some = prior >= 0
                tree[row[some], width + prior[some]] = (
                    self._rank(left[some], ids[row, place][some]) * width + prior[some]
                )
                for leaf in (gone, place, np.where(some, prior, place)):
                    node = (leaf + width) >> 1
                    while node[0]:  # all rows are as deep
                        tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
                        node >>= 1
        kept = ids >= 0
        flat_ids = ids[kept].astype("<i4").tobytes()
        ends = np.cumsum(kept.sum(1)) * 4
        return [flat_ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def merge_long(self, raw: bytes) -> list[int]:
        """Ids of one word, with a segment tree of its own."""
        n = len(raw)
        ids = [int(self.inner[b]) for b in raw[:-1]] + [int(self.last[raw[-1]])]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        width = 1 << (n - 1).bit_length()
        none = (len(self.made) + 1) * width
        rank_of = self.rank_of

        def leaf(i: int) -> int:
            j = after[i] if i >= 0 else n
            rank = rank_of.get(ids[i] << 20 | ids[j]) if j < n else None
            return none if rank is None else rank * width + i

        tree = [none] * width + [leaf(i) for i in range(n)] + [none] * (width - n)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(i: int, value: int) -> None:
            node = width + i
            tree[node] = value
            while node := node >> 1:
                tree[node] = min(tree[2 * node], tree[2 * node + 1])

        while width > 1 and tree[1] < none:
            rank, i = divmod(tree[1], width)
            j = after[i]
            ids[i] = int(self.made[rank])
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            put(j, none)
            put(i, leaf(i))
            if before[i] >= 0:
                put(before[i], leaf(before[i]))
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    # Decoding

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Texts of lists of ids, tokens joined by a space; ids without a token are left out."""
        flat = ids.flatten()
        offsets = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy())])
        valid = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(self.tokens)))
        tokens = self.tokens.take(pc.if_else(pc.fill_null(valid, False), flat, None))
        if tokens.null_count:
            there = tokens.is_valid().to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(there)])[offsets]
            tokens = tokens.drop_null()
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), tokens), " ")


_LOADED: dict[int, Bpe] = {}


class Vocabulary:
    """A vocabulary file, read once on the driver and sent to each executor once."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as f:
            self._sent = spark.sparkContext.broadcast(zlib.compress(f.read(), 1))

    def load(self) -> Bpe:
        """In a task: one encoder for all tasks of a Python worker."""
        raw = self._sent.value
        key = zlib.crc32(raw)
        if key not in _LOADED:
            _LOADED[key] = Bpe(zlib.decompress(raw).decode())
        return _LOADED[key]


def id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))


def _with(df: DataFrame, name: str, kind: T.DataType, drop: str) -> tuple[list[str], T.StructType]:
    kept = [f for f in df.schema.fields if f.name not in (drop, name)]
    return [f.name for f in kept], T.StructType([*kept, T.StructField(name, kind)])


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with the ids of their whole texts in place of the text.

    Null and empty texts have no ids. Special tokens in a text become their ids, as the
    tokenizers library has it. Rows stay apart: repeated rows give repeated rows, other
    columns pass through, an empty table stays empty. A column named ``ids`` is replaced.
    """
    vocabulary = Vocabulary(docs.sparkSession, path)
    kept, schema = _with(docs, ids, T.ArrayType(T.IntegerType()), text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary.load()
        for batch in batches:
            for at, texts in text_slices(batch, text):
                rest = [batch.column(c).slice(at, len(texts)) for c in kept]
                yield pa.RecordBatch.from_arrays([*rest, id_lists(bpe.many(texts))], [*kept, ids])

    return map_batches(docs, run, schema)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the text of their ids: tokens joined by a space, special ones included.

    Null and empty lists give empty texts; ids without a token are left out. Other columns
    pass through, ``ids`` too; a column named ``text`` is replaced.
    """
    vocabulary = Vocabulary(rows.sparkSession, path)
    kept, schema = _with(rows, text, T.StringType(), "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary.load()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = pa.array(part.column(ids).to_pylist(), pa.list_(pa.int32())) if part.column(ids).null_count else part.column(ids)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], bpe.decode(lists)], [*kept, text])

    return map_batches(rows, run, schema)
