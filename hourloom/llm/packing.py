"""Best-fit packing of token sequences, improved by swap-based local search.

Documents are cut only where longer than a sequence. Pieces are dealt into groups of
bounded size and packed best fit, longest first; then pieces are moved and exchanged
between underfull bins, one for one and two for one, always towards a greater sum of
squared fills, until no such step is left. What lies in bins that stay underfull is dealt anew
into groups and packed again, until one group is left or a round fills no bin. Only lengths
meet in a group, never texts or ids.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.bpe import Vocabulary
from hourloom.llm.common import map_batches, stored, text_slices

CAPACITY = 4096
END_ID = 1
#: Pieces a group holds; the number of groups follows the pieces.
GROUP_PIECES = 20_000

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, place bigint"
_PACKED = f"{_PIECES}, sequence_id bigint, offset bigint, open boolean"


def pieces(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY):
    """doc_id, piece, start, length, ids_crc32 and a place number that deals pieces out evenly.

    A document is its ids and END_ID; a null text is that one id.
    """
    vocabulary = Vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary.load()
        place = TaskContext.get().partitionId() * 7919
        for batch in batches:
            for at, texts in text_slices(batch, "text"):
                rows = []
                for key, ids in zip(batch.column("doc_id").slice(at, len(texts)).to_pylist(), bpe.many(texts)):
                    ids = np.append(ids, END_ID).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        rows.append((key, piece, start, len(part), zlib.crc32(part.tobytes()), place))
                        place += 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "place"])

    wanted = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_batches(wanted, run, _PIECES)


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of item numbers: each item, longest first, goes where it leaves least room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set while some bin has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            place = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, place = capacity, len(bins)
            bins.append([])
        bins[place].append(item)
        if room > length:
            by_room[room - length].append(place)
            rooms |= 1 << (room - length)
    return bins


class Search:
    """Local search over the underfull bins of a group.

    A step takes a bin, fullest first, and fills it further from bins that are no fuller: by
    a whole piece, else by one of its pieces for a longer one, else by one for two of a bin. Every
    step makes the sum of squared fills greater, so the emptiest bins drain away, and the
    search ends by itself. Lengths that bins can give are counted, so the best step of a bin
    is looked up rather than tried.
    """

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], capacity: int):
        self.capacity, self.lengths = capacity, lengths.tolist()
        self.bins = [list(b) for b in bins]
        self.fill = np.array([int(lengths[b].sum()) for b in bins], np.int64)
        # By pieces given, one or two: lengths that each bin can give, as numbers and as bits.
        self.sums: list[list[np.ndarray]] = [[], []]
        self.bits = np.zeros((2, len(bins), capacity // 8 + 1), np.uint8)
        for place in range(len(bins)):
            for k, found in enumerate(self._sums(place)):
                self.sums[k].append(found)
        # The bins that may give now, how many of them give a length, and the greatest length up to each.
        self.giving = np.zeros(len(bins), bool)
        self.count = np.zeros((2, capacity + 1), np.int64)
        self.reach, self.stale = np.zeros((2, capacity + 1), np.int64), False

    def _sums(self, place: int) -> list[np.ndarray]:
        """Lengths that one piece of a bin has, and two together; their bits are set."""
        sizes = [self.lengths[i] for i in self.bins[place]]
        own = np.array(sorted(set(sizes)), np.int64)
        alone = np.zeros(self.capacity + 1, bool)
        alone[own] = True
        both = np.zeros(self.capacity + 1, bool)
        for i in range(1, len(own)):
            both[own[i] + own[:i]] = True
        if len(own) < len(sizes):
            both[[2 * size for size, n in Counter(sizes).items() if n > 1]] = True
        self.bits[:, place] = np.packbits([alone, both], axis=1, bitorder="little")
        return [own, np.flatnonzero(both)]

    def _give(self, places: list[int], gives: bool) -> None:
        if not places:
            return
        for k in (0, 1):
            np.add.at(self.count[k], np.concatenate([self.sums[k][p] for p in places]), 1 if gives else -1)
        self.giving[places], self.stale = gives, True

    def _look(self, target: int) -> None:
        """Let the bins give that hold something and are no fuller than the target."""
        wanted = (self.fill > 0) & (self.fill <= self.fill[target])
        wanted[target] = False
        self._give(np.flatnonzero(wanted & ~self.giving).tolist(), True)
        self._give(np.flatnonzero(self.giving & ~wanted).tolist(), False)
        if self.stale:
            self.stale = False
            self.reach = np.maximum.accumulate(np.where(self.count > 0, np.arange(self.capacity + 1), 0), axis=1)

    def _step(self, target: int) -> bool:
        self._look(target)
        room = self.capacity - int(self.fill[target])
        if whole := int(self.reach[0, room]):
            self._exchange(target, 0, 0, whole)
            return True
        own = self.sums[0][target]
        for k in (0, 1):
            gain = self.reach[k, own + room] - own
            at = int(gain.argmax())
            if gain[at] > 0:
                self._exchange(target, int(own[at]), k, int(own[at] + gain[at]))
                return True
        return False

    def _exchange(self, target: int, mine: int, k: int, theirs: int) -> None:
        """A piece of so many ids, or none, for one or two of a bin, the emptiest that gives them."""
        able = np.flatnonzero((self.bits[k, :, theirs >> 3] >> (theirs & 7) & 1).astype(bool) & self.giving)
        giver = int(able[self.fill[able].argmin()])
        self._give([giver], False)
        taken = self._chosen(giver, k, theirs)
        given = self._chosen(target, 0, mine) if mine else []
        for place, less, more, gain in ((target, given, taken, theirs - mine), (giver, taken, given, mine - theirs)):
            self.bins[place] = [i for i in self.bins[place] if i not in less] + more
            self.fill[place] += gain
            self.sums[0][place], self.sums[1][place] = self._sums(place)

    def _chosen(self, place: int, k: int, total: int) -> list[int]:
        """One item of the bin of that length, or two together."""
        seen: dict[int, int] = {}
        for item in self.bins[place]:
            size = self.lengths[item]
            if k == 0 and size == total:
                return [item]
            if k == 1 and total - size in seen:
                return [seen[total - size], item]
            seen[size] = item
        raise AssertionError("a bin gives what it does not hold")

    def run(self) -> list[list[int]]:
        """Steps until as few bins are left as the pieces need, or no bin has a step left."""
        least, left = -(-int(self.fill.sum()) // self.capacity), int((self.fill > 0).sum())
        moved = True
        while moved and left > least:
            moved = False
            for target in np.argsort(-self.fill, kind="stable").tolist():
                while left > least and 0 < self.fill[target] < self.capacity and self._step(target):
                    moved, left = True, int((self.fill > 0).sum())
        return [b for b in self.bins if b]


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of item numbers, none over the capacity; every item in exactly one."""
    bins = best_fit(lengths, capacity)
    fill = [int(lengths[b].sum()) for b in bins]
    full = [b for b, f in zip(bins, fill) if f == capacity]
    rest = [b for b, f in zip(bins, fill) if f < capacity]
    return full + (Search(lengths, rest, capacity).run() if rest else [])


def _packer(base: int, last: bool, capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["place", "doc_id", "piece"], ignore_index=True)
        lengths = frame["length"].to_numpy()
        bins = pack(lengths, capacity)
        order = np.concatenate([np.array(b) for b in bins])
        number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        ends = np.cumsum(lengths[order])
        begins = ends - lengths[order]
        first = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        out = frame.iloc[order].drop(columns="group")
        out["sequence_id"] = ((base + int(frame["group"].iloc[0])) << 24) + number
        out["offset"] = begins - begins[first][number]
        out["open"] = (np.bincount(number, lengths[order]) < capacity)[number] & (not last)
        return out

    return run


def best_fit_packing(
    docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset; one row per piece.

    Null and empty texts are the end id alone; null and repeated ids are packed row by
    row like others. An empty table gives no rows. Extra columns are not read.
    """
    left = stored(pieces(docs, path, text, doc_id, capacity), "pieces")
    columns = [c for c in left.columns if c != "place"]
    done: DataFrame | None = None
    before, first, level = None, 0, 0
    while True:
        count = left.count()
        groups = max(1, -(-count // group_pieces))
        last = groups == 1 or count == before  # no bin was filled in the last round

        group = F.pmod(F.xxhash64("place", F.lit(level)), F.lit(groups)).alias("group")
        packed = stored(left.select("*", group).groupBy("group").applyInPandas(_packer(first, last, capacity), _PACKED), "packed")
        kept = packed.where("NOT open").select(*columns, "sequence_id", "offset")
        done = kept if done is None else done.unionByName(kept)
        if last:
            return done
        left = packed.where("open").select(*columns, "place")
        before, first, level = count, first + groups, level + 1
