import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import ODD, fold, table

import __spark_entry__ as entry
from hourloom.llm import katz, queries

END = "the end"


class Plain:
    """The same model with dictionaries."""

    def __init__(self, texts):
        self.uni, self.big = Counter(), defaultdict(Counter)
        for words in texts:
            self.uni.update(words)
            for v, w in zip([END, *words], words):
                self.big[v][w] += 1
        count = lambda c: np.array([sum(v == r for v in c) for r in range(1, katz.DISCOUNTED + 2)], float)
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.du = katz.discounts(count(list(self.uni.values())))
        self.db = katz.discounts(count([c for b in self.big.values() for c in b.values()]))
        self.unknown = 1 - sum(self.less(c, self.du) for c in self.uni.values()) / self.n if self.n else 1.0
        self.scale = 1.0
        if self.n and self.unknown < 1e-12:
            self.scale, self.unknown = self.n / (self.n + 1), 1 / (self.n + 1)

    @staticmethod
    def less(c, d):
        return c * (d[c - 1] if c <= len(d) else 1)

    def p1(self, w):
        return self.scale * self.less(self.uni[w], self.du) / self.n if self.uni.get(w) else self.unknown

    def p2(self, v, w):
        b = self.big.get(v)
        if not b:
            return self.p1(w)
        total, scale = sum(b.values()), 1.0
        left = 1 - sum(self.less(c, self.db) for c in b.values()) / total
        if left < 1e-12:
            scale, left = total / (total + 1), 1 / (total + 1)
        if w in b:
            return scale * self.less(b[w], self.db) / total
        return left / (1 - sum(self.p1(x) for x in b)) * self.p1(w)


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [END]


def check(spark, docs, sizes=None, **more):
    of = lambda i: fold("null" if i is None else i)
    model = Plain([tokens(t) for i, t, *_ in docs if of(i) != 1])
    want = []
    for i, t, *_ in docs:
        ws = tokens(t)
        base = sum(math.log10((model.uni.get(w, 0) + 0.5) / (model.n + 0.5 * (model.v + 1))) for w in ws)
        score = sum(math.log10(model.p2(v, w)) for v, w in zip([END, *ws], ws))
        known = sum(model.uni.get(w, 0) > 0 for w in ws)
        want.append((i is None, i or 0, of(i) == 1, len(ws), known, model.n, base, score))
    got = [
        (r["doc_id"] is None, r["doc_id"] or 0, *[r[c] for c in ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")])
        for r in katz.katz_of_folds(table(spark, docs, **more), **(sizes or {})).collect()
    ]
    assert len(got) == len(want)
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:6] == b[:6] and a[6:] == pytest.approx(b[6:], rel=1e-9)
    return model


def test_odd_rows(spark):
    check(spark, ODD, clash=True)
    assert katz.katz_of_folds(table(spark).limit(0)).count() == 0


def test_without_training_rows(spark):
    held = [i for i in range(100) if fold(i) == 1][:3]
    check(spark, [(i, "a b a", "", "", 1) for i in held])


def corpus(n):
    r = np.random.default_rng(4)
    return [(i, " ".join(f"w{x}" for x in np.minimum(r.zipf(1.4, r.integers(0, 80)), 400)), "", "", 1) for i in range(n)]


def test_against_dictionaries(spark):
    model = check(spark, corpus(300))
    for v in ("w1", "w2", END, "w399"):
        seen = set(model.uni)
        assert sum(model.p2(v, w) for w in seen) + model.p2(v, "never seen") == pytest.approx(1)


def test_many_chunks_buckets_and_split_contexts(spark):
    check(spark, corpus(300), {"chunk_tokens": 500, "chunk_bytes": 2000, "bucket_pairs": 100, "hot": 200})


@pytest.mark.parametrize("bits", [63, 12])
def test_split_contexts_are_asked_for_in_all_their_buckets(monkeypatch, bits):
    """Also where words and buckets are too many for one sorting key."""
    import pyarrow as pa

    monkeypatch.setattr(katz, "KEY_BITS", bits)

    r = np.random.default_rng(1)
    words = np.sort(r.integers(0, 2**63, 30).astype(np.uint64))
    words = np.r_[words, katz.END]
    codes = np.r_[np.minimum(r.zipf(1.5, 3000) - 1, 29), 30].astype(np.uint32)
    row = pa.table(
        {"chunk": [7], "doc_ids": [[1]], "held": [[False]], "sizes": pa.array([[len(codes)]], pa.list_(pa.int32())),
         "data": [katz.packed(words, codes)]}
    )
    chunk = katz.Chunk(row, 50)
    counts = np.bincount(codes, minlength=31)
    keys, after, place, times = chunk.pairs(counts, 8)
    assert times.sum() == len(codes) and (after[place] == codes).all()
    assert (keys[place] % 31 == np.r_[30, codes[:-1]]).all() and len(set(zip(keys, after))) == len(keys)
    assert sorted(zip(keys.tolist(), after.tolist())) == list(zip(keys.tolist(), after.tolist()))
    wanted, runs = katz._contexts(keys, chunk, counts, 8)
    assert runs.sum() == len(keys)
    several = np.bincount(wanted % 31, minlength=31)
    assert (several == np.where(counts > 0, np.minimum(katz.split_over(counts, 50), 8), 0)).all() and several.max() > 1


def test_words_past_any_fixed_width(monkeypatch):
    """More words than 22 bits count, as one long text may have: no two pairs share a key."""
    import pyarrow as pa

    n = (1 << 22) + 3
    words = np.r_[np.arange(n, dtype=np.uint64) << np.uint64(40), katz.END]
    codes = np.array([n - 1, 1, 0, n - 2, 1, 1, n - 1, 1, n], np.uint32)
    row = pa.table(
        {"chunk": [7], "doc_ids": [[1]], "held": [[False]], "sizes": pa.array([[len(codes)]], pa.list_(pa.int32())),
         "data": [katz.packed(words, codes)]}
    )
    chunk = katz.Chunk(row)
    for buckets in (1, 1 << 20):
        keys, after, place, times = chunk.pairs(np.ones(n + 1, np.int64), buckets)
        pairs = list(zip(np.r_[n, codes[:-1]].tolist(), codes.tolist()))
        assert len(keys) == len(set(pairs)) and list(zip((keys % (n + 1))[place].tolist(), after[place].tolist())) == pairs


def test_packed_arrays_come_back():
    arrays = [np.arange(300, dtype=np.uint32), np.array([], np.float64), np.array([2**64 - 1], np.uint64), np.ones(5, np.uint16)]
    for a, b in zip(arrays, katz.unpacked(katz.packed(*arrays))):
        assert a.dtype == b.dtype and (a == b).all()


def test_discounts():
    d = katz.discounts(np.array([1000.0, 300, 150, 90, 60, 45]))
    assert len(d) == 5 and (0 < d).all() and (d < 1).all()
    assert katz.discounts(np.array([10.0, 0, 0, 0, 0, 0])).tolist() == [0.5]


def test_the_model_beats_the_base(spark):
    import os

    folder = entry.SMOKE_FOLDER
    if not os.path.isdir(folder):
        pytest.skip("the given tables are not here")
    rows = queries.op7_katz(spark, folder).where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
