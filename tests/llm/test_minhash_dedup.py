import random

import numpy as np
from helpers import ODD, linked, shingles, table

from hourloom.llm.graph import components
from hourloom.llm.minhash_dedup import COLLECTIONS, collection_keys, keep_one, near_dedup, shingle_set


def want(docs):
    found = linked([shingles(t) for _, t, *_ in docs])
    sets = [shingles(t) for _, t, *_ in docs]
    out = []
    for (doc_id, *_), s, root in zip(docs, sets, found):
        ids = [d[0] for d, r in zip(docs, found) if r == root and d[0] is not None]
        component = doc_id if not s else min(ids, default=None)
        out.append((doc_id, len(s), component, doc_id == component))
    return out


def compare(spark, docs, **more):
    rows = near_dedup(table(spark, docs, **more)).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows]
    assert sorted(got, key=key) == sorted(want(docs), key=key)


def test_odd_rows(spark):
    compare(spark, ODD, clash=True)
    assert near_dedup(table(spark).limit(0)).count() == 0


def texts(seed, groups, members, words, most_edits):
    """Groups of copies of a text that is not among them, each with edits of its own."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    docs = []
    for _ in range(groups):
        base = [word() for _ in range(words)]
        for _ in range(members):
            text = list(base)
            for _ in range(r.randint(0, most_edits)):
                text[r.randrange(len(text))] = word()
            docs.append((len(docs), " ".join(text), "en", "s", 1))
    r.shuffle(docs)
    return docs


def test_crowded_groups_just_above_and_below_the_limit(spark):
    compare(spark, texts(1, 3, 60, 120, 8))


def test_chains_of_copies(spark):
    r = random.Random(5)
    text = [f"w{r.randrange(10**6)}" for _ in range(100)]
    docs = []
    for i in range(60):
        docs.append((100 - i, " ".join(text), "en", "s", 1))
        text[r.randrange(100)] = f"n{i}"
        text[r.randrange(100)] = f"m{i}"
    compare(spark, docs)


def test_a_passage_that_many_share(spark):
    r = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(60))
    docs = []
    for i in range(120):
        own = " ".join(f"q{r.randrange(10**6)}" for _ in range(r.randint(5, 90)))
        docs.append((i, f"{passage} {own}", "en", "s", 1))
    compare(spark, docs)


def test_collections_agree_as_often_as_sets_are_alike():
    r = np.random.default_rng(0)
    agree = []
    for _ in range(40):
        base = r.integers(0, 2**63, 700).astype(np.uint64)
        keys = collection_keys([np.unique(base[:600]), np.unique(base[100:])])
        agree.append((keys[0] == keys[1]).mean())
    assert abs(np.mean(agree) - (500 / 700) ** 3) < 0.04 and keys.shape[1] == COLLECTIONS


def test_long_texts_cross_blocks():
    text = " ".join(f"w{i}" for i in range(70_000))
    assert len(shingle_set(text, _plain())) == 69_996
    together = collection_keys([shingle_set("a b c d e f", _plain()), shingle_set(text, _plain())])
    assert (collection_keys([shingle_set(text, _plain())])[0] == together[1]).all()


def _plain():
    from hourloom.llm.minhash_dedup import _Words

    return _Words()


def test_components(spark):
    r = random.Random(2)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    parent = list(range(500))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: find(i) for p in pairs if p[0] != p[1] for i in p}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays(spark):
    docs = texts(3, 4, 10, 60, 2) + [r for r in ODD]
    docs = [(d[0] if d[0] is None else d[0] + 1000 * (k >= 40), *d[1:]) for k, d in enumerate(docs)]
    kept = keep_one(table(spark, docs, clash=True)).collect()
    found = linked([shingles(t) for _, t, *_ in docs])
    groups = {r for r, (_, t, *_) in zip(found, docs) if shingles(t)}
    blank = [t for _, t, *_ in docs if not shingles(t)]
    assert len(kept) == len(groups) + len(blank)
    assert sorted(found[[d[1] for d in docs].index(r["text"])] for r in kept if shingles(r["text"])) == sorted(groups)
    assert kept[0]["kept"] == kept[0]["lang"]


def test_texts_asked_for_are_never_left_behind(spark, monkeypatch):
    from pyspark.sql import functions as F

    from hourloom.llm import minhash_dedup

    rows = spark.range(5000).select(F.when(F.col("id") > 0, F.col("id") * 7).alias("doc_id"), F.lit("t").alias("text"))
    asked = rows.where("doc_id IS NULL OR doc_id % 5 = 0").select("doc_id")
    for bits in (1 << 27, 1 << 10, 8):  # a map of few bits leaves more of the others, never fewer of these
        monkeypatch.setattr(minhash_dedup, "MAP_BITS", bits)
        got = minhash_dedup._maybe_among(rows, "doc_id", asked)
        assert got.columns == rows.columns
        assert got.join(asked, got["doc_id"].eqNullSafe(asked["doc_id"]), "left_semi").count() == asked.count()
        assert got.count() <= (1100 if bits > 1 << 20 else 5000)
