import hashlib
import random
import re

from helpers import ODD, table

from hourloom.llm.exact_dedup import CuckooFilter, LiveIndex, digested, exact_dedup, maintain


def digests(n, seed=0):
    return [hashlib.sha256(f"{seed}-{i}".encode()).digest() for i in range(n)]


def test_filter_inserts_and_deletes():
    f, some = CuckooFilter(256), digests(600)
    assert all(f.insert(d) for d in some) and all(d in f for d in some)
    assert all(f.delete(d) for d in some[:300]) and all(d in f for d in some[300:])
    assert sum(d in f for d in digests(2000, 1)) < 40 and f.size == 300


def test_filter_that_is_full_says_so():
    f = CuckooFilter(2)
    assert not all(f.insert(d) for d in digests(20))


def test_index_grows_from_its_stored_keys():
    index, live = LiveIndex(), {}
    r = random.Random(3)
    for i, d in enumerate(digests(6000)):
        index.put(d, (i, 1, 1))
        live[d] = (i, 1, 1)
        if r.random() < 0.3:
            gone = r.choice(list(live)[-50:])
            index.drop(gone)
            del live[gone]
    assert index.resized and index.entries == live
    assert all(index.find(d) == e for d, e in live.items())
    assert all(index.find(d) is None for d in digests(3000, 9))


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t, *_ in rows]
    out = []
    for (doc_id, text, *_), n in zip(rows, norm):
        group = [(-len(t or ""), i is None, i or 0, i) for (i, t, *_), m in zip(rows, norm) if m == n]
        out.append((doc_id, min(group)[3], len(group), hashlib.sha256(n.encode()).hexdigest()))
    return out


def test_odd_rows(spark):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    rows = exact_dedup(table(spark, clash=True)).collect()
    got = [(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows]
    assert sorted(got, key=key) == sorted(brute(ODD), key=key)
    kept = [r for r in rows if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in rows})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    assert exact_dedup(table(spark).limit(0)).count() == 0


def test_longest_original_stays_then_the_smallest_id(spark):
    docs = [(3, "a b", "", "", 0), (2, "a  b", "", "", 0), (1, "ab", "", "", 0), (9, "a\t\nb", "", "", 0)]
    assert [r["doc_id"] for r in exact_dedup(table(spark, docs)).collect() if r["kept"]] == [2]


def test_digests_deleted_and_rows_added_again(spark):
    docs = table(spark, [(i, f"text {i % 4}", "", "", 0) for i in range(12)])
    rows = digested(docs)
    index = maintain(None, rows, buckets=3)
    gone = rows.where("doc_id IN (0, 1)")
    affected = rows.join(gone.select("digest"), "digest", "left_semi")
    left = affected.where("doc_id NOT IN (0, 1)")
    after = maintain(index, left, gone.select("digest").distinct(), buckets=3)
    want = maintain(None, rows.where("doc_id NOT IN (0, 1)"), buckets=5)
    assert sorted(map(tuple, after.collect())) == sorted(map(tuple, want.collect()))


def test_a_hot_text_is_one_row_per_batch(spark):
    docs = table(spark, [(i, "hot" if i % 3 else f"cold {i}", "", "", 0) for i in range(3000)])
    rows = exact_dedup(docs).collect()
    hot = [r for r in rows if r["group_size"] == 2000]
    assert len(hot) == 2000 and sum(r["kept"] for r in hot) == 1 and hot[0]["keep_id"] == 1
