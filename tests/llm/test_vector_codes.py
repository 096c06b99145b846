import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourloom.llm.vector_codes import hex_code, nearest, vector_codes, with_total

NAN, INF = float("nan"), float("inf")


def plain(rows, parts=8, entries=16, rounds=6):
    """{row number: (entries, error)} and the digest, every part compared with every entry."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    x = np.array([np.floor(np.array(r[1], np.float32).astype(float) * 4096) for r in rows], np.int64)
    x = x.reshape(len(rows), parts, -1)
    books = [x[order[:entries], p].copy() for p in range(parts)]
    for turn in range(rounds + 1):
        far = [((x[:, p, None] - books[p][None]) ** 2).sum(2) for p in range(parts)]
        best = [d.argmin(1) for d in far]
        if turn < rounds:
            for p in range(parts):
                for e in set(best[p]):
                    books[p][e] = x[best[p] == e, p].sum(0) // (best[p] == e).sum()
    text = ",".join(str(v) for b in books for v in b.ravel())
    found = {
        i: ("".join(f"{best[p][i]:02x}" for p in range(parts)), int(sum(far[p][i].min() for p in range(parts))))
        for i in range(len(rows))
    }
    return found, hashlib.sha256(text.encode()).hexdigest()


def made(n, size=16, seed=0, grid=None):
    r = np.random.default_rng(seed)
    x = r.integers(-grid, grid + 1, (n, size)) / 4096 if grid else r.standard_normal((n, size))
    return [(int(i), [float(np.float32(v)) for v in row]) for i, row in zip(r.permutation(n) * 3, x)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, label string")


def check(spark, rows, more=()):
    codes = vector_codes(frame(spark, [*rows, *more]), carry=["label"])
    got = codes.rows.select("vec_id", hex_code(F.col("entries")).alias("code"), "error", "label").collect()
    want, digest = plain(rows)
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["code"], r["error"]) for r in got) == sorted(
        (rows[i][0] is None, rows[i][0] or 0, *want[i]) for i in want
    )
    assert codes.digest() == digest and {r["label"] for r in got} <= {"x"}


def test_like_a_full_scan(spark):
    check(spark, made(400))


def test_ties_go_to_the_lower_index(spark):
    # Few distinct components: entries coincide, and many distances are equal.
    check(spark, made(300, grid=1))
    check(spark, [(i, [0.0] * 8) for i in range(40)])


def test_odd_rows(spark):
    rows = made(60)
    rows += [rows[0], rows[0], (rows[1][0], rows[2][1]), (None, rows[3][1])]
    bad = [(1, None), (2, [NAN] + [0.0] * 15), (4, [INF] + [0.0] * 15), (5, [None] + [0.0] * 15), (7, []), (8, [0.5] * 3)]
    check(spark, rows, [(i + 1000, v) for i, v in bad])
    check(spark, rows, [(-1, [0.5] * 3), (2000, [0.5] * 8)])  # lengths: no multiple, and not that of the smallest id


def test_fewer_rows_than_entries_and_none(spark):
    check(spark, made(5))
    none = vector_codes(frame(spark, []), carry=["label"])
    assert none.rows.count() == 0 and none.digest() == hashlib.sha256(b"").hexdigest()


def test_too_large_components_fail(spark):
    with pytest.raises(Exception, match="do not fit"):
        vector_codes(frame(spark, [(1, [40000.0] * 8)])).rows.count()


def test_only_moved_entries_are_compared():
    r = np.random.default_rng(3)
    x, book = r.integers(-5, 6, (500, 2)), r.integers(-5, 6, (7, 2))
    entry, distance = np.zeros(500, np.int64), np.zeros(500, np.int64)
    nearest(x, book, None, entry, distance)
    for _ in range(20):
        moved = r.random(7) < 0.4
        book = np.where(moved[:, None], r.integers(-5, 6, (7, 2)), book)
        nearest(x, book, moved, entry, distance)
        d = ((x[:, None] - book[None]) ** 2).sum(2)
        assert (entry == d.argmin(1)).all() and (distance == d.min(1)).all()


def test_clashing_columns(spark):
    df = frame(spark, made(30))
    for name in ("id", "carried", "vector", "entries", "distances", "sums", "error"):
        df = df.withColumn(name, F.lit("other"))
    codes = vector_codes(df, carry=["label"])
    assert codes.rows.count() == 30 and codes.digest() == plain(made(30))[1]


def test_totals_of_labels(spark, monkeypatch):
    df = spark.createDataFrame([(i, None if i % 3 else i % 2, i) for i in range(100)], "i bigint, label int, error bigint")
    want = {}
    for r in df.collect():
        want[r["label"]] = want.get(r["label"], 0) + r["error"]
    for small in (True, False):
        monkeypatch.setattr("hourloom.llm.vector_codes.is_small", lambda _: small)
        got = with_total(df, "label", "error", "total").collect()
        assert len(got) == 100 and all(r["total"] == want[r["label"]] for r in got)
