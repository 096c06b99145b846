import numpy as np
import pytest
from pyspark.sql import functions as F

from hourloom.llm import embedding_dedup as module
from hourloom.llm.embedding_dedup import embedding_dedup, passes_for

NAN, INF = float("nan"), float("inf")


def plain(rows, cosine=0.95):
    """(id, links, component, kept) of each row by comparing all pairs."""

    def fine(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [i for i, (k, v) in enumerate(rows) if k is not None and fine(v)]
    parent = {rows[i][0]: rows[i][0] for i in good}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    links = dict.fromkeys(range(len(rows)), 0)
    for i in good:
        for j in good:
            if i != j and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1], np.float32).astype(float) for k in (i, j))
                a, b = a / abs(a).max(), b / abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                    links[i] += 1
                    x, y = find(rows[i][0]), find(rows[j][0])
                    parent[max(x, y)] = min(x, y)
    return [(k, links[i], find(k) if i in good else k, i not in good or find(k) == k) for i, (k, _) in enumerate(rows)]


def near(base, n, spread, r):
    return [list(map(float, (base + spread * r.standard_normal(len(base))).astype(np.float32))) for _ in range(n)]


def made(seed=0, size=24, alone=150, groups=((2, 0.02), (3, 0.03), (40, 0.04))):
    r = np.random.default_rng(seed)
    vectors = near(np.zeros(size), alone, 1.0, r)
    for n, spread in groups:
        vectors += near(r.standard_normal(size), n, spread, r)
    return [(int(k) * 7, v) for k, v in zip(r.permutation(len(vectors)), vectors)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def found(df, **more):
    return sorted(map(tuple, embedding_dedup(df, **more).collect()), key=str)


def check(spark, rows, **more):
    assert found(frame(spark, rows), **more) == sorted(plain(rows), key=str)


def test_like_all_pairs(spark):
    check(spark, made())


def test_small_windows_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 32)
    check(spark, made(1, groups=((2, 0.02),) * 10 + ((60, 0.05),)), window=8)


def test_a_wide_component(spark, monkeypatch):
    """Core, outer rows and rows that only chains connect, in components above the crowd's size."""
    monkeypatch.setattr(module, "CROWD", 10)
    monkeypatch.setattr(module, "CROWD_BLOCK", 16)
    rows = made(2, groups=((80, 0.15), (30, 0.05), (5, 0.1)))
    turn = [[float(np.cos(t / 5)), float(np.sin(t / 5)), *[0.0] * 22] for t in range(32)]  # a circle: its centre is near zero
    check(spark, rows + [(10_000 + i, v) for i, v in enumerate(turn)] + [(20_000 + i, turn[0]) for i in range(40)])


def test_odd_rows(spark):
    v = [1.0] + [0.0] * 23
    rows = made(3, alone=20) + [
        (-1, None), (-2, []), (-3, [0.0] * 24), (-4, [NAN, *v[1:]]), (-5, [INF, *v[1:]]), (-6, [None, *v[1:]]), (-7, v), (-8, v),
        (-8, v), (None, v), (-9, [3e38] + [0.0] * 23), (-10, [1e-38] + [0.0] * 23), (-11, [-1.0] + [0.0] * 23), (-12, [1.0, 1.0]),
    ]
    check(spark, rows)


def test_rows_of_one_id(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(5, a), (5, b), (7, a), (3, b), (9, [0.0, 0.0, 1.0])]
    assert found(frame(spark, rows)) == sorted(
        [(5, 1, 3, False), (5, 1, 3, False), (7, 1, 3, False), (3, 1, 3, True), (9, 0, 9, True)], key=str
    )


def test_no_rows_and_clashing_columns(spark):
    assert found(frame(spark, [])) == []
    assert found(frame(spark, [(1, None)])) == [(1, 0, 1, True)]
    df = frame(spark, made(4))
    for name in ("id", "vector", "row", "size", "n", "component", "kept", "place", "block", "label"):
        df = df.withColumn(name, F.lit("other"))
    assert found(df) == sorted(plain(made(4)), key=str)


def test_passes_follow_the_rows():
    assert passes_for(0) == passes_for(100) == 1
    counts = [passes_for(n) for n in (1_000, 50_000, 10**9)]
    assert counts == sorted(counts) and counts[-1] < 100


@pytest.mark.parametrize("share", [0.95, 0.96])
def test_recall_at_the_threshold(spark, share):
    """Pairs right at the threshold among many others, windows far smaller than the table."""
    r = np.random.default_rng(9)
    size, n = 32, 400
    a = r.standard_normal((n, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = r.standard_normal((n, size))
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = share + 1e-4
    b = c * a + np.sqrt(1 - c * c) * side
    other = r.standard_normal((3_000, size))
    rows = [(i, list(map(float, v))) for i, v in enumerate(np.concatenate([a, b, other]))]
    linked = {r[0] for r in found(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), window=32) if r[1]}
    assert sum(i in linked and i + n in linked for i in range(n)) >= 0.97 * n
