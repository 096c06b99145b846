import hashlib
import zlib

import pytest
from helpers import DOCS, ODD, table
from pyspark.sql import functions as F

from hourloom.llm import merkle
from hourloom.llm.queries import op13_merkle_manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def shown(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return digest(*map(shown, (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def way(levels, i):
    out = []
    for level in levels[:-1]:
        start = i // 16 * 16
        out.append((level[start:i], level[i + 1 : start + 16]))
        i //= 16
    return out


def plain(rows):
    """The query's rows, all levels of all trees at hand."""
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[s] = tree([leaf(r, r[1]) for r in groups[s]])
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            path, text = way(trees[s], i) + way(top, k), r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            node = leaf(r, text)
            for before, after in path:
                node = digest(*before, node, *after)
            proof = digest(*[x for before, after in path for x in before + after])
            out.append((r[0], trees[s][0][i], trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def check(spark, tmp_path, rows, clash=False):
    docs = table(spark, rows, clash)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op13_merkle_manifest(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(plain(rows), key=str)
    return got


def test_odd_rows(spark, tmp_path):
    check(spark, tmp_path, ODD, clash=True)


@pytest.mark.parametrize("sizes", [[1], [16], [17], [1, 2, 15, 16, 17, 255, 256, 257], [4500, 1, 300], [1] * 40])
def test_sizes_of_groups(spark, tmp_path, sizes):
    rows, at = [], 0
    for g, n in enumerate(sizes):
        for _ in range(n):
            rows.append((at * 7 % 100_003, f"Text {at} É", "en", None if g == 1 else f"s{g}", at))
            at += 1
    got = check(spark, tmp_path, rows)
    tampered = [r[0] for r in got if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sorted(r[0] for r in got if not r[6]) == sorted(tampered)


def test_no_rows(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS)).collect() == []


def test_every_second_level_is_stored(spark):
    rows = [(i, "t", "en", "s", 1) for i in range(4500)]
    docs = spark.createDataFrame(rows, DOCS)
    leaves = docs.select(
        F.lit("g").alias("group"), F.col("doc_id").alias("place"), F.lit(4500).cast("long").alias("total"), F.sha2("text", 256).alias("digest")
    )
    built = merkle.build(leaves, "test")
    assert [level.count() for level in built.levels] == [4500, 18, 1]  # 282 and 2 are made again


def test_any_changed_field_is_seen(spark):
    docs = table(spark, [(i, f"text {i}", "en", f"s{i % 3}", i) for i in range(100)])
    for change in ({"lang": F.lit(None)}, {"n_chars": F.col("n_chars") + 1}, {"text": F.concat("text", F.lit(" "))}):
        rows = merkle.manifest(docs, altered=change, when=F.col("doc_id") % 2 == 0).collect()
        assert {r["doc_id"] for r in rows if r["folded_root"] != r["root"]} == set(range(0, 100, 2))
