import zlib

import numpy as np
import pytest
from helpers import ODD, table

from hourloom.llm import packing, queries

tokenizers = pytest.importorskip("tokenizers")
PATH = queries.vocabulary_path()


@pytest.mark.parametrize("seed", range(6))
def test_pack_places_each_piece_once_and_no_worse_than_best_fit(seed):
    r = np.random.default_rng(seed)
    lengths = r.integers(1, 101, 300) if seed % 2 else np.minimum(100, r.lognormal(3, 1, 300).astype(int) + 1)
    bins = packing.pack(lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(300))
    assert all(lengths[b].sum() <= 100 for b in bins)
    assert -(-lengths.sum() // 100) <= len(bins) <= len(packing.best_fit(lengths, 100))


def test_search_exchanges_pieces_until_a_bin_empties():
    lengths = np.array([6, 3, 5, 4, 2])  # 6 + 3 and 5 + 4 leave the 2 alone; 6 + 4 and 5 + 3 + 2 do not
    bins = packing.Search(lengths, [[0, 1], [2, 3], [4]], 10).run()
    assert len(bins) == 2 and all(lengths[b].sum() == 10 for b in bins)


def step_left(lengths, bins, capacity):
    """Whether a bin can be filled further from one no fuller, by brute force."""
    held = [lengths[b].tolist() for b in bins]
    for target in held:
        room = capacity - sum(target)
        for other in held:
            if other is target or sum(other) > sum(target):
                continue
            given = other + [x + y for i, x in enumerate(other) for y in other[:i]]
            if any(x <= room for x in other) or any(0 < x - mine <= room for x in given for mine in target):
                return True
    return False


@pytest.mark.parametrize("seed", range(3))
def test_search_ends_only_where_no_step_is_left(seed):
    lengths = np.random.default_rng(seed).integers(22, 64, 400)
    bins = packing.pack(lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(400))
    assert len(bins) == -(-lengths.sum() // 100) or not step_left(lengths, bins, 100)


def test_search_saves_bins_that_best_fit_needs():
    lengths = np.random.default_rng(0).integers(600, 1300, 2000)
    assert len(packing.pack(lengths)) < 0.97 * len(packing.best_fit(lengths))


def test_rounds_go_on_while_bins_are_filled(spark, monkeypatch):
    counts = []

    def stored(df, label, keep=packing.stored):
        made = keep(df, label)
        if label == "packed":
            counts.append((made.count(), made.selectExpr("sequence_id >> 24").distinct().count()))
        return made

    monkeypatch.setattr(packing, "stored", stored)
    docs = [(i, "a " * (20 + i * 37 % 41), "en", "s", 1) for i in range(400)]
    rows = packing.best_fit_packing(table(spark, docs), PATH, capacity=64, group_pieces=25).collect()
    check(rows, docs, 64)
    assert len(counts) > 1 and (counts[-1][1] == 1 or counts[-1][0] == counts[-2][0])


def check(rows, docs, capacity):
    library = tokenizers.Tokenizer.from_file(PATH)
    want = []
    for doc_id, text, *_ in docs:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            want.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=key) == sorted(want, key=key)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), -(-sum(w[3] for w in want) // capacity)


@pytest.mark.parametrize("capacity,group", [(4096, 20_000), (64, 40)])
def test_documents_are_whole_in_sequences(spark, capacity, group):
    rows = packing.best_fit_packing(table(spark, clash=True), PATH, capacity=capacity, group_pieces=group).collect()
    used, least = check(rows, ODD, capacity)
    assert used <= least + 2


def test_groups_meet_again_until_few_bins_are_open(spark):
    docs = [(i, "a " * (1 + i * 37 % 61), "en", "s", 1) for i in range(400)]
    rows = packing.best_fit_packing(table(spark, docs), PATH, capacity=64, group_pieces=50).collect()
    used, least = check(rows, docs, 64)
    assert used <= least + 5


def test_empty_table(spark):
    assert packing.best_fit_packing(table(spark).limit(0), PATH).count() == 0
