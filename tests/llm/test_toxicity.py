import os

import numpy as np
import pytest
from helpers import ODD, fold, table

import __spark_entry__ as entry
from hourloom.llm import queries
from hourloom.llm import toxicity as tx

FOLDER = entry.SMOKE_FOLDER.replace("0.001", "0.1")
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


def test_gradient():
    network, r = tx.Network(1), np.random.default_rng(0)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    x, at = r.standard_normal((5, tx.INPUT)), r.integers(0, 5, (3, tx.WINDOW))
    there = np.ones((3, tx.WINDOW))
    there[1, 20:] = 0
    y = np.array([1.0, 0, 1])

    def loss():
        p = 1 / (1 + np.exp(-network.logits(network.gates(x), at, there)))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    g = network.gradient(x, at, there, y, np.ones(3))
    for name in ("u", "v", "c", "whf", "wxf", "bxf", "whb", "wxb", "bxb"):
        place = tuple(r.integers(0, n) for n in network.p[name].shape)
        network.p[name][place] += 1e-4
        up = loss()
        network.p[name][place] -= 2e-4
        down = loss()
        network.p[name][place] += 1e-4
        assert abs((up - down) / 2e-4 - g[name][place]) < 1e-5


def test_fast_pass_is_the_same_pass():
    network, r = tx.Network(1), np.random.default_rng(0)
    gx = network.gates(r.standard_normal((9, tx.INPUT)).astype(np.float32))
    at = r.integers(0, 9, (40, tx.WINDOW))
    there = (np.arange(tx.WINDOW) < r.integers(1, tx.WINDOW + 1, 40)[:, None]).astype(np.float32)
    assert np.allclose(network.logits(gx, at, there), network.logits(gx, at, there, {}), atol=1e-5)


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 60, 61, 88, 89, 500])
def test_windows_cover_every_word(n):
    place, there, _ = tx.window_table(np.array([n]))
    assert sorted(set(place[there].tolist())) == list(range(n)) and len(place) >= 1


@pytest.mark.parametrize("n", [17, 33, 47, 48, 49, 60, 200])
def test_passages_lie_whole_in_a_window(n):
    starts = tx.windows(n)
    assert starts[-1] == max(0, n - tx.WINDOW)
    for at in range(n - 16):
        assert any(s <= at and at + 17 <= s + tx.WINDOW for s in starts.tolist())


def made(seed, n):
    """Texts whose toxicity is a word, or a stem with any ending, at any place."""
    r = np.random.default_rng(seed)
    known = ["".join(np.random.default_rng(i).choice(list("abcdeimnorst"), 5)) for i in range(400)]
    word = lambda: known[r.integers(0, 400)]
    texts, toxic = [], []
    for i in range(n):
        words = [word() for _ in range(r.integers(20, 200))]
        label = i % 3 == 0
        if label:
            at = r.integers(0, len(words))
            words[at] = ("Vile!!" if r.random() < 0.5 else f"xqu{word()}").upper() if r.random() < 0.3 else f"xqu{word()}"
        texts.append(" ".join(words))
        toxic.append(int(label))
    return texts, np.array(toxic)


def test_learns_words_and_stems_at_any_place():
    network = tx.train(*made(0, 600))
    texts, toxic = made(1, 300)
    scores = tx.Scorer(network).many(texts)
    assert (scores[toxic == 1] >= 0.5).mean() > 0.9 and (scores[toxic == 0] >= 0.5).mean() < 0.05
    alone = np.array([tx.Scorer(network).many([t])[0] for t in texts[:20]])
    assert np.allclose(alone, scores[:20], atol=1e-5)


@pytest.mark.parametrize("n", [1, 64, 65, 112, 113, 1000])
def test_parts_of_a_word_hold_every_sequence(n):
    word = "".join(np.random.default_rng(n).choice(list("abcdefgh"), n))
    parts = tx.steps(f"a {word} b")[1:-1]
    assert max(map(len, parts)) <= tx.PART
    assert {word[i : i + 16] for i in range(n - 15)} <= {p[i : i + 16] for p in parts for i in range(len(p) - 15)}
    assert parts[0][: min(n, 64)] == word[:64] and word.endswith(parts[-1])


def test_toxic_letters_deep_in_a_text_without_spaces():
    network = tx.train(*made(0, 600))
    clean, found = made(1, 90)
    clean = ["_".join(t.split()) for t, toxic in zip(clean, found) if not toxic]
    toxic = [f"{t[: len(t) // 2]}_xquabcde_{t[len(t) // 2 :]}" for t in clean]
    assert min(len(t) // 2 for t in toxic) >= 50
    scores = tx.Scorer(network).many([*clean, *toxic])
    assert (scores[len(clean) :] >= 0.5).mean() > 0.9 and (scores[: len(clean)] >= 0.5).mean() < 0.1


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_only_the_training_fold_is_learnt_from(spark):
    docs = table(spark, [(i, f"text {i}", "", "", 1) for i in range(60)])
    labels = labels_of(spark, [(i, 1, i % 2) for i in range(50)] + [(51, 1, None), (None, 1, 1), (999, 1, 1), (1, 0, 0)])
    texts, toxic = tx.training_rows(docs, labels)
    taken = [i for i in range(50) if fold(i)]
    assert sorted(texts) == sorted(f"text {i}" for i in taken)
    assert all(toxic[texts.index(f"text {i}")] == i % 2 for i in taken)
    assert len(tx.training_rows(docs, labels, (3, 5))[0]) == 8


def test_odd_rows(spark):
    labels = labels_of(spark, [(5, 1, 1), (6, 1, 0), (7, 1, 0), (8, 1, 0), (9, 0, 1)])
    rows = tx.toxicity(table(spark, clash=True), labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (fold("null" if r["doc_id"] is None else r["doc_id"]) == 0) for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert tx.toxicity(table(spark).limit(0), labels).count() == 0
    alike = tx.toxicity(table(spark), labels.limit(0)).collect()
    assert len({r["score"] for r in alike}) == 1 and not any(r["predicted"] for r in alike)


@given
def test_held_out_accuracy(spark):
    found = queries.op6_toxicity(spark, FOLDER).where("held_out").join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id")
    rows = found.select("predicted", "toxic").collect()
    hit = [r["predicted"] for r in rows if r["toxic"]]
    false = [r["predicted"] for r in rows if not r["toxic"]]
    assert sum(hit) / len(hit) > 0.5 and sum(false) / len(false) < 0.02
