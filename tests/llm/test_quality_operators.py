import os

import numpy as np
import pytest
from compare import connect, differences
from helpers import ODD, table

import __spark_entry__ as entry
from hourloom.llm import quality_classifier as qc
from hourloom.llm import quality_rules as qr
from hourloom.llm import queries

FOLDER = entry.SMOKE_FOLDER
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


def brute(text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    at = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(words) < 3000 else None
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words),
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(words) if at is None else len(at),
    )


def test_counts_of_odd_rows(spark):
    docs = [*ODD, (20, "a b c a b c", "", "", 1), (21, "a a a a", "", "", 1), (22, "a b c d b c d x", "", "", 1),
            (23, "x\n\n \nx\nx y#\n", "", "", 1), (24, "|" * 10 + "\x1c ", "", "", 1)]
    rows = qr.quality_rules(table(spark, docs, clash=True)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    key = lambda r: tuple((x is None, str(x)) for x in r)
    got = [(r["doc_id"], *[r[f"qr_{n}"] for n in names]) for r in rows]
    assert sorted(got, key=key) == sorted([(d[0], *brute(d[1])) for d in docs], key=key)
    assert not any(r["qr_kept"] for r in rows) and {r["kept"] for r in rows} <= {"en", "de", "", None}
    assert qr.quality_rules(table(spark).limit(0)).count() == 0


def test_rules_are_one_native_projection(spark):
    plan = qr.quality_rules(table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_a_filter_stays_above_the_measures(spark):
    docs = table(spark)
    kept = qr.quality_rules(docs).where("qr_kept").select(*docs.columns)
    assert len(kept._jdf.queryExecution().optimizedPlan().toString()) < 30_000
    assert kept.count() == 0


def test_thresholds_are_compiled(spark):
    words = " ".join(["the"] + [f"word{i}" for i in range(80)])
    docs = table(spark, [(1, words, "", "", 1), (2, words.replace("w", "#w"), "", "", 1)])
    rules = lambda t: {r["doc_id"]: r["qr_kept"] for r in qr.quality_rules(docs, thresholds=t).collect()}
    assert rules([("symbols_per_word", None, 0.5)]) == {1: True, 2: False}
    assert rules([("symbols_per_word", 0.5, None), ("n_words", 1, 100)]) == {1: False, 2: True}
    assert rules([]) == {1: True, 2: True}


@given
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_against_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.SQL[name]) == []


# Classifier


def test_label_model_finds_accuracies():
    r = np.random.default_rng(1)
    truth = r.random(20_000) < 0.8
    right = np.linspace(0.65, 0.95, len(qc.LABELLERS))
    cast = r.random((len(truth), len(right))) < 0.7
    vote = np.where(r.random(cast.shape) < right, truth[:, None], ~truth[:, None])
    votes = np.where(cast, 2 * vote, 1)
    patterns, counts = np.unique((votes * 3 ** np.arange(len(right))).sum(1), return_counts=True)
    model = qc.LabelModel(patterns, counts.astype(float))
    assert abs(model.prior[1] - 0.8) < 0.05 and np.abs(model.accuracies() - right).max() < 0.05
    guess = model.posterior((votes * 3 ** np.arange(len(right))).sum(1)) > 0.5
    assert (guess == truth).mean() > 0.97


def test_measures_one_text_at_a_time_or_many():
    texts = [r[1] or "" for r in ODD]
    many, reader = qc.Reader().many(texts), qc.Reader()
    for a, b in zip(many, [reader.many([t])[0] for t in texts]):
        assert (a is None) == (b is None)
        if a is not None:
            assert all(np.allclose(x, y) for x, y in zip(a, b))


def test_classifier_on_odd_rows(spark):
    docs = table(spark, clash=True)
    rows = qc.classify(docs).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] == 0 for r in rows if not (r["text"] or "").split())
    assert {r["kept"] for r in rows} <= {"en", "de", None}
    assert qc.classify(docs.limit(0)).count() == 0


@given
def test_classifier_agrees_with_labels_it_has_not_seen(spark):
    folder = FOLDER.replace("0.001", "0.01")
    scored = queries.op8_quality_classifier(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = scored.select("kept", "quality").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.1
