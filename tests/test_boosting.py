import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_forecast import AS_OF, _future, _history, _history_rows, cal  # noqa: F401

from hourloom.plans.boosting import bin_edges, train_boosted, with_prediction
from hourloom.plans.forecast import FEATURES, forecast

NAN = float("nan")


def _frame(spark, x, y, parts=3):
    rows = [(*[None if math.isnan(v) else float(v) for v in row], float(t)) for row, t in zip(x, y)]
    schema = ", ".join(f"f{i} double" for i in range(x.shape[1])) + ", y double"
    return spark.createDataFrame(rows, schema).repartition(parts)


def _made(n=300, seed=0):
    r = np.random.default_rng(seed)
    x = r.integers(0, 9, (n, 3)).astype(float)
    x[r.random((n, 3)) < 0.2] = NAN
    y = np.where(np.isnan(x[:, 0]), 50, x[:, 0]) + 10 * (np.nan_to_num(x[:, 1], nan=2) > 4) + r.integers(0, 3, n)
    return x, y


def _plain_tree(x, residual, edges, depth, ridge=1.0):
    """Predictions of one tree by trying every cut on all rows."""
    if depth:
        g, n, best, most = residual.sum(), len(x), None, 0.0
        for f, cuts in enumerate(edges):
            for edge in [*cuts, math.inf]:
                for side in (True, False):
                    left = np.where(np.isnan(x[:, f]), side, x[:, f] <= edge)
                    if left.any() and not left.all():
                        a, b = residual[left].sum(), residual[~left].sum()
                        gain = a * a / (left.sum() + ridge) + b * b / ((~left).sum() + ridge) - g * g / (n + ridge)
                        if gain > most:
                            best, most = left, gain
        if best is not None:
            out = np.zeros(n)
            for part in (best, ~best):
                out[part] = _plain_tree(x[part], residual[part], edges, depth - 1, ridge)
            return out
    return np.full(len(x), residual.sum() / (len(x) + ridge))


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_a_tree_like_trying_every_cut(spark, depth):
    x, y = _made()
    edges = [[1, 3, 5], [2, 4, 6], [0, 7]]
    model = train_boosted(
        _frame(spark, x, y), ["f0", "f1", "f2"], "y", 1, depth, 1.0, edges={f"f{i}": e for i, e in enumerate(edges)}, base=0.0, scale=1.0
    )
    assert np.allclose(model.predict(x), _plain_tree(x, y, edges, depth))


def test_missing_values_that_carry_the_signal(spark):
    x = np.array([[NAN if i % 3 == 0 else i, i % 5] for i in range(90)], float)
    y = np.where(np.isnan(x[:, 0]), 100.0, 0.0)
    model = train_boosted(_frame(spark, x, y), ["f0", "f1"], "y", 1, 1, 1.0, ridge=0.0)
    tree = model.trees[0]
    assert tree.feature[0] == 0 and tree.edge[0] == math.inf and not tree.missing_left[0]
    assert np.allclose(model.predict(x), y)
    assert np.allclose(model.predict(np.array([[NAN, NAN], [1e9, NAN]])), [100, 0])


def test_many_trees_fit_and_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr("hourloom.plans.boosting.KEEP", 4)
    x, y = _made(400, 1)
    models = [train_boosted(_frame(spark, x, y, parts), ["f0", "f1", "f2"], "y", 10, 3, 0.3) for parts in (1, 5)]
    a, b = (m.predict(x) for m in models)
    assert (a == b).all() and len(models[0].trees) == 10
    assert np.mean((a - y) ** 2) < 0.1 * np.var(y)
    got = with_prediction(_frame(spark, x, y).withColumn("other", F.lit("kept")), models[0]).collect()
    assert {r["other"] for r in got} == {"kept"}
    key = lambda v: tuple(-1.0 if u is None or u != u else u for u in v)
    assert sorted((key((r["f0"], r["f1"], r["f2"])), r["prediction"]) for r in got) == sorted(
        (key(row), p) for row, p in zip(x, a)
    )


def test_odd_rows(spark):
    schema = "f0 double, f1 int, y double"
    none = train_boosted(spark.createDataFrame([], schema), ["f0", "f1"], "y")
    assert none.trees == () and none.base == 0.0
    rows = spark.createDataFrame([(None, None, 5.0), (NAN, 1, None), (NAN, 2, 5.0), (None, None, NAN)], schema)
    model = train_boosted(rows, ["f0", "f1"], "y", 2, 2)
    assert model.base == 5.0 and np.allclose(model.predict(np.full((1, 2), NAN)), 5.0)
    assert bin_edges(rows.where("y < 0"), ["f0", "f1"]) == {"f0": [], "f1": []}
    assert with_prediction(rows.limit(0), model).count() == 0


def test_forecast_in_batches_like_column_by_column(spark, cal):  # noqa: F811
    """The recursion in Arrow batches, beside the one that asks a column for each day."""
    r = np.random.default_rng(5)
    rows = [tuple(None if v < 0.2 else float(10 * v) for v in r.random(len(FEATURES))) + (float(r.integers(0, 99)),) for _ in range(200)]
    model = train_boosted(spark.createDataFrame(rows, ", ".join(f"{c} double" for c in (*FEATURES, "y"))), FEATURES, "y", 5, 3, 0.5)
    gaps = {(1, n, h) for n in range(1, 8) for h in (3, 4)} | {(2, 1, 5)}
    history, future = _history(spark, cal, _history_rows(gaps)), _future(spark, cal)
    whole = forecast(model, history, future, AS_OF, ["site"], days=9)
    each = forecast(lambda df: with_prediction(df.coalesce(1), model), history, future, AS_OF, ["site"], days=9)
    columns = ["site", "prediction_date", "prediction_hour", "prediction"]
    a, b = (sorted(tuple(row[c] for c in columns) for row in df.collect()) for df in (whole, each))
    assert len(a) == len(b) > 0 and [x[:3] for x in a] == [x[:3] for x in b]
    assert np.allclose([x[3] for x in a], [x[3] for x in b])
    assert isinstance(a[0][1], dt.date)
