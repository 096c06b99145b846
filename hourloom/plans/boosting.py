"""Boosted regression trees that learn where missing values go.

Values are counted by bins, whose edges are quantiles of each input. A level of a tree is one
pass over the rows: every task walks its rows down the tree as it is so far and adds up, per open
node, input and bin, the residuals and the rows; Spark sums these, and the driver sees nodes x inputs x
bins numbers, whatever the rows are. Each cut is tried with the missing values on either
side, and, apart from all cuts, the present values against the missing ones.

Residuals are added up as integers, scaled so that all sums fit a double exactly. So the trees do
not depend on how rows are dealt to tasks, and a task that is run again changes nothing.
The table of binned rows is written to the shared folder; every ``KEEP`` trees it is written again with
the scores so far, which bounds what a pass has to work out, and the one before is deleted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.shared import discard, map_batches, written_at

# Model settings.
TREES, DEPTH, RATE, RIDGE = 200, 8, 0.05, 1.0
BINS = 64
#: Trees after which scores are stored with the rows.
KEEP = 4
_EXACT = 52  # bits that sums may take
_ROWS = "bins array<smallint>, y double, score double"


@dataclass(frozen=True)
class Tree:
    """Nodes by number. ``left`` is 0 at a leaf, else the left child's number, the right one's being
    the next. A present value goes left up to ``edge``, a missing one where ``missing_left`` says."""

    feature: np.ndarray
    cut: np.ndarray
    edge: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def leaves(self, x: np.ndarray, missing: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """The node of each row; x is compared with ``limit`` per node."""
        at, rows = np.zeros(len(x), np.int32), np.arange(len(x))
        while (inner := self.left[at] > 0).any():
            f = self.feature[at]
            goes_left = np.where(missing[rows, f], self.missing_left[at], x[rows, f] <= limit[at])
            at = np.where(inner, self.left[at] + ~goes_left, at)
        return at


@dataclass(frozen=True)
class Boosted:
    """A model: a base value, and trees whose values are added."""

    features: tuple[str, ...]
    base: float
    trees: tuple[Tree, ...]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Rows x features; NaN is missing."""
        missing, out = np.isnan(x), np.full(len(x), self.base)
        for tree in self.trees:
            out += tree.value[tree.leaves(x, missing, tree.edge)]
        return out


def bin_edges(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Quantiles of each input, all from one pass; few distinct values give few edges.

    The greatest value is none: nothing present lies above it.
    """
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    quantiles = [F.percentile_approx(_number(c), shares, F.lit(10_000)).alias(f"q{i}") for i, c in enumerate(features)]
    found = rows.agg(*quantiles, *[F.max(_number(c)).alias(f"m{i}") for i, c in enumerate(features)]).first()
    return {c: sorted(x for x in set(found[f"q{i}"] or []) if x < found[f"m{i}"]) for i, c in enumerate(features)}


def _number(name: str):
    """An input as a number; NaN is missing."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None))


def _binned(edges: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, found = batch.num_rows, []
            for i, at in enumerate(edges):
                x = batch.column(i).to_numpy(zero_copy_only=False).astype(float)
                found.append(np.where(np.isnan(x), -1, np.searchsorted(at, x, side="left")).astype(np.int16))
            ends = np.arange(0, n * len(edges) + 1, len(edges), dtype=np.int32)
            bins = pa.ListArray.from_arrays(ends, pa.array(np.stack(found, axis=1).ravel()))
            yield pa.RecordBatch.from_arrays([bins, batch.column("y"), batch.column("score")], names=["bins", "y", "score"])

    return run


def _scored(batch: pa.RecordBatch, width: int, trees: Sequence[Tree]):
    """Bins, labels, and the scores after some more trees."""
    bins = batch.column("bins").flatten().to_numpy().reshape(batch.num_rows, width)
    score = batch.column("score").to_numpy().copy()
    for tree in trees:
        score += tree.value[tree.leaves(bins, bins < 0, tree.cut)]
    return bins, batch.column("y").to_numpy(), score


def _with_scores(width: int, trees: Sequence[Tree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _scored(batch, width, trees)[2]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(score)], names=["bins", "y", "score"])

    return run


def _counted(width: int, slots: int, since: Sequence[Tree], tree: Tree, open_nodes: np.ndarray, scale: float):
    """Sums per open node, input and bin (the first for missing values), one set per task."""
    place = np.full(len(tree.left), -1)
    place[open_nodes] = np.arange(len(open_nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(open_nodes) * width * slots
        total, rows = np.zeros(size), np.zeros(size, np.int64)
        for batch in batches:
            bins, y, score = _scored(batch, width, since)
            node = place[tree.leaves(bins, bins < 0, tree.cut)]
            live = node >= 0
            at = ((node[live, None] * width + np.arange(width)) * slots + bins[live] + 1).ravel()
            residual = np.rint((y - score)[live] * scale)
            total += np.bincount(at, np.repeat(residual, width), size)
            rows += np.bincount(at, minlength=size)
        some = np.flatnonzero(rows)
        columns = [pa.array(some), pa.array(total[some].astype(np.int64)), pa.array(rows[some])]
        yield pa.RecordBatch.from_arrays(columns, names=["slot", "g", "n"])

    return run


def _best(g: np.ndarray, n: np.ndarray, sizes: Sequence[int], ridge: float):
    """(feature, cut, missing left) with the greatest gain at a node, or None.

    g and n by input and bin, missing values first. Ties go to the first input, cut and missing left.
    """
    whole, rows = g[0].sum(), n[0].sum()
    best, most = None, 0.0
    for f, size in enumerate(sizes):
        below, count = np.cumsum(g[f, 1 : size + 2]), np.cumsum(n[f, 1 : size + 2])
        gains = []
        for more, less in ((g[f, 0], n[f, 0]), (0.0, 0)):  # missing values left, or right
            left, there = below + more, count + less
            right, other = whole - left, rows - there
            with np.errstate(divide="ignore", invalid="ignore"):  # an empty side, which is no cut
                gain = left * left / (there + ridge) + right * right / (other + ridge) - whole * whole / (rows + ridge)
            gains.append(np.where((there > 0) & (other > 0), gain, 0.0))
        both = np.stack(gains, axis=1)
        at = int(both.argmax())
        if both.ravel()[at] > most:
            best, most = (f, at // 2, at % 2 == 0), both.ravel()[at]
    return best


def _grown(rows: DataFrame, since: Sequence[Tree], edges: list[np.ndarray], depth: int, ridge: float, scale: float, rate: float) -> Tree:
    sizes, width = [len(e) for e in edges], len(edges)
    slots = max(sizes) + 2
    feature, cut, edge, missing, left, value = [0], [0], [0.0], [True], [0], [0.0]
    open_nodes = [0]
    for _ in range(depth):
        tree = _as_tree(feature, cut, edge, missing, left, value)
        make = _counted(width, slots, since, tree, np.array(open_nodes), scale)
        sums = map_batches(rows, make, "slot bigint, g bigint, n bigint").groupBy("slot").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
        g, n = np.zeros((2, len(open_nodes) * width * slots))
        for slot, a, b in sums.collect():
            g[slot], n[slot] = a, b
        g, n = (x.reshape(len(open_nodes), width, slots) for x in (g, n))
        following = []
        for i, node in enumerate(open_nodes):
            if node == 0 and depth:  # the root's own value, should nothing split
                value[0] = rate * g[i, 0].sum() / (n[i, 0].sum() + ridge) / scale
            if (found := _best(g[i], n[i], sizes, ridge)) is None:
                continue
            f, c, goes_left = found
            feature[node], cut[node], missing[node], left[node] = f, c, goes_left, len(left)
            edge[node] = edges[f][c] if c < sizes[f] else math.inf
            inside = np.arange(slots) - 1 <= c
            inside[0] = goes_left
            for side in (inside, ~inside):
                total, count = g[i, f, side].sum(), n[i, f, side].sum()
                if count > 1:
                    following.append(len(left))
                for column, x in ((feature, 0), (cut, 0), (edge, 0.0), (missing, True), (left, 0)):
                    column.append(x)
                value.append(rate * total / (count + ridge) / scale)
        open_nodes = following
        if not open_nodes:
            break
    return _as_tree(feature, cut, edge, missing, left, value)


def _as_tree(feature, cut, edge, missing, left, value) -> Tree:
    return Tree(
        np.array(feature, np.int32), np.array(cut, np.int32), np.array(edge, float), np.array(missing, bool),
        np.array(left, np.int32), np.array(value, float),
    )


def train_boosted(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    trees: int = TREES,
    depth: int = DEPTH,
    rate: float = RATE,
    ridge: float = RIDGE,
    edges: Mapping[str, Sequence[float]] | None = None,
    base: float | None = None,
    scale: float | None = None,
) -> Boosted:
    """Fit trees to all rows that have a label. Runs Spark jobs now, one per level of each tree.

    NULL and NaN inputs are missing. ``edges`` are the cuts tried per input, quantiles if not
    given; ``base`` is the mean of the label, ``scale`` as fine as exact sums allow. Without
    rows the model is its base value, 0 if none is given.
    """
    rows = rows.where(F.col(label).isNotNull() & ~F.isnan(F.col(label).cast("double")))
    y = F.col(label).cast("double")
    found = rows.agg(F.count("*").alias("n"), F.avg(y).alias("mean"), F.max(F.abs(y)).alias("most")).first()
    if not found["n"]:
        return Boosted(tuple(features), base or 0.0, ())
    edges = edges or bin_edges(rows, features)
    cuts = [np.array(sorted(edges[c]), float) for c in features]
    base = found["mean"] if base is None else base
    # Residuals can be larger than the label, but hardly twice as large.
    most = 4 * max(found["most"], abs(base), 1e-300) * found["n"]
    scale = scale or 2.0 ** math.floor(_EXACT - math.log2(most))
    inputs = rows.select(*[_number(c).alias(f"x{i}") for i, c in enumerate(features)], y.alias("y"), F.lit(base).alias("score"))
    (state, at), since, done = written_at(map_batches(inputs, _binned(cuts), _ROWS), "binned"), [], []
    for _ in range(trees):
        if len(since) == KEEP:
            before = at
            (state, at), since = written_at(map_batches(state, _with_scores(len(cuts), since), _ROWS), "binned"), []
            discard(rows.sparkSession, before)
        tree = _grown(state, since, cuts, depth, ridge, scale, rate)
        since.append(tree)
        done.append(tree)
    return Boosted(tuple(features), base, tuple(done))


def with_prediction(df: DataFrame, model: Boosted, name: str = "prediction") -> DataFrame:
    """All columns and the model's value, in one pass of Arrow batches."""
    inputs = df.withColumn("__inputs", F.array(*[_number(c) for c in model.features]))
    width = len(model.features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("__inputs").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, width)
            columns = batch.columns[:-1]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(model.predict(x))], names=[*batch.schema.names[:-1], name])

    schema = df.select("*", F.lit(0.0).alias(name)).schema
    return map_batches(inputs, run, schema)
