"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on each text. Expectation
maximisation over the counts of vote patterns estimates how often each labeller is right
and the share of good texts, without any true label. The posteriors of a bounded sample
then train a linear scorer on hashed features, which scores every text.

Vote patterns are counted over all documents; there are at most 3 ** 10 of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.llm.common import map_batches, text_slices
from hourloom.llm.quality_rules import STOP_WORDS, SYMBOLS

#: Documents that train the scorer; a smaller table trains it whole.
SAMPLE = 4000
FEATURES = 2048
STEPS = 300
REMEMBERED = 300_000

#: (measure, a value from here on is a bad sign, a value below here a good one); see ``_one``.
#: Junk is of many kinds, so most labellers know one kind of it and say nothing of the rest.
LABELLERS = (
    ("short", 0.4, 0.0),
    ("symbol_words", 0.15, 0.0),
    ("capital_words", 0.4, 0.0),
    ("capital_starts", 0.5, 0.3),
    ("noisy_ends", 0.15, 0.0),
    ("repeated_words", 0.2, 0.0),
    ("few_stop_words", 0.97, 0.9),
    ("few_distinct", 0.7, 0.4),
    ("letterless_words", 0.15, 0.0),
    ("repeated_lines", 0.6, 0.0),
)

#: Texts of fewer words are not judged by their stop words or repetitions.
ENOUGH_WORDS = 25

_STOP = frozenset(STOP_WORDS)
_SYMBOLS = frozenset(SYMBOLS)


def _bucket(sign: str) -> int:
    return zlib.crc32(sign.encode()) % (FEATURES - 256)


def shape(word: str) -> str:
    """What a word looks like: runs of capitals, small letters and digits as one sign each."""
    out = []
    for c in word:
        s = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != s:
            out.append(s)
    return "".join(out[:24])


class Reader:
    """Measures and features of texts; keeps what it knows about words."""

    def __init__(self):
        self.code: dict[str, int] = {}
        self.table = np.empty((0, 7), np.int64)

    @staticmethod
    def _traits(word: str) -> tuple:
        """Symbol, all capitals, capital start, noisy end, stop word, no letters, shape."""
        if word.isalpha():
            upper = len(word) > 1 and word.isupper()
            sign = "a" if word.islower() else "Aa" if word[0].isupper() and word[1:].islower() else shape(word)
            return False, upper, word[0].isupper(), False, word.lower() in _STOP, False, _bucket(sign)
        bare = word.strip(".,!?;:\"'()")
        return (
            not _SYMBOLS.isdisjoint(word),
            len(bare) > 1 and bare.isupper(),
            word[0].isupper(),
            len(word) > 2 and not word[-1].isalnum() and not word[-2].isalnum(),
            bare.lower() in _STOP,
            not any(map(str.isalnum, word)),
            _bucket(shape(word)),
        )

    def _look(self, words: list[str]) -> np.ndarray:
        if len(self.code) > REMEMBERED:
            self.code, self.table = {}, self.table[:0]
        new = list(set(words).difference(self.code))
        if new:
            self.code.update(zip(new, range(len(self.code), len(self.code) + len(new))))
            self.table = np.concatenate([self.table, np.array([self._traits(w) for w in new], np.int64)])
        return np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))

    def many(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray] | None]:
        """Measures, feature numbers and weights of each text; None for a text without words."""
        split = [t.split() for t in texts]
        out: list = [None] * len(texts)
        some = [i for i, ws in enumerate(split) if ws]
        if not some:
            return out
        codes = self._look([w for i in some for w in split[i]])
        size = np.array([len(split[i]) for i in some])
        starts = np.cumsum(size) - size
        traits = self.table[codes]
        symbol, capital, start, noisy, stop, bare = (np.add.reduceat(traits[:, :6], starts) / size[:, None]).T
        doc = np.repeat(np.arange(len(some)), size)
        place = np.arange(len(codes)) - starts[doc]
        again = np.r_[False, codes[1:] == codes[:-1]] & (place > 0)
        repeat = np.add.reduceat(again, starts, dtype=np.int64) / np.maximum(size - 1, 1)
        # Longer texts repeat more words by nature, so only stretches of 50 words are compared.
        blocks = -(-size // 50)
        first = np.cumsum(blocks) - blocks
        block = first[doc] + place // 50
        pairs = np.unique(block * (len(self.table) + 1) + codes)
        different = np.bincount(pairs // (len(self.table) + 1), minlength=blocks.sum()) / np.bincount(block)
        distinct = np.add.reduceat(different, first) / blocks
        few = size < ENOUGH_WORDS  # too few words to be suspicious
        stop, distinct = np.where(few, 1.0, stop), np.where(few, 1.0, distinct)
        seen, counts = np.unique(doc * FEATURES + traits[:, 6], return_counts=True)
        of = seen // FEATURES
        weight = np.sqrt(counts / size[of])
        cuts = np.searchsorted(of, np.arange(len(some) + 1))
        lines = [[x for x in texts[i].split("\n") if x and not x.isspace()] for i in some]
        same = np.array([1 - len(set(x)) / max(1, len(x)) for x in lines])
        measures = np.stack([1 / size, symbol, capital, start, noisy, repeat, 1 - stop, 1 - distinct, bare, same], 1)
        bins = np.minimum((measures * 16).astype(np.int64), 15) + 16 * np.arange(measures.shape[1]) + FEATURES - 256
        half = np.full(measures.shape[1], 0.5)
        for k, i in enumerate(some):
            mine = slice(cuts[k], cuts[k + 1])
            out[i] = (measures[k], np.r_[seen[mine] % FEATURES, bins[k]], np.r_[weight[mine], half])
        return out


def votes(measures: np.ndarray) -> np.ndarray:
    """0 bad, 1 nothing, 2 good, by labeller."""
    bad = np.array([b for _, b, _ in LABELLERS])
    good = np.array([g for _, _, g in LABELLERS])
    return np.where(measures >= bad, 0, np.where(measures < good, 2, 1))


def pattern(measures: np.ndarray | None) -> int:
    """The votes as one number; a text without words has the worst of all."""
    if measures is None:
        return 0
    return int((votes(measures) * 3 ** np.arange(len(LABELLERS))).sum())


def unpack(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


class LabelModel:
    """P(vote | class) of each labeller and P(good), by expectation maximisation."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 100):
        cast = np.eye(3)[unpack(patterns)]  # pattern, labeller, vote
        good = np.where((unpack(patterns) == 0).any(1), 0.1, 0.9)  # to begin with: nobody found it bad
        for _ in range(rounds):
            weight = np.stack([1 - good, good]) * counts
            self.prior = (weight.sum(1) + 1) / (weight.sum() + 2)
            seen = np.einsum("cp,plv->clv", weight, cast) + 0.1
            self.rates = seen / seen.sum(2, keepdims=True)
            good = self.posterior(patterns)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        cast = np.eye(3)[unpack(np.asarray(patterns))]
        log = np.einsum("plv,clv->cp", cast, np.log(self.rates)) + np.log(self.prior)[:, None]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))

    def accuracies(self) -> np.ndarray:
        """Share of right votes of each labeller among those it casts."""
        right = self.prior[0] * self.rates[0, :, 0] + self.prior[1] * self.rates[1, :, 2]
        wrong = self.prior[0] * self.rates[0, :, 2] + self.prior[1] * self.rates[1, :, 0]
        return right / (right + wrong)


def train_scorer(rows: list[tuple[list[int], list[float]]], target: np.ndarray) -> np.ndarray:
    """Weights of the hashed features and, last, the bias; soft labels, classes weighed alike."""
    x = np.zeros((len(rows), FEATURES + 1), np.float32)
    for i, (at, weight) in enumerate(rows):
        np.add.at(x[i], at, weight)
    x[:, -1] = 1
    share = np.clip(target.mean(), 0.01, 0.99) if len(target) else 0.5
    importance = target / share + (1 - target) / (1 - share)
    w, speed = np.zeros(FEATURES + 1, np.float32), np.zeros(FEATURES + 1, np.float32)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        error = ((p - target) * importance / max(1, len(rows))).astype(np.float32)
        speed = 0.9 * speed + x.T @ error + np.float32(1e-4) * w
        w -= 0.5 * speed
    return w


_PATTERN = "pattern int"
_TRAINING = "pattern int, at array<int>, weight array<double>"


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = Reader()
    for batch in batches:
        for _, texts in text_slices(batch, "text"):
            found = [pattern(r and r[0]) for r in reader.many(texts)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32())], ["pattern"])


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = Reader()
    for batch in batches:
        for _, texts in text_slices(batch, "text"):
            rows = [r for r in reader.many(texts) if r is not None]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([pattern(r[0]) for r in rows], pa.int32()),
                    pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[2] for r in rows], pa.list_(pa.float64())),
                ],
                ["pattern", "at", "weight"],
            )


class Classifier:
    """The label model and the weights of the scorer, both of bounded size."""

    def __init__(self, labels: LabelModel, weights: np.ndarray):
        self.labels, self.weights = labels, weights

    def score(self, row: tuple | None) -> float:
        if row is None:
            return 0.0
        z = float((self.weights[row[1]] * row[2]).sum() + self.weights[-1])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Classifier:
    """Pattern counts of all documents, and a scorer trained on ``sample`` of them.

    The sample is that of the smallest hashes of texts, so it does not depend on the order
    of rows; equal texts count once in it.
    """
    texts = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    counted = map_batches(texts, _patterns, _PATTERN).groupBy("pattern").count().collect()
    patterns = np.array([r["pattern"] for r in counted], np.int64)
    labels = LabelModel(patterns, np.array([r["count"] for r in counted], np.float64))
    picked = texts.groupBy(F.xxhash64("text").alias("h")).agg(F.count("*").alias("n")).orderBy("h").limit(sample)
    chosen = texts.withColumn("h", F.xxhash64("text")).join(F.broadcast(picked.select("h")), "h")
    once = chosen.dropDuplicates(["h"]).select("text")
    rows = map_batches(once, _training, _TRAINING).collect()
    target = labels.posterior(np.array([r["pattern"] for r in rows], np.int64)) if rows else np.empty(0)
    return Classifier(labels, train_scorer([(r["at"], r["weight"]) for r in rows], target))


def classify(
    docs: DataFrame, text: str = "text", score: str = "score", label: str = "weak_label", model: Classifier | None = None
) -> DataFrame:
    """The rows with the scorer's probability of good quality and the label model's own.

    A text without words, null or empty, scores 0. Repeated rows score alike. An empty
    table stays empty. Columns named ``score`` or ``label`` are replaced, others pass through.
    """
    model = model or fit(docs, text)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name not in (score, label)]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField(score, T.DoubleType()), T.StructField(label, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, model = Reader(), sent.value
        for batch in batches:
            for at, texts in text_slices(batch, text):
                rows = list(reader.many(texts))
                scores = [model.score(r) for r in rows]
                weak = model.labels.posterior(np.array([pattern(r and r[0]) for r in rows], np.int64))
                rest = [batch.column(c).slice(at, len(texts)) for c in names]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(scores, pa.float64()), pa.array(weak)], [*names, score, label])

    return map_batches(docs, run, schema)
