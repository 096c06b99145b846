"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Inputs of a step are a word's own hashed embedding, the mean of its hashed character
trigrams', and how clearly the word and the clearest of its character sequences set toxic
texts of the training sample apart from others. The network is trained in numpy on the driver, on windows of a bounded sample of
labelled documents; it then scores all overlapping windows of every text in Arrow batches,
and a text's score is that of its worst window.

A label says that something in a text is toxic, not where. Training starts at the words
that tell the labels apart best, then goes on with the windows the network itself finds
worst in each text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import map_batches, remainder, text_slices

#: Labelled documents of each class that train the network at most.
SAMPLE = 1500, 3000
WORDS, GRAMS, WIDTH, HIDDEN = 8192, 4096, 8, 6
INPUT = 2 * WIDTH + 2
#: Buckets of what the sample tells about words and sequences of 3 to 5 characters.
SIGNS = 1 << 19
WINDOW, STRIDE = 32, 16
#: Longer words are read as parts of so many characters, each with so many of the one before.
PART, SHARED = 64, 16
BATCH, EPOCHS, RATE = 128, 4, 0.01
REMEMBERED, BLOCK = 200_000, 4096


def plain(word: str) -> str:
    """A word without capitals and without the signs around it."""
    word = word.lower()
    return word if word.isalnum() else word.strip("#*$%&|<>.,!?;:\"'()[]-_") or word


def steps(text: str) -> list[str]:
    """Words of a text, long ones in overlapping parts, so that every character is read."""
    words = text.split()
    if max(map(len, words), default=0) <= PART:
        return words
    return [w[i : i + PART] for w in words for i in range(0, max(1, len(w) - SHARED), PART - SHARED)]


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Letters:
    """Hashes of words and of their sequences of characters, many words at a time.

    Words are laid end to end between marks.
    """

    def __init__(self, words: list[str]):
        marked = [f"^{w or '^'}$" for w in words]
        self.size = np.array([len(m) for m in marked], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.place = np.arange(len(self.points)) - np.repeat(self.start, self.size)
        self.left = np.repeat(self.size, self.size) - self.place  # characters from here on
        powers = np.cumprod(np.full(self.size.max(), _FACTOR, np.uint64))
        self.own = _mixed(np.add.reduceat(self.points * powers[self.place], self.start))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n characters from each place on, and whether the word has so many."""
        h = np.zeros(len(self.points), np.uint64)
        for i in range(n):
            h = h * _FACTOR + np.r_[self.points[i:], np.zeros(min(i, len(h)), np.uint64)][: len(h)]
        return _mixed(h + np.uint64(n)), self.left >= n


def rows_of(letters: Letters, sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of each word's sequences, words laid end to end; their starts and numbers."""
    word = np.repeat(np.arange(len(letters.size)), letters.size)
    found, owner = [], []
    for n in sizes:
        h, valid = letters.grams(n)
        found.append((h[valid] % np.uint64(buckets)).astype(np.int64))
        owner.append(word[valid])
    owner = np.concatenate(owner)
    flat = np.concatenate(found)[np.argsort(owner, kind="stable")]
    count = np.bincount(owner, minlength=len(letters.size))
    return flat, np.cumsum(count) - count, count


class Vocabulary:
    """Codes of words, and the rows of the embeddings they use. Code 0 is no word."""

    def __init__(self):
        self.code: dict[str, int] = {}
        self.raw: dict[str, int] = {}
        self.plain: list[str] = [""]

    def codes(self, words: list[str]) -> np.ndarray:
        for word in set(words).difference(self.raw):
            bare = plain(word)
            if bare not in self.code:
                self.code[bare] = len(self.plain)
                self.plain.append(bare)
            self.raw[word] = self.code[bare]
        return np.fromiter(map(self.raw.__getitem__, words), np.int32, len(words))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """Weights, the forward pass, and its gradient."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        d, h = INPUT, HIDDEN
        self.signs = np.zeros(SIGNS, np.float32)  # learnt from counts, not by gradient
        make = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"words": make(WORDS, WIDTH, scale=0.1), "grams": make(GRAMS, WIDTH, scale=0.3)}
        for side in "fb":
            self.p[f"wx{side}"] = make(d, 3 * h, scale=d**-0.5)
            self.p[f"wh{side}"] = make(h, 3 * h, scale=h**-0.5)
            self.p[f"bx{side}"] = np.zeros(3 * h, np.float32)
        self.p["v"] = make(2 * h, scale=0.3)
        self.p["u"] = make(2 * h, scale=0.3)
        self.p["c"] = np.zeros(1, np.float32)

    def inputs(self, words: list[str]) -> np.ndarray:
        """Input of each word: own embedding, the mean of its trigrams', and its signs."""
        letters = Letters(words)
        h, valid = letters.grams(3)
        found = self.p["grams"][(h % np.uint64(GRAMS)).astype(np.int64)] * valid[:, None]
        grams = np.add.reduceat(found, letters.start) / np.add.reduceat(valid, letters.start, dtype=np.int64)[:, None]
        own = self.p["words"][(letters.own % np.uint64(WORDS)).astype(np.int64)]
        return np.concatenate([own, grams, self.clearest(letters)], 1).astype(np.float32)

    def clearest(self, letters: Letters) -> np.ndarray:
        """The word's own sign, and the greatest of its own and its sequences'."""
        own = self.signs[(letters.own % np.uint64(SIGNS)).astype(np.int64)]
        best = own
        for n in (3, 4, 5):
            h, valid = letters.grams(n)
            signs = self.signs[(h % np.uint64(SIGNS)).astype(np.int64)] * valid
            best = np.maximum(best, np.maximum.reduceat(signs, letters.start))
        return np.stack([own, best], 1)

    def gates(self, x: np.ndarray) -> dict[str, np.ndarray]:
        return {s: x @ self.p[f"wx{s}"] + self.p[f"bx{s}"] for s in "fb"}

    def _pass(self, gx: np.ndarray, at: np.ndarray, there: np.ndarray, side: str, trace: list | None) -> np.ndarray:
        """Hidden states (step, window, unit); steps without a word carry the state on."""
        h = HIDDEN
        wh = self.p[f"wh{side}"]
        state = np.zeros((len(at), h), np.float32)
        out = np.zeros((at.shape[1], len(at), h), np.float32)
        steps = range(at.shape[1]) if side == "f" else range(at.shape[1] - 1, -1, -1)
        for t in steps:
            x, m = gx[at[:, t]], there[:, t, None]
            g = state @ wh[:, : 2 * h]
            zr = _sigmoid(x[:, : 2 * h] + g)
            z, r = zr[:, :h], zr[:, h:]
            held = r * state
            new = np.tanh(x[:, 2 * h :] + held @ wh[:, 2 * h :])
            before = state
            state = before + m * z * (new - before)
            out[t] = state
            if trace is not None:
                trace.append((t, z, r, new, before, held))
        return out

    def _fast(self, gx: np.ndarray, at: np.ndarray, there: np.ndarray, side: str, out: np.ndarray) -> None:
        """As ``_pass`` without a trace, writing into ``out`` and reusing its arrays."""
        h, n = HIDDEN, len(at)
        wzr, wn = (np.ascontiguousarray(w) for w in np.split(self.p[f"wh{side}"], [2 * h], 1))
        gzr, gn = (np.ascontiguousarray(g) for g in np.split(gx, [2 * h], 1))
        state, held = np.zeros((n, h), np.float32), np.empty((n, h), np.float32)
        zr, new, add = np.empty((n, 2 * h), np.float32), np.empty((n, h), np.float32), np.empty((n, 2 * h), np.float32)
        whole = there.all(0)
        for t in range(at.shape[1]) if side == "f" else range(at.shape[1] - 1, -1, -1):
            word = at[:, t]
            np.take(gzr, word, 0, zr)
            np.matmul(state, wzr, add)
            zr += add
            zr *= 0.5
            np.tanh(zr, zr)
            zr += 1
            zr *= 0.5
            np.multiply(zr[:, h:], state, held)
            np.take(gn, word, 0, new)
            np.matmul(held, wn, add[:, :h])
            new += add[:, :h]
            np.tanh(new, new)
            new -= state
            new *= zr[:, :h]
            if not whole[t]:
                new *= there[:, t, None]
            state += new
            out[t] = state

    def logits(self, gx: dict[str, np.ndarray], at: np.ndarray, there: np.ndarray, trace: dict | None = None):
        if trace is None and there.dtype == np.float32:
            states = np.empty((at.shape[1], len(at), 2 * HIDDEN), np.float32)
            for i, s in enumerate("fb"):
                self._fast(gx[s], at, there, s, states[:, :, i * HIDDEN : (i + 1) * HIDDEN])
        else:
            both = [self._pass(gx[s], at, there, s, None if trace is None else trace.setdefault(s, [])) for s in "fb"]
            states = np.concatenate(both, 2)
        a = np.where(there.T > 0, states @ self.p["v"], -1e9)
        a = np.exp(a - a.max(0)) * there.T
        a /= np.maximum(a.sum(0), 1e-9)
        pooled = (a[:, :, None] * states).sum(0)
        if trace is not None:
            trace |= {"states": states, "a": a, "pooled": pooled}
        return pooled @ self.p["u"] + self.p["c"][0]

    def gradient(self, x: np.ndarray, at: np.ndarray, there: np.ndarray, target: np.ndarray, weight: np.ndarray):
        """Gradients of the logistic loss; that of the inputs under 'x'."""
        h, trace = HIDDEN, {}
        gx = self.gates(x)
        p = _sigmoid(self.logits(gx, at, there, trace))
        d = ((p - target) * weight / len(at)).astype(np.float32)
        states, a = trace["states"], trace["a"]
        g = {"u": trace["pooled"].T @ d, "c": np.array([d.sum()], np.float32)}
        dp = d[:, None] * self.p["u"]
        ds = a[:, :, None] * dp
        da = a * ((states * dp).sum(2) - (trace["pooled"] * dp).sum(1))
        g["v"] = np.einsum("twk,tw->k", states, da)
        ds = ds + da[:, :, None] * self.p["v"]
        dx = np.zeros_like(x)
        for k, side in enumerate("fb"):
            wh = self.p[f"wh{side}"]
            dwh, dgx = np.zeros_like(wh), np.zeros((len(x), 3 * h), np.float32)
            carry = np.zeros((len(at), h), np.float32)
            for t, z, r, new, before, held in reversed(trace[side]):
                total = carry + ds[t, :, k * h : (k + 1) * h]
                m = there[:, t, None]
                dnew = total * m * z * (1 - new**2)
                dz = total * m * (new - before) * z * (1 - z)
                dheld = dnew @ wh[:, 2 * h :].T
                dr = dheld * before * r * (1 - r)
                dzr = np.concatenate([dz, dr], 1)
                dwh[:, : 2 * h] += before.T @ dzr
                dwh[:, 2 * h :] += held.T @ dnew
                carry = total * (1 - m * z) + dheld * r + dzr @ wh[:, : 2 * h].T
                np.add.at(dgx, at[:, t], np.concatenate([dzr, dnew], 1))
            g[f"wh{side}"] = dwh
            g[f"wx{side}"] = x.T @ dgx
            g[f"bx{side}"] = dgx.sum(0)
            dx += dgx @ self.p[f"wx{side}"].T
        g["x"] = dx
        return g


def windows(n: int) -> np.ndarray:
    """First word of every window of n words; the last ends at the last word.

    Any passage of up to WINDOW - STRIDE + 1 words lies whole in a window.
    """
    return np.r_[np.arange(0, n - WINDOW, STRIDE), n - WINDOW] if n > WINDOW else np.zeros(1, np.int64)


def window_table(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: their windows' word places, which exist, and the windows' texts."""
    starts = [windows(n) for n in sizes.tolist()]
    text = np.repeat(np.arange(len(sizes)), [len(s) for s in starts])
    first = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    place = first[:, None] + np.arange(WINDOW)
    there = place < sizes[text][:, None]
    return place + (np.cumsum(sizes) - sizes)[text][:, None], there, text


class Scorer:
    """Scores texts with a trained network; keeps the gates of words it has met."""

    def __init__(self, network: Network):
        self.network = network
        self._forget()

    def _forget(self) -> None:
        self.words = Vocabulary()
        none = np.zeros((1, INPUT), np.float32)
        self.gx = self.network.gates(none)

    def codes(self, split: list[list[str]]) -> np.ndarray:
        if len(self.words.raw) > REMEMBERED:
            self._forget()
        codes = self.words.codes([w for ws in split for w in ws])
        new = self.words.plain[len(self.gx["f"]) :]
        if new:
            more = self.network.gates(self.network.inputs(new))
            self.gx = {s: np.concatenate([self.gx[s], more[s]]) for s in "fb"}
        return codes

    def window_logits(self, codes: np.ndarray, place: np.ndarray, there: np.ndarray) -> np.ndarray:
        codes = np.r_[codes, 0]
        out = np.empty(len(place), np.float32)
        for i in range(0, len(place), BLOCK):
            mask = there[i : i + BLOCK]
            at = codes[np.where(mask, place[i : i + BLOCK], len(codes) - 1)]
            out[i : i + BLOCK] = self.network.logits(self.gx, at, mask.astype(np.float32))
        return out

    def many(self, texts: list[str]) -> np.ndarray:
        split = [steps(t) for t in texts]
        codes = self.codes(split)
        place, there, text = window_table(np.array([len(ws) for ws in split]))
        worst = np.full(len(texts), -np.inf)
        np.maximum.at(worst, text, self.window_logits(codes, place, there))
        return _sigmoid(worst)


def _train(network: Network, vocabulary: Vocabulary, at: np.ndarray, target: np.ndarray, epochs: int, seed: int):
    """Adam over windows of word codes; code 0 is no word. Classes weigh alike."""
    r = np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    share = np.clip(target.mean(), 0.01, 0.99)
    weight = np.where(target > 0, 0.5 / share, 0.5 / (1 - share))
    letters = Letters(vocabulary.plain)
    gram_flat, gram_start, gram_size = rows_of(letters, (3,), GRAMS)
    own = (letters.own % np.uint64(WORDS)).astype(np.int64)
    signs = network.clearest(letters)
    step = 0
    for _ in range(epochs):
        order = r.permutation(len(at))
        for i in range(0, len(order), BATCH):
            rows = order[i : i + BATCH]
            used, local = np.unique(at[rows], return_inverse=True)
            local = local.reshape(len(rows), -1)
            size, first = gram_size[used], np.cumsum(gram_size[used]) - gram_size[used]
            grams = gram_flat[np.repeat(gram_start[used] - first, size) + np.arange(size.sum())]
            mean = np.add.reduceat(network.p["grams"][grams], first) / size[:, None]
            x = np.concatenate([network.p["words"][own[used]], mean, signs[used]], 1).astype(np.float32)
            x[used == 0] = 0
            g = network.gradient(x, local, (at[rows] > 0).astype(np.float32), target[rows], weight[rows])
            dx = g.pop("x") * (used > 0)[:, None]
            g["words"], g["grams"] = np.zeros_like(network.p["words"]), np.zeros_like(network.p["grams"])
            np.add.at(g["words"], own[used], dx[:, :WIDTH])
            np.add.at(g["grams"], grams, np.repeat(dx[:, WIDTH : 2 * WIDTH] / size[:, None], size, 0))
            step += 1
            for k, (m, v) in moments.items():
                m += 0.1 * (g[k] - m)
                v += 0.001 * (g[k] ** 2 - v)
                network.p[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def _signs(words: Vocabulary, codes: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """By bucket: root of the likelihood ratio of its texts' labels, 0 if rarer in toxic ones."""
    letters = Letters(words.plain)
    flat, start, size = rows_of(letters, (3, 4, 5), SIGNS)
    own = (letters.own % np.uint64(SIGNS)).astype(np.int64)
    seen = np.zeros((2, SIGNS))
    for c, label in zip(codes, toxic):
        c = np.unique(c)
        rows = flat[np.repeat(start[c] - (np.cumsum(size[c]) - size[c]), size[c]) + np.arange(size[c].sum())]
        seen[int(label), np.unique(np.r_[rows, own[c]])] += 1
    texts = np.array([[(toxic == 0).sum()], [(toxic == 1).sum()]], float)
    expected = seen.sum(0) * texts / texts.sum()
    rest, rest_expected = texts - seen, texts - expected
    term = lambda o, e: np.where(o > 0, o * np.log(np.maximum(o, 1e-9) / np.maximum(e, 1e-9)), 0)
    g = 2 * (term(seen, expected) + term(rest, rest_expected)).sum(0)
    return np.where(seen[1] > expected[1], np.sqrt(np.maximum(g, 0)) / 4, 0).astype(np.float32)


def train(texts: list[str], toxic: np.ndarray, seed: int = 7) -> Network:
    """A network from labelled texts; without both labels it scores every text alike."""
    network = Network(seed)
    if not len(texts) or toxic.min() == toxic.max():
        network.p["u"][:] = 0
        network.p["c"][:] = 2.0 if len(texts) and toxic.all() else -2.0
        return network
    words = Vocabulary()
    codes = [words.codes(steps(t)) for t in texts]
    network.signs = _signs(words, codes, toxic)
    odds = network.clearest(Letters(words.plain)).max(1)
    odds[0] = 0

    sizes = np.array([len(c) for c in codes])
    place, there, text = window_table(sizes)
    flat = np.r_[np.concatenate(codes), 0]
    at = flat[np.where(there, place, len(flat) - 1)]
    suspicion = odds[at].max(1) + 1e-3 * np.random.default_rng(seed).random(len(at))
    for epochs in (EPOCHS, EPOCHS // 2, EPOCHS // 2):
        # The worst window of each text, and as many at random from texts that are not toxic.
        order = np.lexsort((suspicion, text))
        worst = order[np.r_[text[order][1:] != text[order][:-1], True]]
        r = np.random.default_rng(seed + epochs)
        fair = np.flatnonzero(toxic[text] == 0)
        chosen = np.concatenate([worst, r.choice(fair, min(len(fair), len(worst)), replace=False)])
        _train(network, words, at[chosen], toxic[text[chosen]].astype(np.float32), epochs, seed + epochs)
        scorer = Scorer(network)
        scorer.words = words
        scorer.gx = {s: np.concatenate([scorer.gx[s], g]) for s, g in network.gates(network.inputs(words.plain[1:])).items()}
        suspicion = scorer.window_logits(flat[:-1], place, there)
    worst = np.full(len(texts), -np.inf)
    np.maximum.at(worst, text, suspicion)
    # The middle between the classes becomes 0.5: the cut with the fewest errors, as far from both as can be.
    values = np.sort(worst)
    cuts = (values[1:] + values[:-1]) / 2
    errors = np.array([(toxic[worst > c] == 0).sum() + (toxic[worst <= c] == 1).sum() for c in cuts])
    best = np.flatnonzero(errors == errors.min())
    network.p["c"] -= np.float32(cuts[best[np.argmax((values[1:] - values[:-1])[best])]])
    return network


def training_rows(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Texts and labels of at most ``sample`` toxic and other documents, those of the smallest hashes.

    Only documents whose crc32 modulo 5 is not 0 are taken. Rows without a text, a label or
    an id are left out; an id labelled both ways counts as toxic.
    """
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(remainder(F.col("doc_id")) != 0)
    rows = []
    for label, most in ((1, sample[0]), (0, sample[1])):
        h = F.xxhash64("doc_id")
        picked = known.where(F.col("toxic") == label).orderBy(h, "doc_id").limit(most).select("doc_id")
        found = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(picked), "doc_id")
        rows += [(r["doc_id"], r["text"], label) for r in found.groupBy("doc_id").agg(F.min("text").alias("text")).collect()]
    rows.sort()
    return [r[1] for r in rows], np.array([r[2] for r in rows], np.int64)


def score_texts(docs: DataFrame, network: Network, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, score) of every row; a text without words has the score of an empty window."""
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            for at, texts in text_slices(batch, "text"):
                scores = pa.array(scorer.many(texts).astype(np.float64), pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)), scores], ["doc_id", "score"])

    wanted = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_batches(wanted, run, "doc_id bigint, score double")


def toxicity(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted; one row per row of ``docs``.

    Null texts count as empty; null ids are allowed and count as the text 'null' for the
    fold. Repeated rows score alike; empty tables give no rows; with no usable label every
    text scores alike. Only text enters a score, other columns are not read.
    """
    network = train(*training_rows(docs, labels, sample))
    return score_texts(docs, network).select(
        "doc_id",
        (remainder(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
