"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A text is a row of words (runs of letters, digits and marks, lower-cased). A word enters the network as an embedding of itself and the mean
embedding of its character trigrams, both hashed. Windows of WINDOW words that overlap by half cover the whole text; in a window one network
reads from the left, one from the right, attention pools their states, and a logistic unit scores the pool. The score of a text is that of
its highest window, calibrated on the training texts.

Training takes a bounded sample of labelled texts that are not held out, ``most`` toxic ones and twice as many others by a seeded order, and
whole texts of these: first the windows whose words or trigrams are commonest in toxic texts against others, and random ones of the others;
then, in rounds, the highest windows of each text by the network itself.

Defined results: a null text counts as the empty one; texts without words get the score of a window without words, at most that of a text
that says nothing; without labelled rows of both classes every score is 0; a null doc_id is held out; labels other than 0 and 1 are left
out; of several texts with one doc_id the smallest is learned from; equal rows are separate rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.batches import MULTIPLIERS, span_hashes
from meridian.llm.common import documents, held_out, slices

WINDOW, STRIDE = 32, 16
EMBED, HIDDEN = 8, 8
WORDS, GRAMS = 1 << 15, 1 << 13
#: Training texts that are toxic, at most; of the others twice as many.
MOST = 1500
#: Windows of a training step, and steps of the first phase at least; a round takes half as many.
BATCH, STEPS = 192, 100
SLICE, CHUNK = 1 << 19, 2048
#: Bytes that make up words: ASCII letters, digits and all of the longer characters.
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Words:
    """The words of some texts: distinct ones with their features, and the place of each word of a text among them."""

    def __init__(self, texts: list[str | None]):
        parts = [(t or "").lower().encode("utf-8") for t in texts]
        raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        inside = np.concatenate([[False], _WORD[raw], [False]])
        starts, ends = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        bounds = np.cumsum([len(p) + 1 for p in parts]) if parts else np.zeros(0, np.int64)
        self.count = np.diff(np.concatenate([[0], np.searchsorted(starts, bounds)]))
        hashes = span_hashes(raw, starts, ends, MULTIPLIERS[0])
        distinct, first, at = np.unique(hashes, return_index=True, return_inverse=True)
        self.at = at.astype(np.int32)
        self.word = (distinct >> np.uint64(20)).astype(np.int64) % WORDS
        # Trigrams of "<word>": one for each byte, centred on it.
        s, e = starts[first], ends[first]
        size = e - s
        self.gram_start = np.cumsum(size) - size
        centre = np.arange(int(size.sum())) - np.repeat(self.gram_start - s, size)
        left = np.where(centre == np.repeat(s, size), 60, raw[centre - 1]).astype(np.uint64)
        right = np.where(centre + 1 == np.repeat(e, size), 62, raw[np.minimum(centre + 1, len(raw) - 1)]).astype(np.uint64)
        packed = (left << np.uint64(16)) | (raw[centre].astype(np.uint64) << np.uint64(8)) | right
        self.gram = ((packed * np.uint64(MULTIPLIERS[1])) >> np.uint64(40)).astype(np.int64) % GRAMS
        self.gram_size = size

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words of each window (-1 past the end of a text), and the text of each window."""
        n = np.maximum(1, -(-(self.count - (WINDOW - STRIDE)) // STRIDE))
        text = np.repeat(np.arange(len(n)), n)
        begin = np.cumsum(self.count) - self.count
        step = (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
        out = np.full((len(text), WINDOW), -1, np.int32)
        for t in range(WINDOW):
            inside = np.flatnonzero(step + t < self.count[text])
            out[inside, t] = self.at[begin[text[inside]] + step[inside] + t]
        return out, text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Weights by name, all float32."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.w = {"words": draw(WORDS, EMBED, scale=0.1), "grams": draw(GRAMS, EMBED, scale=0.1)}
        for d in "lr":
            self.w |= {f"in_{d}": draw(2 * EMBED, 3 * HIDDEN, scale=0.4), f"bias_{d}": np.zeros(3 * HIDDEN, np.float32), f"loop_{d}": draw(HIDDEN, 3 * HIDDEN, scale=0.3)}
        self.w |= {"look": draw(2 * HIDDEN, HIDDEN, scale=0.4), "look_bias": np.zeros(HIDDEN, np.float32), "query": draw(HIDDEN, scale=0.5)}
        self.w |= {"out": draw(2 * HIDDEN, scale=0.3), "out_bias": np.full(1, -1.0, np.float32)}
        self.slope, self.shift = 1.0, 0.0

    def embed(self, words: Words) -> np.ndarray:
        """Input of each distinct word."""
        mean = np.add.reduceat(self.w["grams"][words.gram], words.gram_start, axis=0) / words.gram_size[:, None] if len(words.word) else np.zeros((0, EMBED))
        return np.concatenate([self.w["words"][words.word], mean.astype(np.float32)], axis=1)

    def project(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """What each distinct word adds to the gates of either direction, with a row of zeros at the end for no word (index -1)."""
        none = np.zeros((1, 3 * HIDDEN), np.float32)
        return {d: np.concatenate([x @ self.w[f"in_{d}"] + self.w[f"bias_{d}"], none]) for d in "lr"}

    def _read(self, gates: np.ndarray, at: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States of one direction after each place, (place, window, HIDDEN); a place without a word leaves the state as it is."""
        loop, n = self.w[f"loop_{d}"], len(at)
        states = np.empty((WINDOW, n, HIDDEN), np.float32)
        h = np.zeros((n, HIDDEN), np.float32)
        for t in range(WINDOW) if d == "l" else range(WINDOW - 1, -1, -1):
            a = gates[at[:, t]]
            u = h @ loop
            zr = _sigmoid(a[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            new = np.tanh(a[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            there = (at[:, t, None] >= 0).astype(np.float32)
            step = there * (1 - z)
            if keep is not None:
                keep.append((t, h, z, r, new, u[:, 2 * HIDDEN :], there))
            h = h + step * (new - h)
            states[t] = h
        return states

    def forward(self, gates: dict[str, np.ndarray], at: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window."""
        traces: dict[str, list | None] = {d: [] if keep is not None else None for d in "lr"}
        both = np.concatenate([self._read(gates[d], at, d, traces[d]) for d in "lr"], axis=2)
        look = np.tanh(both @ self.w["look"] + self.w["look_bias"])
        weight = look @ self.w["query"]
        weight = np.where(at.T >= 0, weight, -1e9)
        weight[0] = np.where((at >= 0).any(axis=1), weight[0], 0.0)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pool = (both * weight[:, :, None]).sum(axis=0)
        if keep is not None:
            keep |= {"both": both, "look": look, "weight": weight, "pool": pool, "traces": traces}
        return pool @ self.w["out"] + self.w["out_bias"][0]

    def gradients(self, words: Words, at: np.ndarray, target: np.ndarray, sample_weight: np.ndarray, drop: np.ndarray | float = 1.0) -> dict[str, np.ndarray]:
        """Gradients of the mean weighted logistic loss over some windows, by back-propagation through time.

        ``drop``: a factor for the embedding of each distinct word itself, 0 to leave it to its characters.
        """
        x, keep = self.embed(words), {}
        x[:, :EMBED] *= drop
        g = {k: np.zeros_like(v) for k, v in self.w.items()}
        logit = self.forward(self.project(x), at, keep)
        both, look, weight, pool = keep["both"], keep["look"], keep["weight"], keep["pool"]
        d_logit = ((_sigmoid(logit) - target) * sample_weight / len(at)).astype(np.float32)
        g["out"], g["out_bias"] = pool.T @ d_logit, d_logit.sum(keepdims=True)
        d_pool = d_logit[:, None] * self.w["out"]
        d_both = weight[:, :, None] * d_pool
        d_weight = (both * d_pool).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d_score = np.where(at.T >= 0, d_score, 0).astype(np.float32)
        g["query"] = (look * d_score[:, :, None]).sum(axis=(0, 1))
        d_look = d_score[:, :, None] * self.w["query"] * (1 - look**2)
        flat = d_look.reshape(-1, HIDDEN)
        g["look"], g["look_bias"] = both.reshape(-1, 2 * HIDDEN).T @ flat, flat.sum(axis=0)
        d_both = d_both + (flat @ self.w["look"].T).reshape(both.shape)
        d_x = np.zeros((len(x) + 1, 2 * EMBED), np.float32)
        for d, half in (("l", slice(0, HIDDEN)), ("r", slice(HIDDEN, None))):
            d_h, loop = np.zeros((len(at), HIDDEN), np.float32), self.w[f"loop_{d}"]
            d_gates = np.zeros((len(x) + 1, 3 * HIDDEN), np.float32)
            for t, h, z, r, new, u, there in reversed(keep["traces"][d]):
                d_h = d_h + d_both[t][:, half]
                d_new = d_h * there * (1 - z) * (1 - new**2)
                d_z = -d_h * there * (new - h) * z * (1 - z)
                d_r = d_new * u * r * (1 - r)
                d_a = np.concatenate([d_z, d_r, d_new], axis=1)
                d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
                g[f"loop_{d}"] += h.T @ d_u
                d_h = d_h * (1 - there * (1 - z)) + d_u @ loop.T
                np.add.at(d_gates, at[:, t], d_a)
            d_gates = d_gates[:-1]
            g[f"in_{d}"], g[f"bias_{d}"] = x.T @ d_gates, d_gates.sum(axis=0)
            d_x[:-1] += d_gates @ self.w[f"in_{d}"].T
        np.add.at(g["words"], words.word, d_x[:-1, :EMBED] * drop)
        np.add.at(g["grams"], words.gram, np.repeat(d_x[:-1, EMBED:] / words.gram_size[:, None], words.gram_size, axis=0).astype(np.float32))
        return g

    def logits(self, words: Words, at: np.ndarray) -> np.ndarray:
        gates = self.project(self.embed(words))
        return np.concatenate([self.forward(gates, at[k : k + CHUNK]) for k in range(0, len(at), CHUNK)]) if len(at) else np.zeros(0)

    def raw_scores(self, texts: list[str | None]) -> np.ndarray:
        """The highest logit of each text's windows."""
        words = Words(texts)
        at, text = words.windows()
        return np.maximum.reduceat(self.logits(words, at), np.flatnonzero(np.diff(text, prepend=-1)))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return _sigmoid(self.slope * self.raw_scores(texts).astype(np.float64) + self.shift) if texts else np.zeros(0)


class _Adam:
    def __init__(self, w: dict[str, np.ndarray], rate: float):
        self.rate, self.t = rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))

    def step(self, w: dict[str, np.ndarray], g: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k in w:
            self.m[k] += 0.1 * (g[k] - self.m[k])
            self.v[k] += 0.01 * (g[k] ** 2 - self.v[k])
            w[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-6)


def train(texts: list[str], labels: np.ndarray, seed: int = 11, rounds: int = 3) -> Network:
    """A network fitted to whole texts with labels 0 and 1, of which both are there; every fifth text is kept back to calibrate the score."""
    rng, net = np.random.default_rng(seed), Network(seed)
    words = Words(texts)
    at, text = words.windows()
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    back = np.arange(len(texts)) % 5 == 4
    fitted = np.flatnonzero(~back)
    adam = _Adam(net.w, 0.01)
    balance = np.where(labels == 1, (labels == 0).mean(), (labels == 1).mean()) * 2

    def fit(chosen: np.ndarray) -> None:
        chosen = rng.permutation(chosen)
        for k in range(0, len(chosen), BATCH):
            some = chosen[k : k + BATCH]
            net_words, places = _narrowed(words, at[some])
            adam.step(net.w, net.gradients(net_words, places, labels[text[some]].astype(np.float32), balance[text[some]], rng.integers(0, 2, (len(net_words.word), 1)).astype(np.float32)))

    def passes(size: int, least: int) -> int:
        """Passes over ``size`` windows, so that there are at least so many steps."""
        return max(1, -(-least * BATCH // max(size, 1)))

    hint = _hints(words, text, at, labels, ~back)
    order = np.lexsort((-hint, text))
    start = []
    for i in fitted:
        lo, hi = first[i], first[i + 1]
        start += [order[lo : min(hi, lo + 1 + labels[i])], rng.choice(np.arange(lo, hi), min(2, hi - lo), replace=False) if not labels[i] else order[:0]]
    start = np.concatenate(start)
    for _ in range(1 + passes(len(start), STEPS)):
        fit(start)
    for k in range(rounds):
        order = np.lexsort((-_all_logits(net, words, at), text))
        adam.rate = 0.01 / (1 + k)
        # The highest window of a toxic text, and the highest three of another.
        high = np.concatenate([order[a : min(b, a + (1 if y else 3))] for a, b, y in zip(first[fitted], first[fitted + 1], labels[fitted], strict=True)])
        for _ in range(passes(len(high), STEPS // 2)):
            fit(high)
    high, known = np.maximum.reduceat(_all_logits(net, words, at), first[:-1]).astype(np.float64), labels
    if len(set(labels[back].tolist())) == 2:
        high, known = high[back], labels[back]
    # Calibration: a logistic curve over the highest logits, by Newton steps that are halved until they help; a prior holds it near the logits.
    x, beta = np.stack([high, np.ones_like(high)], 1), np.array([1.0, 0.0])
    loss = lambda b: float((np.logaddexp(0, x @ b) - known * (x @ b)).sum() + ((b - [1.0, 0.0]) ** 2).sum() / 2)
    for _ in range(25):
        p = _sigmoid(x @ beta)
        slope, curve = x.T @ (p - known) + beta - np.array([1.0, 0.0]), (x * (p * (1 - p))[:, None]).T @ x + np.eye(2)
        step = np.linalg.solve(curve, slope)
        while loss(beta - step) > loss(beta) and np.abs(step).max() > 1e-9:
            step /= 2
        beta = beta - step
    net.slope, net.shift = max(float(beta[0]), 1e-3), float(beta[1])
    return net


def _hints(words: Words, text: np.ndarray, at: np.ndarray, labels: np.ndarray, use: np.ndarray) -> np.ndarray:
    """For each window the largest log odds, over its words and their trigrams, of being in a toxic text, counted over the texts in ``use``."""
    first = np.searchsorted(text, np.arange(len(labels) + 1))
    seen_word, seen_gram = np.zeros((2, len(words.word)), np.int64), np.zeros((2, GRAMS), np.int64)
    for i in np.flatnonzero(use):
        word = np.unique(at[first[i] : first[i + 1]])
        word = word[word >= 0]
        size = words.gram_size[word]
        gram = words.gram[np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - words.gram_start[word], size)]
        seen_word[labels[i], word] += 1
        seen_gram[labels[i], np.unique(gram)] += 1
    n = np.bincount(labels[use], minlength=2) + 1
    of_word, of_gram = (np.log((seen[1] + 0.5) / n[1]) - np.log((seen[0] + 0.5) / n[0]) for seen in (seen_word, seen_gram))
    best = np.append(np.maximum(of_word, np.maximum.reduceat(of_gram[words.gram], words.gram_start)), -np.inf).astype(np.float32)
    return np.concatenate([best[at[k : k + CHUNK]].max(axis=1) for k in range(0, len(at), CHUNK)])


def _all_logits(net: Network, words: Words, at: np.ndarray) -> np.ndarray:
    """Logits of all windows of a training sample; each run of windows has its own few words, so that the inputs of all are never there at once."""
    return np.concatenate([net.logits(*_narrowed(words, at[k : k + CHUNK])) for k in range(0, len(at), CHUNK)])


def _narrowed(words: Words, at: np.ndarray) -> tuple[Words, np.ndarray]:
    """Only the distinct words that these windows use."""
    used, place = np.unique(at, return_inverse=True)
    place = place.reshape(at.shape)
    if len(used) and used[0] < 0:
        used, place = used[1:], place - 1
    out = Words.__new__(Words)
    out.word, out.gram_size = words.word[used], words.gram_size[used]
    out.gram_start = np.cumsum(out.gram_size) - out.gram_size
    out.gram = words.gram[np.arange(int(out.gram_size.sum())) - np.repeat(out.gram_start - words.gram_start[used], out.gram_size)]
    return out, place


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST, seed: int = 11) -> Network | None:
    """Fit a network on at most ``most`` toxic texts and twice as many others that are not held out; None if a label has none."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit(seed))
    sample = None
    for y in (0, 1):
        part = known.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(most * (2 - y))
        sample = part if sample is None else sample.unionAll(part)
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    y = np.array([r["toxic"] for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        return None
    return train([r["text"] for r in rows], y, seed)


def _score(batches: Iterator[pa.RecordBatch], net: Network | None, into: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            score = net.scores(part.column("text").to_pylist()) if net else np.zeros(part.num_rows)
            yield pa.record_batch([*part.columns, pa.array(score, pa.float64())], [*part.schema.names, into])


def score(docs: DataFrame, net: Network | None, keep: tuple[str, ...] = ("doc_id",), into: str = "score") -> DataFrame:
    """The columns ``keep`` of ``docs``, but one named as ``into``, with the score (0 to 1) in ``into``."""
    keep = tuple(c for c in keep if c != into)
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes)
    return rows.mapInArrow(lambda it: _score(it, net, into), f"{schema}, `{into}` double").select(*keep, into)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    net = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, net).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op8_toxicity": op8_toxicity}
ORACLE: dict[str, str] = {}
