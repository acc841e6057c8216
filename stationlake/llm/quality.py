"""Document quality: random-indexing word vectors and a small calibrated network.

A word has a sparse random index vector that its hash decides. Its word vector
is the normalised sum of its neighbours' index vectors over the whole corpus,
plus its own. A document is the mean of its words' vectors. A two-layer network
in numpy scores it; a temperature, fitted on labelled rows that the training
did not see, makes its probabilities honest.

Words are runs of non-white-space in lower case. Each is followed by its shape
(classes of characters in order, such as ``X!``), or by a mark if it repeats
the word before it. Words share ``BUCKETS`` hash buckets, which bounds what is
broadcast; counts cover all texts.

NULL and empty texts, and texts of white space, are the zero vector and get
the score of it. Repeated rows get equal scores. With labels of one class only,
or none, every score is that class's (0.5 for none). Labels with a NULL are
left out; a doc_id labelled several times counts as often.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm._common import portions

BUCKETS = 1 << 14
DIMS = 32
NONZERO = 2
NEAR = 2
HIDDEN = 16
THRESHOLD = 0.3
#: Labelled rows that the network is fitted to, at most (a fifth of them for the temperature).
MAX_LABELLED = 20_000
WORD_CACHE = 300_000
_AGAIN, _PAD = BUCKETS - 1, BUCKETS


def shape(word: str) -> str:
    """Classes of a word's characters in order: X upper, x lower, 0 digits, marks as they are; runs once."""
    out = []
    for c in word:
        k = "X" if c.isupper() else "x" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out[:6])


class _Codes(dict):
    """Word to (word bucket, shape bucket, check bits) in one integer."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = xxhash.xxh64_intdigest(word.lower())
        s = xxhash.xxh64_intdigest("shape " + shape(word)) % _AGAIN
        v = self[word] = (h % _AGAIN) | s << 14 | (h >> 40) << 28
        return v


def tokens(text: str | None, codes: _Codes) -> np.ndarray:
    """Buckets of a text's words and shapes, in turn."""
    words = (text or "").split()
    c = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    out = np.empty(2 * len(c), np.int64)
    out[0::2] = c & (BUCKETS - 1)
    out[1::2] = (c >> 14) & (BUCKETS - 1)
    out[3::2][c[1:] == c[:-1]] = _AGAIN
    return out


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero elements of every bucket's index vector (none for padding)."""
    r = np.random.default_rng(17)
    place = r.integers(0, DIMS, (BUCKETS + 1, NONZERO))
    sign = r.choice([-1.0, 1.0], (BUCKETS + 1, NONZERO))
    sign[_PAD] = 0
    return place, sign


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Vectors of all buckets from all texts: tasks add up neighbours, Spark adds up tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, (place, sign) = _Codes(), index_vectors()
        total = np.zeros((BUCKETS, DIMS))
        gap = np.full(2 * NEAR, _PAD)
        for b in (part for batch in batches for part in portions(batch)):
            parts = [x for t in b["text"] for x in (tokens(t, codes), gap)]
            flat = np.concatenate([gap, *parts]) if parts else gap
            real = np.flatnonzero(flat != _PAD)
            for o in range(1, 2 * NEAR + 1):
                for d in (o, -o):
                    me, other = flat[real], flat[real + d]
                    for k in range(NONZERO):
                        total += np.bincount(me * DIMS + place[other, k], sign[other, k], BUCKETS * DIMS).reshape(BUCKETS, DIMS)
        used = np.flatnonzero(np.abs(total).sum(1))
        yield pd.DataFrame({"bucket": used, **{f"d{j}": total[used, j] for j in range(DIMS)}})

    dims = [f"d{j}" for j in range(DIMS)]
    parts = docs.select("text").mapInPandas(run, "bucket long, " + ", ".join(f"{d} double" for d in dims))
    rows = parts.groupBy("bucket").agg(*[F.sum(d).alias(d) for d in dims]).collect()  # BUCKETS rows at most
    place, sign = index_vectors()
    vectors = np.zeros((BUCKETS, DIMS))
    for r in rows:
        vectors[r[0]] = r[1:]
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    own = np.zeros((BUCKETS, DIMS))
    for k in range(NONZERO):
        np.add.at(own, (np.arange(BUCKETS), place[:-1, k]), sign[:-1, k])
    return (vectors + own).astype(np.float32)


def pooled(texts: pd.Series, vectors: np.ndarray, codes: _Codes) -> np.ndarray:
    out = np.zeros((len(texts), DIMS), np.float32)
    for i, text in enumerate(texts):
        t = tokens(text, codes)
        if len(t):
            out[i] = vectors[t].mean(0)
    return out


class Network:
    """Two layers: tanh, then a logit that the temperature divides."""

    def __init__(self, x: np.ndarray, y: np.ndarray, calibrate: np.ndarray):
        self.const = 0.5 if not len(y) else float(y[0]) if len(set(y)) == 1 else None
        if self.const is not None:
            return
        fit = ~calibrate if len(set(y[~calibrate])) == 2 else np.ones(len(y), bool)
        self.mean, self.std = x[fit].mean(0), x[fit].std(0) + 1e-6
        r = np.random.default_rng(5)
        p = [r.normal(0, DIMS**-0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), r.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        first, second = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
        z, t = (x[fit] - self.mean) / self.std, y[fit]
        for step in range(1, 401):
            h = np.tanh(z @ p[0] + p[1])
            e = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - t) / len(t)
            back = np.outer(e, p[2]) * (1 - h**2)
            grads = [z.T @ back + 1e-4 * p[0], back.sum(0), h.T @ e + 1e-4 * p[2], e.sum(keepdims=True)]
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g**2
                p[i] -= 0.02 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        self.p, self.temperature = p, 1.0
        if calibrate.any():
            logit, t = self.logits(x[calibrate]), y[calibrate]
            grid = np.geomspace(0.25, 8, 61)
            loss = [np.mean(np.logaddexp(0, logit / g) - t * logit / g) for g in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    @classmethod
    def of(cls, state: dict) -> Network:
        net = cls.__new__(cls)
        vars(net).update(state)
        return net

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.std @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.const is not None:
            return np.full(len(x), self.const)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, Network]:
    """Word vectors from all of ``docs``, and the network from labelled rows that are not held out."""
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    known = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("y")).dropna()
    known = known.where(~held_out(F.col("id"))).select("id", "y", F.xxhash64("id").alias("h"))
    known = known.orderBy("h", "y").limit(MAX_LABELLED)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = _Codes()
        for b in batches:
            yield pd.DataFrame({"y": b["y"], "h": b["h"], "x": list(pooled(b["text"], shared.value, codes))})

    rows = docs.join(F.broadcast(known), docs["doc_id"] == known["id"]).select("text", "y", "h")
    # A label speaks for one text: of a doc_id that repeats, that with the smallest hash is the
    # sample's (max_by of the negated hash combines map-side), so at most MAX_LABELLED rows arrive.
    rows = rows.groupBy("h", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    got = rows.mapInPandas(run, "y double, h long, x array<float>").toPandas()
    got = got.sort_values(["h", "y"], kind="stable")
    x = np.stack(got["x"].to_list()).astype(float) if len(got) else np.zeros((0, DIMS))
    return vectors, Network(x, got["y"].to_numpy(), (got["h"].to_numpy() // 7) % 5 == 0)


def _scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc`` (struct of the columns of ``docs``) and ``score``."""
    vectors, network = fit(docs.select("doc_id", "text"), labels)
    shared = docs.sparkSession.sparkContext.broadcast((vectors, vars(network)))

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codes, (vecs, state) = _Codes(), shared.value
        net = Network.of(state)
        for part in texts:
            yield pd.Series(net.scores(pooled(part, vecs, codes)))

    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(doc.alias("doc"), F.pandas_udf(run, "double")(F.col("text")).alias("score"))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` on);
    columns of these names are replaced."""
    cols = [F.col("doc").getField(c).alias(c) for c in docs.columns if c not in ("score", "predicted")]
    return _scored(docs, labels).select(*cols, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, columns unchanged."""
    kept = _scored(docs, labels).where(F.col("score") >= THRESHOLD)
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
