"""Quality classifier: random-indexing word vectors, then a two-layer network.

Every word has a sparse random index vector (fixed by its hash); its context vector is
the sum of the index vectors of the words around it, over all documents. Words are
kept in BUCKETS hashed rows, so the vectors are a table of fixed size however large
the vocabulary; it is summed by partition, then by row in a shuffle. A document is
the mean and the spread of its words' unit vectors, its share of different words and
the log of their number. The network is trained in numpy on
a bounded sample of labelled rows (SAMPLE, the smallest by a hash of the id), and a
temperature fitted on a part it did not train on calibrates its probabilities.

Defined results: null and empty texts score like a text without words; of documents that
share a labelled id the one with the smallest hash of its text is learned from; labels
that repeat an id with another value each count; null labels are not learned from;
without labels of both kinds every score is the share of 1 (0.5 without any); empty
input gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import as_bytes, bounded_sample, keep, text_blocks
from tillwright.llm.words import split

BUCKETS = 1 << 14
SIZE = 32
NONZERO = 4
REACH = 2
SAMPLE = 20_000
HIDDEN = 16
FEATURES = 2 * SIZE + 2
EPOCHS = 40
BLOCK = 1_000_000


def _rows(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


def _add_contexts(total: np.ndarray, texts: list[bytes]) -> None:
    """Add, for every word, the index vectors of the words up to REACH away in its text."""
    words = split(texts)
    row = _rows(words.hash)
    entries = []
    for k in range(NONZERO):
        bits = words.hash >> np.uint64(20 + 6 * k)
        entries.append(((bits & np.uint64(SIZE - 1)).astype(np.int64), 1 - 2 * ((bits >> np.uint64(5)) & np.uint64(1)).astype(np.int64)))
    flat = total.reshape(-1)
    for away in range(1, REACH + 1):
        same = words.owner[away:] == words.owner[:-away]
        for left, right in ((slice(None, -away), slice(away, None)), (slice(away, None), slice(None, -away))):
            for place, sign in entries:
                at = row[left][same] * SIZE + place[right][same]
                flat += np.bincount(at, weights=sign[right][same], minlength=BUCKETS * SIZE).astype(np.int64)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The BUCKETS x SIZE table of context vectors over all rows, rows scaled to length 1."""
    columns = [f"v{i}" for i in range(SIZE)]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, SIZE), np.int64)
        for batch in batches:
            for _, block in text_blocks(as_bytes(batch.column(0)), BLOCK):
                _add_contexts(total, block)
        used = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), *(pa.array(total[used, i]) for i in range(SIZE))], ["row", *columns]
        )

    schema = "row long, " + ", ".join(f"{c} long" for c in columns)
    summed = (
        docs.select(text).mapInArrow(gather, schema).groupBy("row").agg(*(F.sum(c).alias(c) for c in columns))
    )
    out = np.zeros((BUCKETS, SIZE), "f4")
    for row in summed.collect():  # BUCKETS rows at most
        out[row[0]] = row[1:]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def pool(vectors: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Mean and spread of each text's word vectors, its share of different words, the log of their number."""
    words = split(texts)
    n = np.bincount(words.owner, minlength=len(texts))
    out = np.zeros((len(texts), FEATURES))
    if len(words.owner):
        own = vectors[_rows(words.hash)]
        there = np.flatnonzero(n)
        first = (np.cumsum(n) - n)[there]
        mean = np.add.reduceat(own, first, axis=0) / n[there, None]
        square = np.add.reduceat(own * own, first, axis=0) / n[there, None]
        out[there, :SIZE] = mean
        out[there, SIZE : 2 * SIZE] = np.sqrt(np.maximum(square - mean * mean, 0))
        order = np.lexsort((words.hash, words.owner))
        owner, each = words.owner[order], words.hash[order]
        new = np.ones(len(each), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (each[1:] != each[:-1])
        out[there, 2 * SIZE] = np.bincount(owner[new], minlength=len(texts))[there] / n[there]
    out[:, -1] = np.log1p(n) / 10
    return out


@dataclass
class Scorer:
    """Two layers and a temperature; ``constant`` stands in when nothing can be learned."""

    vectors: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float = 1.0
    constant: float | None = None

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return (np.tanh(((pooled - self.center) / self.scale) @ w1 + b1) @ w2 + b2)[:, 0]

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        z = self.logits(pool(self.vectors, texts)) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def fit(vectors: np.ndarray, pooled: np.ndarray, y: np.ndarray, seed: int = 11) -> Scorer:
    center, scale = np.zeros(FEATURES), np.ones(FEATURES)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        return Scorer(vectors, center, scale, [], constant=share)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    cut = max(1, len(y) // 6)
    held, used = order[:cut], order[cut:]
    center, scale = pooled[used].mean(0), pooled[used].std(0) + 1e-3
    x = (pooled - center) / scale
    weights = [
        rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 1)), np.zeros(1),
    ]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(used), max(1, len(used) // 128)):
            step += 1
            w1, b1, w2, b2 = weights
            h = np.tanh(x[part] @ w1 + b1)
            z = (h @ w2 + b2)[:, 0]
            d = ((1 / (1 + np.exp(-np.clip(z, -30, 30)))) - y[part])[:, None] / len(part)
            dh = (d @ w2.T) * (1 - h * h)
            grads = [x[part].T @ dh + 1e-4 * w1, dh.sum(0), h.T @ d + 1e-4 * w2, d.sum(0)]
            for i, g in enumerate(grads):
                m[i] += 0.1 * (g - m[i])
                v[i] += 0.01 * (g * g - v[i])
                weights[i] = weights[i] - 0.005 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)
    scorer = Scorer(vectors, center, scale, weights)
    z = scorer.logits(pooled[held])
    scorer.temperature = min(np.geomspace(0.25, 8, 60), key=lambda t: _loss(z / t, y[held]))
    return scorer


def _per_text(function, kind: str, text: Column) -> Column:
    """A column made of ``function`` over blocks of whole texts."""

    @F.arrow_udf(kind)
    def apply(column: pa.Array) -> pa.Array:
        out: list = []
        for _, block in text_blocks(as_bytes(column), BLOCK):
            out += function(block).tolist()
        return pa.array(out, pa.float64() if kind == "double" else pa.list_(pa.float64()))

    return apply(text)


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> Scorer:
    """Word vectors from all of ``docs``, the network from a bounded sample of ``labels``."""
    vectors = word_vectors(docs, text)
    marked = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).select(
        F.col(doc_id).alias("label_id"), F.col(label).cast("int").alias("label")
    )
    picked = bounded_sample(marked, sample, "label_id").select("label_id", "label")
    asked = F.broadcast(keep(picked, "labels"))  # SAMPLE rows at most
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("own"))
    # One document per label, so that what comes of a repeated id is bounded as well.
    one = (
        own.join(asked, F.col("doc_id") == F.col("label_id"))
        .groupBy("label_id", "label").agg(F.min_by("own", F.xxhash64("own")).alias("own"))
    )
    found = one.select(
        _per_text(lambda b: pool(vectors, b), "array<double>", F.col("own")).alias("pooled"), "label_id", "label"
    ).collect()
    found.sort(key=lambda r: (r.label_id, r.label, r.pooled))
    pooled = np.array([r.pooled for r in found]).reshape(len(found), FEATURES)
    return fit(vectors, pooled, np.array([float(r.label > 0) for r in found]))


def score(scorer: Scorer, text: Column) -> Column:
    return _per_text(scorer.score, "double", text)
