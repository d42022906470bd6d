"""Language ID by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time, with a loss at every
byte. A text is read whole, in windows of WINDOW bytes: each direction starts afresh
in a window, every byte gets a probability of each language, and the text's
probabilities are their mean.

The training rows are a bounded sample (SAMPLE rows, of each language the smallest by
a hash of id and text, one stretch of STRETCH characters each). Every language has an equal
share, and what a rare one leaves goes to the others. Predictions cover every row.

Defined results: a text that is null or has no letter is ``und`` with score 0; equal
texts have equal results; without any labelled row every text is ``und``; empty input
gives an empty result; all columns of the input are kept, and a column that has the
result's name is replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.common import as_bytes, text_blocks

SAMPLE = 4000
STRETCH = 400
#: Languages that are learned at most; where there are more, the most frequent ones.
LANGUAGES = 1000
WINDOW = 128
HIDDEN = 8
STEPS = 500
BATCH = 128
TRAIN_WINDOW = 64
ROWS_AT_ONCE = 1024
UNDETERMINED = "und"
ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    return bool(ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode())


@dataclass
class Network:
    """Weights by direction: of the input bytes (256 x 3H), of the state (H x 3H), of the output."""

    labels: list[str]
    byte_in: np.ndarray
    state_in: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.byte_in, self.state_in, self.out, self.bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _start(labels: list[str], rng: np.random.Generator) -> Network:
    h = HIDDEN
    return Network(
        labels,
        rng.normal(0, 0.3, (2, 256, 3 * h)).astype("f4"),
        rng.normal(0, 0.3, (2, h, 3 * h)).astype("f4"),
        rng.normal(0, 0.3, (2, h, len(labels))).astype("f4"),
        np.zeros(len(labels), "f4"),
    )


def _gradients(net: Network, windows: np.ndarray, truth: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean loss over all bytes; windows are (rows, time)."""
    h, rows, time = HIDDEN, *windows.shape
    both = np.stack([windows, windows[:, ::-1]])
    steps = []
    state = np.zeros((2, rows, h), "f4")
    states = np.zeros((2, time, rows, h), "f4")
    for t in range(time):
        a = np.stack([net.byte_in[d][both[d, :, t]] for d in (0, 1)])
        u = state @ net.state_in
        gates = _sigmoid(a[..., : 2 * h] + u[..., : 2 * h])
        r, z = gates[..., :h], gates[..., h:]
        n = np.tanh(a[..., 2 * h :] + r * u[..., 2 * h :])
        steps.append((state, r, z, n, u[..., 2 * h :]))
        state = z * state + (1 - z) * n
        states[:, t] = state
    # The second direction's states back in the order of the text.
    forward, backward = states[0], states[1, ::-1]
    logits = forward @ net.out[0] + backward @ net.out[1] + net.bias
    p = np.exp(logits - logits.max(-1, keepdims=True))
    p /= p.sum(-1, keepdims=True)
    p[:, np.arange(rows), truth] -= 1
    p /= rows * time
    d_out = np.stack([np.einsum("trh,trl->hl", s, p) for s in (forward, backward)])
    d_states = np.stack([p @ net.out[0].T, (p @ net.out[1].T)[::-1]])
    d_byte, d_state_in = np.zeros_like(net.byte_in), np.zeros_like(net.state_in)
    d_next = np.zeros((2, rows, h), "f4")
    for t in reversed(range(time)):
        before, r, z, n, u_n = steps[t]
        d = d_states[:, t] + d_next
        d_n = d * (1 - z) * (1 - n * n)
        d_z = d * (before - n) * z * (1 - z)
        d_r = d_n * u_n * r * (1 - r)
        d_u = np.concatenate([d_r, d_z, d_n * r], -1)
        d_a = np.concatenate([d_r, d_z, d_n], -1)
        d_state_in += before.transpose(0, 2, 1) @ d_u
        d_next = d * z + d_u @ net.state_in.transpose(0, 2, 1)
        for k in (0, 1):
            np.add.at(d_byte[k], both[k, :, t], d_a[k])
    return [d_byte, d_state_in, d_out, p.sum((0, 1))]


def train(texts: list[bytes], langs: list[str], seed: int = 7) -> Network | None:
    """Fit the network; classes are drawn evenly. None without any label."""
    labels = sorted(set(langs))
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    net = _start(labels, rng)
    by_label = {v: [t for t, own in zip(texts, langs, strict=True) if own == v and t] for v in labels}
    drawn_from = [v for v in labels if by_label[v]]
    if not drawn_from:
        return net
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.parts()]
    for step in range(1, STEPS + 1):
        windows = np.zeros((BATCH, TRAIN_WINDOW), np.uint8)
        truth = np.zeros(BATCH, np.int64)
        for i in range(BATCH):
            label = drawn_from[i % len(drawn_from)]
            text = by_label[label][rng.integers(len(by_label[label]))]
            at = rng.integers(max(1, len(text) - TRAIN_WINDOW + 1))
            own = text[at : at + TRAIN_WINDOW]
            windows[i, : len(own)] = np.frombuffer(own, np.uint8)
            truth[i] = labels.index(label)
        rate = 0.02 * (1 - step / (STEPS + 1))
        for w, g, (m, v) in zip(net.parts(), _gradients(net, windows, truth), moments, strict=True):
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def _run(byte_in: np.ndarray, state_in: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """(time, H, rows) states of one direction; windows are (time, rows).

    Rows come last, so that each step works on long contiguous stretches. The
    weights of the two gates have the half of the logistic function folded in.
    """
    h = HIDDEN
    time, rows = windows.shape
    states = np.empty((time, h, rows), "f4")
    state = np.zeros((h, rows), "f4")
    u = np.empty((3 * h, rows), "f4")
    weights = np.ascontiguousarray(state_in.T)
    for t in range(time):
        a = np.ascontiguousarray(byte_in.take(windows[t], axis=0, mode="clip").T)
        np.matmul(weights, state, out=u)
        gates = a[: 2 * h]
        gates += u[: 2 * h]
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        n = u[2 * h :]
        n *= gates[:h]
        n += a[2 * h :]
        np.tanh(n, out=n)
        state = np.subtract(state, n, out=states[t])
        state *= gates[h:]
        state += n
    return states


class Labeller:
    """Probabilities of each language for every byte, and pooled for a text."""

    def __init__(self, net: Network):
        half = np.concatenate([np.full(2 * HIDDEN, 0.5), np.ones(HIDDEN)]).astype("f4")
        self.labels = net.labels
        self.byte_in, self.state_in = net.byte_in * half, net.state_in * half
        self.out, self.bias = net.out, net.bias

    def positions(self, windows: np.ndarray) -> np.ndarray:
        """(time, labels, rows) probabilities of windows given as (time, rows)."""
        forward = _run(self.byte_in[0], self.state_in[0], windows)
        backward = _run(self.byte_in[1], self.state_in[1], windows[::-1])[::-1]
        p = self.out[0].T @ forward
        p += self.out[1].T @ backward
        p += self.bias[:, None]
        p -= p.max(1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        return p

    def pooled(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: mean probability of each label, and bytes labelled with it."""
        lengths = np.array([len(t) for t in texts], np.int64)
        counts = -(-lengths // WINDOW)
        total = int(counts.sum())
        padded = np.zeros(total * WINDOW, np.uint8)
        raw = np.frombuffer(b"".join(texts), np.uint8)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]]) * WINDOW
        shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        padded[np.arange(len(raw)) + shift] = raw
        windows = padded.reshape(total, WINDOW)
        owner = np.repeat(np.arange(len(texts)), counts)
        nth = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
        valid = np.minimum(lengths[owner] - nth * WINDOW, WINDOW)
        sums = np.zeros((len(texts), len(self.labels)))
        marks = np.zeros((len(texts), len(self.labels)), np.int64)
        for i in range(0, total, ROWS_AT_ONCE):
            part = slice(i, i + ROWS_AT_ONCE)
            p = self.positions(np.ascontiguousarray(windows[part].T))
            p *= (np.arange(WINDOW)[:, None] < valid[part])[:, None]
            top = p.max(1)
            top[top == 0] = 2  # beyond the text's end
            np.add.at(sums, owner[part], p.sum(0).T)
            np.add.at(marks, owner[part], (p == top[:, None]).sum(0).T)
        return sums / np.maximum(lengths, 1)[:, None], marks


def predict(net: Network | None, text: Column) -> Column:
    """Struct of lang, score and label_bytes (bytes labelled with each language)."""
    labeller = Labeller(net) if net else None
    kind = pa.struct(
        [("lang", pa.string()), ("score", pa.float64()), ("label_bytes", pa.list_(pa.int64()))]
    )

    @F.arrow_udf("lang string, score double, label_bytes array<bigint>")
    def label(column: pa.Array) -> pa.Array:
        out = []
        for _, block in text_blocks(as_bytes(column)):
            if labeller is None:
                out += [{"lang": UNDETERMINED, "score": 0.0, "label_bytes": []} for _ in block]
                continue
            pooled, marks = labeller.pooled(block)
            best = pooled.argmax(1)
            for i, t in enumerate(block):
                known = has_letter(t)
                out.append(
                    {
                        "lang": labeller.labels[best[i]] if known else UNDETERMINED,
                        "score": float(min(1.0, pooled[i, best[i]])) if known else 0.0,
                        "label_bytes": marks[i].tolist(),
                    }
                )
        return pa.array(out, kind)

    return label(text)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves that remainder; a null id is not held out."""
    own = F.crc32(doc_id.cast("string").cast("binary")) % parts == part
    return F.coalesce(own, F.lit(False))


def _share(counts: list[int], size: int) -> int:
    """Rows of each language at most, so that all have ``size`` together (one each at least)."""
    left = size
    for place, n in enumerate(sorted(counts)):
        each = left // (len(counts) - place)
        if n > each:
            return max(1, each)
        left -= n
    return max(counts, default=1)


def learn(rows: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Network | None:
    """Train on a bounded sample of the rows with a language, a share of it for each."""
    usable = rows.where(F.col(lang).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    )
    # One row per language comes to the driver, of LANGUAGES at most: the most frequent.
    # Rows alike count once (a sketch's count does, since it only sets the cut's width).
    ordered = usable.withColumn("order", F.xxhash64("doc_id", "text"))
    sizes = ordered.groupBy("lang").agg(F.approx_count_distinct("order").alias("n"))
    counts = {r[0]: max(r[1], 1) for r in sizes.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    each = _share(list(counts.values()), sample)
    wanted = each + each // 2 + 200  # a cut at the hash first, as in bounded_sample
    cuts = [(k, -(1 << 63) + (1 << 64) * min(wanted, n) // n - (n <= wanted)) for k, n in counts.items()]
    near = (
        ordered.join(F.broadcast(rows.sparkSession.createDataFrame(cuts, "lang string, cut long")), "lang")
        .where("order <= cut")
    )
    start = 1 + F.pmod(F.col("order"), F.greatest(F.char_length("text") - STRETCH, F.lit(1)))
    stretch = F.coalesce(F.col("text").substr(start.cast("int"), F.lit(STRETCH)), F.lit(""))
    first = Window.partitionBy("lang").orderBy("order", "doc_id", "stretch")
    # Rows alike count once, so that no hot row fills a language's window.
    own = near.select("lang", "order", "doc_id", stretch.alias("stretch")).distinct()
    cut = own.withColumn("nth", F.row_number().over(first))
    picked = sorted(cut.where(F.col("nth") <= each).collect(), key=lambda r: (r.lang, r.stretch))
    return train([r.stretch.encode() for r in picked], [r.lang for r in picked])


def label_languages(
    docs: DataFrame,
    training: DataFrame,
    name: str = "language",
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """All rows and columns of ``docs`` with the struct ``name`` (lang, score, label_bytes)."""
    return docs.withColumn(name, predict(learn(training, doc_id, text, lang), F.col(text)))
