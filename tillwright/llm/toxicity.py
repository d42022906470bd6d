"""Toxicity by maximum-scoring segments.

A token's score is its own log-odds between toxic and clean documents under a Dirichlet
prior that follows its share of the whole corpus, less CAUTION standard errors; so most
tokens score below zero, and a passage is a stretch with more toxic evidence than chance
explains. A word's stems (its first bytes) are counted the same way, and the greatest of
a word's own and its stems' log-odds counts. Tokens that the toxic sample has not, or
once only, have the log-odds of all such tokens together.

One linear scan (Ruzzo and Tompa's, with links between the candidates) finds all maximal
segments of a text. The expected number of segments of score S or more in n clean tokens
is K n exp(-lambda S); K and lambda are fitted to the greatest segments of the clean
labelled texts. Passages whose expected number is below SIGNIFICANT are reported. A
document's evidence is minus the log of the chance of its best segment, or the sum over
its significant ones, mapped to a probability on the labelled rows.

The labelled rows are a bounded sample (half of SAMPLE of each kind, the smallest by a
hash of the id); the UNITS most frequent words and stems of its toxic texts are scored;
the prior counts every document.

Defined results: null and empty texts have no tokens and the lowest score; of documents
that share a labelled id the one with the smallest hash of its text is learned from;
labels that repeat an id with another value each count; null labels are not learned from;
without labels of both kinds every score is 0; empty input gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import as_bytes, bounded_sample, keep, text_blocks
from tillwright.llm.words import LETTER, mix, split

SAMPLE = 20_000
BLOCK = 1_000_000
STEMS = (4, 5)
#: Words and stems that are scored at most.
UNITS = 300_000
#: Standard errors that a log-odds is lowered by.
CAUTION = 2.5
#: Evidence beyond this is certain either way and doesn't bend the final mapping.
CERTAIN = 30.0
#: The prior's weight as a share of the words of the toxic rows.
PRIOR = 0.25
SIGNIFICANT = 0.05
#: The least cost of a token that has no unit.
FLOOR = 0.05
#: Clean texts with a segment that the fit of both parameters needs.
FEW = 10
FILTER_BITS = 22


@dataclass
class Lexicon:
    """Sorted hashes of scored units (whole words, and stems by size) with a value each.

    ``other`` is the value of a token that has none of them.
    """

    hashes: np.ndarray
    values: np.ndarray
    other: float = 0.0
    maybe: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        # Many tokens are none of these: a bit table tells so before the search.
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[(self.hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among ``wanted`` that are in the lexicon, and their places in it."""
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.maybe[(wanted & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
        place = np.searchsorted(self.hashes, wanted[at])
        place[place == len(self.hashes)] = 0
        same = self.hashes[place] == wanted[at]
        return at[same], place[same]

    def values_of(self, words) -> tuple[np.ndarray, np.ndarray]:
        """Each token's value and the place of the unit that gave it (-1 if none did)."""
        value = np.full(len(words.hash), -np.inf)
        best = np.full(len(words.hash), -1, np.int64)
        for own in _units(words):
            at, place = self.find(own)
            better = self.values[place] > value[at]
            value[at[better]], best[at[better]] = self.values[place[better]], place[better]
        value[best < 0] = self.other
        return value, best


def _units(words) -> list[np.ndarray]:
    """Hashes of each word and of its stems."""
    return [words.hash, *(words.stem(size) for size in STEMS)]


def _words(texts: list[bytes]):
    words = split(texts, lower=True)
    letters = words.kind == LETTER
    for name in ("owner", "start", "stop", "kind", "hash"):
        setattr(words, name, getattr(words, name)[letters])
    return words


def _copy_key(words, texts: int) -> np.ndarray:
    """The smallest hash of each text's three-word runs, which copies share."""
    run = words.hash.copy()
    for away in (1, 2):
        run[:-away] = mix(run[:-away] * np.uint64(31) + words.hash[away:])
    key = np.zeros(texts, np.uint64)
    n = np.bincount(words.owner, minlength=texts)
    there = np.flatnonzero(n)
    if len(there):
        key[there] = np.minimum.reduceat(run, (np.cumsum(n) - n)[there])
    return key


def toxic_units(sample: DataFrame) -> DataFrame:
    """(unit, n): in how many toxic texts of the sample each unit is, two at least.

    Texts that share their copy key count once.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, block in text_blocks(as_bytes(batch.column(0)), BLOCK):
                words = _words(block)
                key = _copy_key(words, len(block))[words.owner]
                own = np.concatenate([np.stack([key, unit]) for unit in _units(words)], axis=1)
                key, unit = np.unique(own, axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(unit)], ["copy", "unit"])

    spread = sample.where("label > 0").select("own").mapInArrow(pairs, "copy long, unit long")
    return (
        spread.distinct().groupBy("unit").agg(F.count("*").alias("n")).where("n > 1")
    )


def distinct_words(rows: DataFrame, lexicon: Lexicon) -> dict[int, tuple[int, int]]:
    """Per label, sums over its texts of the distinct words in each: all, and those without a unit."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 2), np.int64)
        for batch in batches:
            label = np.array(batch.column(1).to_pylist(), np.int64)
            for first, block in text_blocks(as_bytes(batch.column(0)), BLOCK):
                words = _words(block)
                _, best = lexicon.values_of(words)
                order = np.lexsort((words.hash, words.owner))
                owner, own, none = words.owner[order], words.hash[order], best[order] < 0
                new = np.ones(len(own), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (own[1:] != own[:-1])
                for which, picked in enumerate((new, new & none)):
                    total[which] += np.bincount(label[first + owner[picked]], minlength=2)
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1]), pa.array(total[0]), pa.array(total[1])], ["label", "n", "n_other"]
        )

    summed = rows.select("own", "label").mapInArrow(gather, "label long, n long, n_other long")
    return {r[0]: (r[1], r[2]) for r in summed.groupBy("label").agg(F.sum("n"), F.sum("n_other")).collect()}


def document_counts(rows: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, int]:
    """In how many of the rows' texts each unit of the lexicon is, and the number of rows."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(lexicon.hashes)
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            total[size] += batch.num_rows
            for _, block in text_blocks(as_bytes(batch.column(0)), BLOCK):
                words = _words(block)
                for own in _units(words):
                    at, place = lexicon.find(own)
                    pair = np.unique(words.owner[at] * size + place)
                    total[:size] += np.bincount(pair % max(1, size), minlength=size)
        yield _nonzero(total)

    return _gathered(rows, gather, len(lexicon.hashes))


def token_counts(rows: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, int]:
    """How many tokens of the rows' texts take each unit's value, and the number of tokens."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(lexicon.hashes)
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            for _, block in text_blocks(as_bytes(batch.column(0)), BLOCK):
                words = _words(block)
                _, best = lexicon.values_of(words)
                total[size] += len(best)
                total[:size] += np.bincount(best[best >= 0], minlength=size)
        yield _nonzero(total)

    return _gathered(rows, gather, len(lexicon.hashes))


def _nonzero(total: np.ndarray) -> pa.RecordBatch:
    used = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["unit", "n"])


def _gathered(rows: DataFrame, gather, size: int) -> tuple[np.ndarray, int]:
    """Sums by unit: as many rows as the lexicon has come to the driver, and one total."""
    summed = rows.mapInArrow(gather, "unit long, n long").groupBy("unit").agg(F.sum("n").alias("n"))
    out = np.zeros(size + 1, np.int64)
    for unit, n in summed.collect():
        out[unit] = n
    return out[:-1], int(out[-1])


def maximal(before: list[float], after: list[float]) -> list[tuple[int, int]]:
    """All maximal scoring segments of a sequence, as (first, last) runs of positive tokens.

    A run is given by the totals of all tokens before it and up to its end. Each candidate
    has a link to the nearest earlier one with a smaller total before it, so that the
    search for one that a new run could extend skips those that it can't, and the whole
    scan is linear.
    """
    first: list[int] = []
    last: list[int] = []
    left: list[float] = []
    right: list[float] = []
    link: list[int] = []
    for i, (b, a) in enumerate(zip(before, after, strict=True)):
        start = i
        while True:
            j = len(first) - 1
            while j >= 0 and left[j] >= b:
                j = link[j]
            if j < 0 or right[j] >= a:
                break
            start, b = first[j], left[j]
            for own in (first, last, left, right, link):
                del own[j:]
        first.append(start)
        last.append(i)
        left.append(b)
        right.append(a)
        link.append(j)
    return list(zip(first, last, strict=True))


def segments(scores: list[float], places: list[int], drift: float) -> list[tuple[int, int, float]]:
    """All maximal segments, as (first place, last place, score), of tokens that cost ``drift``
    but for those at ``places``, which have positive scores."""
    total, at, before, after = 0.0, -1, [], []
    for value, place in zip(scores, places, strict=True):
        total -= drift * (place - at - 1)
        before.append(total)
        total += value
        after.append(total)
        at = place
    return [(places[a], places[b], after[b] - before[a]) for a, b in maximal(before, after)]


def decay(values: np.ndarray, counts: np.ndarray) -> float:
    """Lambda: the positive root of sum p exp(lambda s) = 1, for scores of negative mean."""
    p = counts / counts.sum()
    low, high = 0.0, 1.0
    while high < 50 and (p * np.exp(np.minimum(high * values, 600))).sum() < 1:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        if (p * np.exp(np.minimum(middle * values, 600))).sum() < 1:
            low = middle
        else:
            high = middle
    return high


def extreme_value(best: np.ndarray, tokens: np.ndarray, start: float) -> tuple[float, float]:
    """Lambda and K by maximum likelihood from the greatest segment scores of clean texts.

    P(best <= x) is exp(-K n exp(-lambda x)). A text without a segment (best 0) says that
    none was above zero. For each lambda the best K has a closed form; lambda is searched
    around ``start``.
    """
    n = np.maximum(tokens, 1).astype(float)
    there = best > 0
    if there.sum() < FEW:
        # Too few to fit both: as many segments as there are, at the scores' own rate.
        return start, float(max(there.sum(), 1) / n.sum())

    def fitted(rate: float) -> tuple[float, float]:
        decayed = n * np.exp(-rate * best)
        k = there.sum() / decayed.sum()
        chance = there.sum() * (np.log(rate) + np.log(k)) - rate * best[there].sum() - k * decayed.sum()
        return float(chance), float(k)

    rate = max(np.geomspace(start / 8, start * 8, 97), key=lambda r: fitted(r)[0])
    return float(rate), fitted(rate)[1]


@dataclass
class Judge:
    """The lexicon, the extreme-value parameters and the final mapping."""

    lexicon: Lexicon
    rate: float
    scale: float
    slope: float = 1.0
    offset: float = 0.0
    known: bool = True

    def found(self, texts: list[bytes]):
        """The words, the number in each text, and per text its maximal segments (first, last, score)."""
        words = _words(texts)
        value, _ = self.lexicon.values_of(words)
        n = np.bincount(words.owner, minlength=len(texts))
        hot = value > 0
        fresh = np.ones(len(hot), bool)
        fresh[1:] = words.owner[1:] != words.owner[:-1]
        begins = np.flatnonzero(hot & (fresh | ~np.concatenate([[False], hot[:-1]])))
        ends = np.flatnonzero(hot & np.concatenate([fresh[1:] | ~hot[1:], [True]])) if len(hot) else begins
        total = np.concatenate([[0.0], np.cumsum(value)])
        before, after, owner = total[begins], total[ends + 1], words.owner[begins]
        out: list[list[tuple[int, int, float]]] = [[] for _ in texts]
        edges = np.flatnonzero(np.diff(owner)) + 1
        for part in np.split(np.arange(len(begins)), edges) if len(begins) else []:
            b, a = before[part].tolist(), after[part].tolist()
            at = part[0]
            out[owner[at]] = [
                (int(begins[at + x]), int(ends[at + y]), a[y] - b[x]) for x, y in maximal(b, a)
            ]
        return words, n, out

    def passages(self, texts: list[bytes]) -> list[tuple[float, list[tuple[int, int, float, float]]]]:
        """Per text: its evidence, and the significant passages (start, stop, score, expected).

        Places are code points, as in the text.
        """
        words, n, found = self.found(texts)
        out: list[tuple[float, list]] = []
        for i, own in enumerate(found):
            evidence, significant = 0.0, []
            base = int(words.text_start[i])
            for a, b, score in own:
                expected = self.expected(score, int(n[i]))
                evidence = max(evidence, _surprise(expected))
                if expected <= SIGNIFICANT:
                    begin, end = int(words.start[a]), int(words.stop[b])
                    points = (words.raw[base:end] & 0xC0) != 0x80
                    significant.append((int(points[: begin - base].sum()), int(points.sum()), score, expected))
            if significant:
                evidence = sum(_surprise(e) for *_, e in significant)
            out.append((evidence, significant))
        return out

    def expected(self, score: float, tokens: int) -> float:
        """Segments of such a score by chance in so many tokens."""
        return float(self.scale * max(tokens, 1) * np.exp(-min(self.rate * score, 700.0)))

    def probability(self, evidence: float) -> float:
        if not self.known:
            return 0.0
        z = self.slope * min(evidence, CERTAIN) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _surprise(expected: float) -> float:
    """Minus the log of the chance of one such segment or more."""
    return float(-np.log(-np.expm1(-expected))) if expected > 1e-12 else float(-np.log(max(expected, 1e-300)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a one-variable logistic fit (Newton steps, lightly damped)."""
    center, spread = x.mean(), x.std() + 1e-6
    t = (x - center) / spread
    w = np.zeros(2)
    design = np.stack([t, np.ones_like(t)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + 1e-3 * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        w -= np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return float(w[0] / spread), float(w[1] - w[0] * center / spread)


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE
) -> Judge:
    """Class counts from a bounded sample of labelled rows, the prior from all of ``docs``."""
    marked = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).select(
        F.col(doc_id).alias("label_id"), (F.col(label) > 0).cast("int").alias("label")
    )
    picked = [
        bounded_sample(marked.where(F.col("label") == v), sample // 2, "label_id").select("label_id", "label")
        for v in (0, 1)
    ]
    asked = F.broadcast(keep(picked[0].union(picked[1]), "labels"))  # ``sample`` rows at most
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("own"))
    # One document per label, so that what comes of a repeated id is bounded as well.
    rows = keep(
        own.join(asked, F.col("doc_id") == F.col("label_id"))
        .groupBy("label_id", "label").agg(F.min_by("own", F.xxhash64("own")).alias("own")),
        "labelled",
    )
    return _train(docs.select(text), rows)


def _train(corpus: DataFrame, rows: DataFrame) -> Judge:
    sizes = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    n_bad, n_good = sizes.get(1, 0), sizes.get(0, 0)
    if not n_bad or not n_good:
        return Judge(Lexicon(np.zeros(0, np.uint64), np.zeros(0)), 1.0, 1.0, known=False)
    most = toxic_units(rows).orderBy(F.desc("n"), "unit").limit(UNITS)
    found = np.array([tuple(r) for r in most.collect()], np.int64).reshape(-1, 2)
    names, bad = found[:, 0].view(np.uint64), found[:, 1]
    order = np.argsort(names)
    names, bad = names[order], bad[order]
    every = Lexicon(names, np.zeros(len(names)))
    counts, n_all = document_counts(corpus, every)
    clean = rows.where("label = 0").select("own")
    good, _ = document_counts(clean, every)
    # Shares are of all distinct words in a class's texts, so that long texts and very
    # common words weigh no more than they should.
    sums = distinct_words(rows, every)
    (all_good, other_good), (all_bad, other_bad) = sums.get(0, (0, 0)), sums.get(1, (0, 0))
    all_bad, all_good = all_bad + 1, all_good + 1
    weight = PRIOR * all_bad

    def odds(bad, good, share):
        a, b = bad + weight * share, good + weight * share
        out = np.log(a / (all_bad + weight)) - np.log(b / (all_good + weight))
        return out - CAUTION * np.sqrt(1 / a + 1 / b)

    share = np.maximum(counts, 1) / (max(n_all, 1) * (all_bad + all_good) / (n_bad + n_good))
    other = odds(other_bad, other_good, max(other_bad + other_good, 1) / (all_bad + all_good))
    judge = Judge(Lexicon(names, odds(bad, good, share), float(min(other, -FLOOR))), 1.0, 1.0)
    best, tokens = _best_segments(judge, clean)
    judge.rate, judge.scale = extreme_value(best, tokens, _rate(judge.lexicon, clean))
    seen = rows.select(score(judge, F.col("own"))["evidence"].alias("evidence"), "label", "label_id")
    pairs = sorted((r.label_id, r.label, r.evidence) for r in seen.collect())
    judge.slope, judge.offset = _logistic(
        np.minimum([e for _, _, e in pairs], CERTAIN), np.array([float(v) for _, v, _ in pairs])
    )
    return judge


def _best_segments(judge: Judge, clean: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The greatest segment score (0 if none) and the number of tokens of every clean text."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, block in text_blocks(as_bytes(batch.column(0)), BLOCK):
                _, n, found = judge.found(block)
                best = [max((s for *_, s in own), default=0.0) for own in found]
                yield pa.RecordBatch.from_arrays([pa.array(best, pa.float64()), pa.array(n)], ["best", "n"])

    pairs = sorted(map(tuple, clean.mapInArrow(gather, "best double, n long").collect()))  # of the sample
    return np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])


def _rate(lexicon: Lexicon, clean: DataFrame) -> float:
    """Lambda from the token scores of clean texts; the strongest score counts once more."""
    if not len(lexicon.hashes) or lexicon.values.max() <= 0:
        return 1.0
    counts, tokens = token_counts(clean, lexicon)
    counts[lexicon.values.argmax()] += 1
    none = max(tokens - int(counts.sum()), 1)
    values = np.concatenate([[lexicon.other], lexicon.values])
    counts = np.concatenate([[none], counts]).astype(float)
    mean = (counts * values).sum()
    if mean >= 0:  # so little text that chance outweighs: enough other tokens that it does not
        counts[0] += 2 * mean / -lexicon.other
    return decay(values, counts)


def score(judge: Judge, text: Column) -> Column:
    """Struct of score, evidence and passages (start, stop in code points, score, expected)."""
    passage = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())])
    kind = pa.struct([("score", pa.float64()), ("evidence", pa.float64()), ("passages", pa.list_(passage))])

    @F.arrow_udf("score double, evidence double, passages array<struct<start:int,stop:int,score:double,expected:double>>")
    def apply(column: pa.Array) -> pa.Array:
        out = []
        for _, block in text_blocks(as_bytes(column), BLOCK):
            for evidence, found in judge.passages(block):
                out.append(
                    {
                        "score": judge.probability(evidence),
                        "evidence": evidence,
                        "passages": [dict(zip(("start", "stop", "score", "expected"), p, strict=True)) for p in found],
                    }
                )
        return pa.array(out, kind)

    return apply(text)
