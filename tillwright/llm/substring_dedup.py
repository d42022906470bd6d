"""Substring dedup: runs of consecutive sentences that occur again are removed.

A sentence ends at a line's end or at ``.``, ``!`` or ``?`` before white space. Every
run of RUN consecutive sentences is hashed (128 bits over the words, white space made
one space). One below MIN_WORDS is lengthened, forwards from its first sentence and
backwards from its last, until it has as many, so that a passage of tiny sentences is
found from its first to its last. A sentence or a pair of LONG words or more is a run
besides, so that a long passage is found however few sentences it has. Runs meet in one shuffled
aggregation, which names the first occurrence of each, and the runs that occur again
are joined back to it. A sentence inside any occurrence but the first goes.

Occurrences are ordered by the document's id, then a hash of its text, then the place.
A document is named by its id and 128 bits of its text's hashes.

Defined results: null and empty texts stay as empty texts; a document whose every
sentence is a repeat becomes empty; rows that repeat an id are documents of their own,
and rows equal in id and text are one document; a null id is ordered first; empty input
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import TEXT_MARKS, Scratch, as_bytes, keep, text_blocks, text_marks

RUN = 3
#: Words of a run at least, so that a few tiny sentences don't count.
MIN_WORDS = 8
#: A sentence counts a word for so many bytes at least: some scripts have no spaces.
WORD_BYTES = 16
#: From so many words on, one or two sentences are a run.
LONG = 40
#: A sentence with the white space after it; offsets are bytes of the UTF-8.
SENTENCE = re.compile(rb"[^\n]*?(?:[.!?]+(?=\s)|\n|\Z)\s*", re.DOTALL)

NAME = ["doc_id", *TEXT_MARKS]
SPAN_SCHEMA = "h1 long, h2 long, first int, last int, " + ", ".join(f"{n} long" for n in NAME)


def sentences(text: bytes) -> list[tuple[int, int]]:
    """Byte ranges of the sentences; they cover the whole text."""
    return [m.span() for m in SENTENCE.finditer(text) if m.end() > m.start()]


def _weight(joined: bytes) -> int:
    """Words of a sentence; text written without spaces counts by its length."""
    return max(joined.count(b" ") + 1, len(joined) // WORD_BYTES) if joined else 0


def _run_arrays(
    text: bytes, run: int = RUN, min_words: int = MIN_WORDS, long: int = LONG
) -> tuple[np.ndarray, np.ndarray, bytes]:
    """First and last sentence of every run, and their hashes, 16 bytes each.

    Runs are held as numbers, not as objects: a long text has millions.
    """
    joined = [b" ".join(text[a:b].split()) for a, b in sentences(text)]
    n = len(joined)
    before = array("q", [0, *accumulate(map(_weight, joined))])
    found = array("q")  # first * (n + 1) + end
    end = 0  # behind the shortest run from i; never falls
    for i in range(n):
        for k in range(i + 1, min(i + run, n + 1)):
            if before[k] - before[i] >= long:
                found.append(i * (n + 1) + k)
        end = max(end, i + run)
        while end <= n and before[end] - before[i] < min_words:
            end += 1
        if end <= n:
            found.append(i * (n + 1) + end)
    start = n  # of the shortest run up to k
    for k in range(n, run - 1, -1):
        start = min(start, k - run)
        while start >= 0 and before[k] - before[start] < min_words:
            start -= 1
        if start < 0:
            break
        found.append(start * (n + 1) + k)
    pairs = np.unique(np.frombuffer(found, np.int64)) if found else np.zeros(0, np.int64)
    firsts, ends = pairs // (n + 1), pairs % (n + 1)
    out = bytearray(16 * len(pairs))
    for at, (i, k) in enumerate(zip(firsts, ends, strict=True)):
        out[16 * at : 16 * at + 16] = xxhash.xxh3_128_digest(b" ".join(joined[i:k]))
    return firsts.astype(np.int32), (ends - 1).astype(np.int32), bytes(out)


def runs(text: bytes, run: int = RUN, min_words: int = MIN_WORDS, long: int = LONG) -> list[tuple[int, int, bytes]]:
    """(first sentence, last sentence, 16-byte hash) of every run."""
    firsts, lasts, hashes = _run_arrays(text, run, min_words, long)
    return [(int(a), int(b), hashes[16 * i : 16 * i + 16]) for i, (a, b) in enumerate(zip(firsts, lasts, strict=True))]


def _spans(rows: DataFrame) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, block in text_blocks(as_bytes(batch.column(0)), 1_000_000):
                made = [_run_arrays(t) for t in block]
                counts = [len(firsts) for firsts, _, _ in made]
                if not any(counts):
                    continue
                hashes = np.frombuffer(b"".join(h for *_, h in made), "<i8").reshape(-1, 2)
                own = pa.array(np.repeat(np.arange(first, first + len(block)), counts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.ascontiguousarray(hashes[:, 0])),
                        pa.array(np.ascontiguousarray(hashes[:, 1])),
                        pa.array(np.concatenate([f for f, *_ in made])),
                        pa.array(np.concatenate([last for _, last, _ in made])),
                        *[batch.column(n).take(own) for n in NAME],
                    ],
                    ["h1", "h2", "first", "last", *NAME],
                )

    return rows.select("text", *NAME).mapInArrow(emit, SPAN_SCHEMA)


def _rebuilt(text: bytes, firsts: list[int], lasts: list[int]) -> tuple[bytes, int, int]:
    """The text without the covered sentences, their number, and the number of all."""
    own = sentences(text)
    gone = np.zeros(len(own) + 1, np.int64)
    np.add.at(gone, firsts, 1)
    np.add.at(gone, np.array(lasts, np.int64) + 1, -1)
    covered = np.cumsum(gone)[:-1] > 0
    rest = b"".join(text[a:b] for (a, b), c in zip(own, covered, strict=True) if not c)
    return rest, int(covered.sum()), len(own)


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, text (what stays), n_sentences, n_removed, n_chars_removed."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *text_marks(text))
    spans = scratch.keep(_spans(rows), "spans")
    place = F.struct(*NAME, "first")
    again = (
        spans.groupBy("h1", "h2")
        .agg(F.min(place).alias("origin"), F.max(place).alias("other"))
        .where("origin != other")
        .select("h1", "h2", "origin")
    )
    again = scratch.keep(again, "repeated-spans")
    repeats = (
        spans.join(again, ["h1", "h2"])
        .where(~place.eqNullSafe(F.col("origin")))
        .groupBy(*NAME)
        .agg(F.collect_set(F.struct("first", "last")).alias("cover"))
    )
    repeats = keep(repeats, "covered")
    scratch.drop()

    kind = pa.struct([("text", pa.string()), ("n_removed", pa.int64()), ("n_sentences", pa.int64())])

    @F.arrow_udf("text string, n_removed long, n_sentences long")
    def rebuild(texts: pa.Array, covers: pa.Array) -> pa.Array:
        out = []
        for raw, cover in zip(as_bytes(texts), covers.to_pylist(), strict=True):
            cover = cover or []
            rest, gone, total = _rebuilt(raw or b"", [c["first"] for c in cover], [c["last"] for c in cover])
            out.append({"text": rest.decode(), "n_removed": gone, "n_sentences": total})
        return pa.array(out, kind)

    marks = [rows[n] == repeats[n] for n in TEXT_MARKS]
    same = rows["doc_id"].eqNullSafe(repeats["doc_id"]) & marks[0] & marks[1]
    found = rows.join(repeats, same, "left").select(
        rows["doc_id"],
        F.char_length(F.coalesce("text", F.lit(""))).alias("n_before"),
        rebuild("text", "cover").alias("new"),
    )
    return found.select(
        "doc_id",
        "new.text",
        "new.n_sentences",
        "new.n_removed",
        (F.col("n_before") - F.char_length("new.text")).cast("long").alias("n_chars_removed"),
    )
