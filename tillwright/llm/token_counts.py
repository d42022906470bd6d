"""Token counts by section, by the tokens' character spans.

A whole document is encoded once. Tokens and sections are both sorted by place, so
their interval join is one merge per document. A token that lies in several sections
belongs to the one that holds most of its bytes, the earlier one on a tie; a token in
no section is counted under section -1. So a document's counts always add up to the
tokens of its whole text.

Defined results: a null text is empty; an empty text has its one section with no
tokens, and no section where sections are given and there is none; sections may leave
gaps but not overlap (later ones then start where the earlier end); rows that repeat
an id each have their own rows; empty input gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import as_bytes

# Fixed value: how this vocabulary cuts text before it merges bytes.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def _coder(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder of a rank file, and each token's number of bytes."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


def line_sections(raw: bytes) -> np.ndarray:
    """Byte ranges of the lines, each with its line end; an empty text is one empty line."""
    stops = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    edges = np.concatenate([[0], stops, [len(raw)]])
    if len(stops) and stops[-1] == len(raw):
        edges = edges[:-1]
    return np.stack([edges[:-1], edges[1:]], 1)


def attribute(stops: np.ndarray, sections: np.ndarray) -> tuple[np.ndarray, int]:
    """Tokens per section and tokens in none, for tokens that end at ``stops`` one after another."""
    starts = np.concatenate([[0], stops[:-1]])
    if not len(sections):
        return np.zeros(0, np.int64), len(stops)
    begin, end = sections[:, 0], np.maximum.accumulate(sections[:, 1])
    begin = np.maximum(begin, np.concatenate([[0], end[:-1]]))
    # The first section that ends after the token starts, and the last that begins before it ends.
    low = np.searchsorted(end, starts, side="right")
    high = np.searchsorted(begin, stops, side="left") - 1
    counts = np.zeros(len(sections), np.int64)
    inside = low == high
    counts += np.bincount(low[inside], minlength=len(sections))
    for t in np.flatnonzero(high > low):
        own = np.arange(low[t], high[t] + 1)
        share = np.minimum(end[own], stops[t]) - np.maximum(begin[own], starts[t])
        counts[own[share.argmax()]] += 1
    return counts, int((high < low).sum())


def _points(raw: bytes, places: np.ndarray) -> np.ndarray:
    """Byte places as code points."""
    if raw.isascii():
        return places
    first = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(first)])[places]


def _bytes(text: str, places: np.ndarray) -> np.ndarray:
    """Code point places as bytes of the UTF-8, held within the text."""
    if text.isascii():
        return np.clip(places, 0, len(text))
    sizes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    width = 1 + (sizes > 0x7F) + (sizes > 0x7FF) + (sizes > 0xFFFF)
    return np.concatenate([[0], np.cumsum(width)])[np.clip(places, 0, len(text))]


def token_counts(
    docs: DataFrame, ranks: str, doc_id: str = "doc_id", text: str = "text", sections: Column | None = None
) -> DataFrame:
    """(doc_id, section, start, stop, n_tokens): places are code points, sections count from 0.

    ``sections`` is an array of structs (start, stop) in order; without it every line,
    with its line end, is a section.
    """
    row = pa.struct([("section", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("n_tokens", pa.int64())])

    @F.arrow_udf("array<struct<section:int,start:long,stop:long,n_tokens:long>>")
    def count(texts: pa.Array, given: pa.Array) -> pa.Array:
        coder, sizes = _coder(ranks)
        parts, ends, total = [], [0], 0
        for raw, own in zip(as_bytes(texts), given.to_pylist(), strict=True):
            raw = raw or b""
            value = raw.decode()
            stops = np.cumsum(sizes[np.array(coder.encode_ordinary(value), np.int64)])
            if own is None:
                spans = line_sections(raw)
                shown = _points(raw, spans)
            else:
                shown = np.array([(s["start"], s["stop"]) for s in own], np.int64).reshape(-1, 2)
                spans = _bytes(value, shown)
            counts, none = attribute(stops, spans)
            rows = np.concatenate([np.arange(len(counts))[:, None], shown, counts[:, None]], 1)
            if none:
                rows = np.concatenate([rows, [[-1, 0, len(value), none]]])
            parts.append(rows)
            total += len(rows)
            ends.append(total)
        flat = np.concatenate(parts) if parts else np.zeros((0, 4), np.int64)
        columns = [pa.array(np.ascontiguousarray(flat[:, i]), row[i].type) for i in range(4)] if len(flat) else [
            pa.array([], row[i].type) for i in range(4)
        ]
        values = pa.StructArray.from_arrays(columns, fields=list(row))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

    asked = sections if sections is not None else F.lit(None).cast("array<struct<start:long,stop:long>>")
    found = docs.select(F.col(doc_id).alias("doc_id"), count(F.col(text), asked).alias("found"))
    # The outer form: the plain one would have the optimizer count each array first, by
    # running the function a second time.
    return found.select("doc_id", F.inline_outer("found")).where("section IS NOT NULL")
