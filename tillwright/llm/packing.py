"""Best-fit packing with Martello-Toth dominance reduction.

Documents become pieces of at most ``capacity`` tokens. How pieces are packed depends
on their lengths alone, so the plan is made from the number of pieces of each length:
``capacity`` numbers at most, whatever the corpus. Sets that provably dominate every
other set with the same largest piece are fixed first, in as many copies as there
are; best fit, longest first, packs the rest. The plan says which ranks of a length
go to which sequences; pieces are numbered within their length in shards and look
their place up.

Defined results: null text is empty and has the end id alone; rows that repeat an id
are packed one by one; a null id stays null; empty input gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.common import as_bytes, keep, text_blocks
from tillwright.llm.tokens import word_encoder

END_ID = 1
#: Pieces numbered by one task at most (on average) within a length.
SHARD_ROWS = 2000
#: Plan rows that may be broadcast (48 bytes each); beyond, the plan is joined by a shuffle.
BROADCAST_ROWS = 500_000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(rows: DataFrame, path: str, capacity: int) -> DataFrame:
    """Encode whole texts and cut what is longer than the capacity."""
    end = np.array([END_ID], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_encoder(path)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out: list[tuple] = []
            for first, block in text_blocks(as_bytes(batch.column(1)), 1_000_000):
                for i, raw in enumerate(coder.encode_block(block)):
                    raw += end
                    total = len(raw) // 4
                    for piece, start in enumerate(range(0, total, capacity)):
                        own = raw[4 * start : 4 * (start + capacity)]
                        out.append((ids[first + i], piece, start, len(own) // 4, zlib.crc32(own)))
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(encode, PIECE_SCHEMA)


class _Lengths:
    """How many pieces of each length are left, and which are the nearest ones present."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for length, count in counts.items():
            self.left[length] = count

    def present(self) -> np.ndarray:
        return np.flatnonzero(self.left)

    def largest(self, most: int, taken: tuple[int, ...] = ()) -> int:
        """The largest length up to ``most`` with a piece beside those taken; 0 if none."""
        for length in self.present()[::-1]:
            if length <= most and self.left[length] > taken.count(int(length)):
                return int(length)
        return 0

    def smallest(self, number: int, taken: int) -> list[int]:
        found: list[int] = []
        for length in self.present():
            copies = self.left[length] - (length == taken)
            found += [int(length)] * int(min(copies, number - len(found)))
            if len(found) == number:
                break
        return found

    def pair_bounds(self, room: int, taken: int) -> tuple[int, int]:
        """Over pairs c >= d that fit the room: the largest sum, and the largest d."""
        free = self.left.copy()
        free[taken] -= 1
        there = np.flatnonzero(free[: max(room, 0) + 1])
        there = there[there > 0]
        best_sum = best_small = 0
        if len(there):
            c = there[there < room]
            # The largest present length that fits beside c and is no longer than c.
            most = np.minimum(room - c, c)
            place = np.searchsorted(there, most, side="right") - 1
            ok = place >= 0
            d = np.where(ok, there[np.maximum(place, 0)], 0)
            same = ok & (d == c) & (free[c] < 2)
            place = np.where(same, place - 1, place)
            ok = place >= 0
            d = np.where(ok, there[np.maximum(place, 0)], 0)
            if ok.any():
                best_sum = int((c + d)[ok].max())
                best_small = int(d[ok].max())
        return best_sum, best_small


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Fixed sets with their number of copies, and the counts of what is left.

    For the piece x a set dominates all others with x if any of them could be swapped
    piece by piece into places that the set's own pieces leave. That holds for x alone
    if nothing fits beside it; for {x, y}, y the longest that fits, if they fill the
    sequence, if no two others fit beside x, or if no three do and no two are longer
    than y together; for {x, y, b}, b the longest beside both, if no three others fit
    and no pair's shorter piece is longer than b. Removing pieces keeps each condition
    true, so a set is fixed in as many copies as there are pieces.
    """
    own = _Lengths(counts, capacity)
    fixed: list[tuple[tuple[int, ...], int]] = []

    def fix(*lengths: int) -> None:
        copies = min(int(own.left[v]) // lengths.count(v) for v in lengths)
        for v in lengths:
            own.left[v] -= copies
        fixed.append((lengths, copies))

    # Pairs that fill a sequence, for all lengths.
    for x in range(capacity, capacity // 2 - 1, -1):
        y = capacity - x
        if y == 0 and own.left[x]:
            fix(x)
        elif y and x >= y and own.left[x] and own.left[y] and (x != y or own.left[x] > 1):
            fix(x, y)
    again = True
    while again:
        again = False
        for x in own.present()[::-1].tolist():
            while own.left[x]:
                least = own.smallest(3, x)
                room = capacity - x
                if not least or least[0] > room:
                    fix(x)
                    again = True
                    break
                if len(least) == 3 and sum(least) <= room:
                    break
                y = own.largest(room, (x,))
                if x + y == capacity or len(least) == 1 or least[0] + least[1] > room:
                    fix(x, y)
                    again = True
                    continue
                most, small = own.pair_bounds(room, x)
                b = own.largest(room - y, (x, y))
                if most <= y:
                    fix(x, y)
                elif b and small <= b:
                    fix(x, y, b)
                else:
                    break
                again = True
    return fixed, {int(v): int(own.left[v]) for v in own.present()}


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, ...]], int]:
    """Rows (length, from, to, sequence, per_sequence, offset), and the number of sequences.

    Rank r of a length, from <= r < to, goes to ``sequence + (r - from) // per_sequence``
    at ``offset + (r - from) % per_sequence * length``.
    """
    rows: list[tuple[int, ...]] = []
    used: dict[int, int] = {}
    sequences = 0

    def place(length: int, copies: int, first: int, each: int, offset: int) -> None:
        at = used.get(length, 0)
        used[length] = at + copies
        rows.append((length, at, at + copies, first, each, offset))

    fixed, rest = reduce_instance(counts, capacity)
    for lengths, copies in fixed:
        offset = 0
        for length in lengths:
            place(length, copies, sequences, 1, offset)
            offset += length
        sequences += copies
    # Open sequences as runs of equal room: room -> [(first, number)].
    runs: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []

    def open_run(room: int, first: int, number: int) -> None:
        if room and number:
            if not runs.get(room):
                runs[room] = []
                insort(rooms, room)
            runs[room].append((first, number))

    for length in sorted(rest, reverse=True):
        left = rest[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = runs[room].pop()
                if not runs[room]:
                    rooms.pop(at)
            else:
                room, first = capacity, sequences
                number = -(-left // (capacity // length))
                sequences += number
            each = min(room // length, left)
            full = min(number, left // each)
            place(length, full * each, first, each, capacity - room)
            left -= full * each
            open_run(room - each * length, first, full)
            rest_first, rest_number = first + full, number - full
            if rest_number and 0 < left < each:  # the last one takes what is left
                place(length, left, rest_first, left, capacity - room)
                open_run(room - left * length, rest_first, 1)
                left, rest_first, rest_number = 0, rest_first + 1, rest_number - 1
            open_run(room, rest_first, rest_number)
    return rows, sequences


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: where it starts in its document and where it lies."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # The number tells rows apart that are alike in all else; it is stored with them.
    numbered = cut_pieces(rows, tokenizer, capacity).withColumn("row", F.monotonically_increasing_id())
    pieces = keep(numbered, "pieces", stays=True)
    # At most ``capacity`` rows come to the driver.
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    slots, _ = plan(counts, capacity)
    shards = max(1, -(-max(counts.values(), default=0) // SHARD_ROWS))
    sharded = pieces.withColumn(
        "shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    )
    sizes = sharded.groupBy("length", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        "length", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("length", "shard").orderBy("row")
    ranked = (
        sharded.withColumn("place", F.row_number().over(within) - 1)
        .join(bases, ["length", "shard"])
        .withColumn("rank", F.col("base") + F.col("place"))
    )
    spark = docs.sparkSession
    planned = spark.createDataFrame(
        slots, "slot_length long, low long, high long, first long, each long, at long"
    )
    if len(slots) <= BROADCAST_ROWS:
        planned = F.broadcast(planned)
    nth = F.col("rank") - F.col("low")
    return ranked.join(
        planned,
        (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    ).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + nth % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )
