"""SimHash near-dedup: pigeonhole blocks, then the Hamming distance.

A text's fingerprint has a bit set when over half of its shingles' 64-bit hashes have
it. Fingerprints are cut into BLOCKS pieces. Two that differ in at most ``distance``
bits agree in BLOCKS - distance pieces at least, so every choice of that many pieces
is a key, and links are found among fingerprints with a common key. Equal
fingerprints are one node. A key shared by more than CROWD fingerprints is not paired
off: there each link x-y is found through a value z within 1 bit of y and ``distance``
- 1 of x, so the work is linear in the group and no link is lost.

Defined results: null and empty texts have fingerprint zero and link like any other;
fewer words than a shingle count as one shingle; rows that repeat an id are rows of
their own; a null id never becomes a component's name while another id is there;
empty input gives an empty result; other columns are not read unless ``carry`` names
them.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import as_bytes, attach, keep, tidy
from tillwright.llm.components import components

BLOCKS = 6
CROWD = 1000
BITS = 64


def fingerprint(text: bytes | None, words: int) -> int:
    """Signed 64-bit SimHash of one text."""
    own = (text or b"").lower().split()
    if not own:
        return 0
    if len(own) < words:
        shingles = [b" ".join(own)]
    else:
        shingles = map(b" ".join, zip(*(own[i:] for i in range(words)), strict=False))
    # Hashes as eight big-endian bytes each, unpacked to bits and summed by column.
    raw = np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles, repeat(42))), np.uint8)
    raw = raw.reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(raw), 4096):
        ones += np.unpackbits(raw[start : start + 4096], axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(raw)).view(">i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", words: int = 3) -> DataFrame:
    """fp (signed 64 bits) of every row, in place of the text."""

    @F.arrow_udf("long")
    def simhash(column: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, words) for t in as_bytes(column)], pa.int64())

    others = [c for c in docs.columns if c not in ("doc_id", text)]
    return docs.select("doc_id", simhash(F.col(text)).alias("fp"), *others)


def _pieces(blocks: int) -> list[int]:
    """Bit masks (signed) of the pieces."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    return [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:], strict=False)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def block_masks(distance: int, blocks: int = BLOCKS) -> list[int]:
    """One mask for every choice of pieces that must agree."""
    pieces = _pieces(blocks)
    return [_signed(sum(c)) for c in combinations(pieces, blocks - distance)]


def links(prints: DataFrame, distance: int = 3, blocks: int = BLOCKS, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that connect exactly the distinct values of ``fp`` within ``distance`` bits.

    Outside crowded keys these are all pairs that are close; inside, a star per
    close neighbourhood, which reaches the same fingerprints.
    """
    masks = block_masks(distance, blocks)
    keyed = keep(
        prints.select("fp").distinct().select(
            "fp",
            F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("choice", "part"),
        ),
        "blocks",
    )
    key = ["choice", "part"]
    crowded = keep(
        keyed.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > crowd).select(*key), "crowded"
    )
    some = not crowded.isEmpty()
    small = keyed.join(crowded, key, "left_anti") if some else keyed
    other = small.select(*key, F.col("fp").alias("other"))
    paired = small.join(other, key).where(
        (F.col("fp") < F.col("other"))
        & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance)
    )
    near = paired.select(F.col("fp").alias("a"), F.col("other").alias("b"))
    if some:
        near = near.union(_crowded(keyed.join(crowded, key), masks, distance))
    return near


def _crowded(members: DataFrame, masks: list[int], distance: int) -> DataFrame:
    """Links inside crowded keys, in work linear in the key's members.

    x and y are within ``distance`` bits exactly when some z is within 1 bit of y and
    ``distance`` - 1 of x. All y of one z are linked to every x of it, so one y stands
    for them; each y is an x of z as well, from distance 2 on. At distance 1 all pairs
    are made, 64 a member at most. The changed bits lie outside the key's pieces.
    """
    if distance < 1:
        return members.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)

    def changes(mask: int, most: int) -> list[int]:
        free = [i for i in range(BITS) if not mask >> i & 1]
        return [_signed(sum(1 << i for i in c)) for k in range(most + 1) for c in combinations(free, k)]

    spark = members.sparkSession

    def variants(most: int) -> DataFrame:
        rows = [(i, changes(m & ((1 << BITS) - 1), most)) for i, m in enumerate(masks)]
        return F.broadcast(spark.createDataFrame(rows, "choice int, change array<bigint>"))

    def spread(most: int) -> DataFrame:
        flipped = members.join(variants(most), "choice").select(
            "choice", "fp", F.explode("change").alias("flip")
        )
        return flipped.select("choice", F.col("fp").bitwiseXOR(F.col("flip")).alias("z"), "fp")

    if distance == 1:
        others = members.select("choice", F.col("fp").alias("z"))
        return spread(1).join(others, ["choice", "z"]).where("fp < z").select(
            F.col("fp").alias("a"), F.col("z").alias("b")
        ).distinct()
    hubs = spread(1).groupBy("choice", "z").agg(F.min("fp").alias("hub"))
    return (
        spread(distance - 1).join(hubs, ["choice", "z"]).where("fp != hub")
        .select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b")).distinct()
    )


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 3,
    distance: int = 3,
    carry: list[Column] | None = None,
) -> DataFrame:
    """Every row's doc_id, fp, component_id, group_fp, and what ``carry`` names.

    component_id is the smallest id reachable by links; group_fp, the smallest fingerprint
    reachable, names the group also where ids are null.
    """
    with tidy(docs.sparkSession):
        own = docs.select(
            F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *(carry or [])
        )
        prints = keep(with_fingerprint(own, "text", words), "fingerprints", stays=True)
        extra = [c for c in prints.columns if c not in ("doc_id", "fp")]
        classes = keep(
            prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "fp-classes"
        )
        # A class without a link is its own component; the others take the smallest id
        # of the classes that they reach.
        nodes = keep(components(links(classes, distance)), "nodes")
        linked = nodes.join(classes, nodes["node"] == classes["fp"]).select("fp", "root", "first_id")
        lowest = linked.groupBy("root").agg(F.min("first_id").alias("lowest"))
        reached = keep(linked.join(lowest, "root").select("fp", "root", "lowest"), "reached")
        named = keep(
            classes.join(reached, "fp", "left").select(
                "fp", "n",
                F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("lowest")).alias("component_id"),
                F.coalesce("root", "fp").alias("group_fp"),
            ),
            "fp-components",
            stays=True,
        )
    return attach(prints, named, "fp", "n").select("doc_id", "fp", "component_id", "group_fp", *extra)


def hex_print(column: str = "fp"):
    """The fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(F.col(column))), 16, "0")
