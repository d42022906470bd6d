"""Connected components of a link table, by alternating large and small stars.

Every round is a few shuffled aggregations and joins, written to the shared folder;
nothing is gathered. A round about halves the longest chains, so the number of rounds
grows with the logarithm of a component's diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillwright.llm.common import keep

MAX_ROUNDS = 60
#: Links in a file of a round's result; few links make few files and few tasks.
ROWS_PER_FILE = 500_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours (``b`` < ``a``) to the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").where("b != m").select("b", "m").toDF("a", "b")
    return moved.union(low.select("a", F.col("m").alias("b")))


def _stored(edges: DataFrame, files: int | None = None) -> tuple[DataFrame, tuple]:
    """The links written, with their number and an order-free checksum of them."""
    seen = Observation()
    watched = edges.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("mark"),
    )
    out = keep(watched.coalesce(files) if files else watched, "links")
    return out, (seen.get["n"], seen.get["mark"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links ``a``, ``b``: root is the smallest node.

    Links to itself and repeated links change nothing; nulls are ignored; no links
    give an empty result.
    """
    straight = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, state = _stored(straight.distinct())
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        files = -(-state[0] // ROWS_PER_FILE)
        current, now = _stored(_small_star(_large_star(current)).distinct(), files)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
