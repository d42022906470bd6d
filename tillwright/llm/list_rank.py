"""Prefix sums along a linked list that is spread over the cluster.

Every element knows its successor and carries weights. A round flips a coin per element
(a hash of its id and the round); an element with heads whose predecessor has tails is
taken out: the predecessor takes over its successor and adds its weights, and the
element remembers the predecessor and the sum in between. A quarter of the list goes
in a round, so all rounds together move a few times the list. What is left in the end
(at most ``finish`` elements) is walked from the head, and the elements come back in
reverse order, each from its anchor's sum. Every join is one row to one row, so no key
is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillwright.llm.common import discard
from tillwright.session import staged

#: Elements that are walked on the driver instead of in another round.
FINISH = 4096


def _heads(element: str, turn: int) -> Column:
    return F.xxhash64(F.col(element), F.lit(turn)).bitwiseAND(F.lit(1)) == 1


def _walk(rest: DataFrame, weights: list[str], places: str) -> DataFrame:
    """Sums of the elements that are left, from the head on."""
    rows = {r["id"]: r for r in rest.collect()}  # at most ``finish``
    followed = {r["next"] for r in rows.values()}
    heads = [i for i in rows if i not in followed]
    if len(heads) != bool(rows):
        raise ValueError("the links are not one list")
    at, sums, out = (heads or [None])[0], [0] * len(weights), []
    while at is not None and len(out) < len(rows):
        out.append((at, *sums))
        sums = [s + rows[at][w] for s, w in zip(sums, weights, strict=True)]
        at = rows[at]["next"]
    if len(out) != len(rows) or at is not None:
        raise ValueError("the links are not one list")
    return rest.sparkSession.createDataFrame(out, places)


def list_sums(links: DataFrame, weights: list[str], finish: int = FINISH) -> tuple[DataFrame, list[str]]:
    """(id, weights): sums over all elements before ``id``, and the folders they are in.

    ``links`` has a unique ``id`` (long), ``next`` (null at the tail) and the weights
    (longs); it is read once. An empty list gives an empty result; links that are no
    single list are an error.
    """
    spark = links.sparkSession
    schema = "id long, " + ", ".join(f"{w} long" for w in weights)

    def store(rows: DataFrame, name: str) -> tuple[DataFrame, str, int]:
        seen = Observation()
        out, path = staged(rows.observe(seen, F.count(F.lit(1)).alias("n")), name)
        return out, path, seen.get["n"]

    current, path, size = store(links.select("id", "next", *weights), "list")
    taken: list[tuple[DataFrame, str]] = []
    while size > finish:
        turn = len(taken)
        last = _heads("id", turn)
        grows = ~last & F.col("next").isNotNull() & _heads("next", turn)
        before = current.where(grows).select(
            F.col("id").alias("anchor"), F.col("next").alias("id"), *[F.col(w).alias(f"{w}_before") for w in weights]
        )
        # Elements with heads meet their predecessor, if that one has tails.
        met, met_path = staged(current.where(last).join(before, "id", "left"), "list-round")
        gone = met.where(F.col("anchor").isNotNull())
        joined = gone.select(
            F.col("anchor").alias("id"), "next", *[(F.col(w) + F.col(f"{w}_before")).alias(w) for w in weights]
        )
        stay = met.where(F.col("anchor").isNull()).select("id", "next", *weights)
        same = current.where(~last & ~F.coalesce(grows, F.lit(False)))
        now, now_path, now_size = store(same.unionByName(stay).unionByName(joined), "list")
        discard(spark, path)
        taken.append((gone.select("id", "anchor", *[F.col(f"{w}_before").alias(w) for w in weights]), met_path))
        current, path, size = now, now_path, now_size
    found, found_path = staged(_walk(current, weights, schema), "list-sums")
    discard(spark, path)
    places, paths = found, [found_path]
    for gone, gone_path in reversed(taken):
        anchors = places.select(F.col("id").alias("anchor"), *[F.col(w).alias(f"{w}_at") for w in weights])
        back, back_path = staged(
            gone.join(anchors, "anchor").select("id", *[(F.col(w) + F.col(f"{w}_at")).alias(w) for w in weights]),
            "list-sums",
        )
        discard(spark, gone_path)
        places = places.unionByName(back)
        paths.append(back_path)
    return places, paths
