"""Conversation prefix trie, with subtree sums from an Euler tour.

Every conversation is rebuilt: the first h turns of the one that opens its block of
twenty, then its own turns after its first h. A node is a distinct sequence of first
turns, named by a 128-bit mark that is the exclusive or of a hash per place and turn, so
the parent's mark follows from the node's own last turn. The nodes' tour enters and
leaves every node; ``list_rank`` sums weights along it, and a subtree's sum is the
difference between the sums at its two arcs.

Nothing is done per conversation or per parent in one task: turns and siblings are
numbered by a distributed sort, marks are summed within blocks of places and then over
the blocks' totals, hot parents are joined by ``attach``. The one sequential thing is
the SHA-256 of a node's ends: ids are joined in chunks first, and a node with several
chunks reads them one after the other, with a chunk in memory at a time.

Defined results: rows without conv_id belong to no conversation and are left out; null
role or text counts as empty; turns with the same number are ordered by the hash of role
and text, and repeated rows are turns of their own; the remainder of a negative id is
negative, as in SQL. Without a conversation there is no root and the result is empty.
Other columns, whatever their names, are not read. Two sequences share a mark by chance
with a probability of 2^-128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.common import Scratch, attach, prepare
from tillwright.llm.list_rank import FINISH, list_sums
from tillwright.operators.windows import number_rows
from tillwright.session import staged

#: Conversations in a block that share an opening, and the greatest number of shared turns.
BLOCK, SHARED = 20, 4
#: Places in a block of the marks' prefix sums.
STEP = 1024
#: Ids in a chunk of a node's ends.
CHUNK = 4096
WORD = "[^\\x20\\x09-\\x0D]+"
MARK = ["mark1", "mark2"]


def _turns(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(conv_id, place, digest, words) of every turn, and one row per conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    own = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        # Splits rows that are alike in all else, so that the sort can part them.
        F.monotonically_increasing_id().alias("apart"),
    )
    stored = scratch.keep(own, "turns")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("apart")]
    numbered = scratch.keep(
        number_rows(stored, order, "number", 0).select("conv_id", "digest", "words", "number"), "turns-numbered"
    )
    convs = scratch.keep(
        numbered.groupBy("conv_id").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n")), "convs"
    )
    placed = attach(numbered, convs, "conv_id", "n").select(
        "conv_id", (F.col("number") - F.col("first") + 1).alias("place"), "digest", "words"
    )
    return scratch.keep(placed, "turns-placed"), convs.select("conv_id", "n")


def _plans(convs: DataFrame) -> DataFrame:
    """Per conversation: the one it borrows from, turns dropped, turns borrowed, final length."""
    crc = F.crc32(F.col("conv_id").cast("string").cast("binary"))
    own = convs.select(
        "conv_id",
        "n",
        (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("opener"),
        (crc % SHARED).alias("dropped"),
    )
    openers = convs.select(F.col("conv_id").alias("opener"), F.col("n").alias("opener_n"))
    borrowed = F.least("dropped", F.coalesce("opener_n", F.lit(0)))
    rest = F.greatest(F.col("n") - F.col("dropped"), F.lit(0))
    return own.join(openers, "opener", "left").select(
        "conv_id", "n", "opener", "dropped", borrowed.alias("borrowed"), (borrowed + rest).alias("length")
    )


def _rebuilt(placed: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, place, digest, words, length) after rebuilding."""
    tail = attach(placed, plans, "conv_id", "n").where("place > dropped")
    tail = tail.select("conv_id", (F.col("place") - F.col("dropped") + F.col("borrowed")).alias("place"), "digest", "words", "length")
    # At most SHARED - 1 rows of an opener, for the conversations of its block.
    heads = placed.where(F.col("place") < SHARED).withColumnRenamed("conv_id", "opener")
    head = heads.join(plans.where("borrowed > 0"), "opener").where("place <= borrowed")
    return tail.unionByName(head.select("conv_id", "place", "digest", "words", "length"))


def _lane(digest: str, at: int) -> Column:
    """Eight bytes of a digest as a long."""
    part = F.hex(F.substring(digest, at, 8))
    high = F.conv(F.substring(part, 1, 8), 16, 10).cast("long")
    low = F.conv(F.substring(part, 9, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def _marked(rebuilt: DataFrame, scratch: Scratch) -> DataFrame:
    """Rebuilt turns with the mark of their prefix and that of the prefix before."""
    hashed = F.unhex(F.sha2(F.concat(F.col("place").cast("string").cast("binary"), F.lit(":").cast("binary"), "digest"), 256))
    own = scratch.keep(
        rebuilt.withColumn("at_place", hashed).select(
            "conv_id", "place", "words", "length", *[_lane("at_place", 1 + 8 * i).alias(f"own{i + 1}") for i in range(2)]
        ),
        "turns-hashed",
    )

    def running(rows: DataFrame, place: str, values: list[str], names: list[str]) -> DataFrame:
        """Running exclusive or over ``place`` (from 0) per conversation, in blocks of STEP."""
        block = F.floor(F.col(place) / STEP).cast("long")
        within = Window.partitionBy("conv_id", "block").orderBy(place)
        blocked = rows.withColumn("block", block)
        local = blocked.withColumns({n: F.bit_xor(v).over(within) for n, v in zip(names, values, strict=True)})
        totals = scratch.keep(
            blocked.groupBy("conv_id", "block").agg(*[F.bit_xor(v).alias(v) for v in values]), "block-marks"
        )
        if totals.where("block > 0").isEmpty():
            return local.drop("block")
        sums = [f"{n}_up_to" for n in names]
        over = running(totals.withColumnRenamed("block", "spot"), "spot", values, sums)
        before = over.select("conv_id", (F.col("spot") + 1).alias("block"), *sums)
        return local.join(before, ["conv_id", "block"], "left").withColumns(
            {n: F.col(n).bitwiseXOR(F.coalesce(s, F.lit(0))) for n, s in zip(names, sums, strict=True)}
        ).drop("block", *sums)

    found = running(own.withColumn("from_zero", F.col("place") - 1), "from_zero", ["own1", "own2"], MARK)
    return found.select(
        "conv_id", "place", "words", "length", *MARK,
        *[F.col(m).bitwiseXOR(F.col(o)).alias(f"parent_{m}") for m, o in zip(MARK, ["own1", "own2"], strict=True)],
    )


def _join_ids(ids: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(ids), lambda x: x.cast("string")), ",")


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over chunks in order; rows come sorted by node and chunk."""

    def row(key, sha):
        columns = [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([sha.hexdigest()])]
        return pa.RecordBatch.from_arrays(columns, names=[*MARK, "ends_sha256"])

    at, sha = None, None
    for batch in batches:
        for mark1, mark2, text in zip(*(batch.column(n).to_pylist() for n in (*MARK, "ids")), strict=True):
            if (mark1, mark2) != at:
                if at:
                    yield row(at, sha)
                at, sha = (mark1, mark2), hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(text.encode())
    if at:
        yield row(at, sha)


def _ends(ends: DataFrame, scratch: Scratch) -> DataFrame:
    """(mark, ends_sha256) for the nodes where conversations (mark, conv_id) end."""
    stored = scratch.keep(ends.select(*MARK, "conv_id"), "ends")
    numbered = scratch.keep(number_rows(stored, [*MARK, "conv_id"], "number", 0), "ends-numbered")
    first = scratch.keep(
        numbered.groupBy(*MARK).agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n_ends")), "ends-first"
    )
    chunk = F.floor((F.col("number") - F.col("first")) / CHUNK)
    joined = scratch.keep(
        attach(numbered, first, MARK, "n_ends").groupBy(*MARK, "n_ends", chunk.alias("chunk"))
        .agg(_join_ids(F.collect_list("conv_id")).alias("ids")),
        "ends-joined",
    )
    short = joined.where(F.col("n_ends") <= CHUNK).select(*MARK, F.sha2("ids", 256).alias("ends_sha256"))
    long = joined.where(F.col("n_ends") > CHUNK).repartition(*MARK).sortWithinPartitions(*MARK, "chunk")
    hashed = long.select(*MARK, "ids").mapInArrow(_hash_chunks, "mark1 long, mark2 long, ends_sha256 string")
    return short.unionByName(hashed)


def prefix_trie(rows: DataFrame, finish: int = FINISH) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. ``finish`` is the length of list that the
    ranking walks at last.
    """
    spark = prepare(rows.sparkSession)
    scratch = Scratch(spark)
    placed, convs = _turns(rows, scratch)
    plans = scratch.keep(_plans(convs), "plans")
    marked = scratch.keep(_marked(_rebuilt(placed, plans), scratch), "turns-marked")
    parent = [f"parent_{m}" for m in MARK]
    members = marked.groupBy(*MARK, "place").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"),
        *[F.min(p).alias(p) for p in parent],
    )
    zero = F.lit(0).cast("long")
    root = plans.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    top = root.select(
        *[zero.alias(m) for m in MARK], zero.alias("place"), "conv_id", "n_convs", zero.alias("words"),
        *[F.lit(None).cast("long").alias(p) for p in parent],
    )
    nodes = scratch.keep(members.unionByName(top), "nodes")
    # Siblings stand side by side in one sorted sequence; the root comes first.
    order = [F.col(p).asc_nulls_first() for p in parent] + [F.col("conv_id"), *map(F.col, MARK)]
    numbered = scratch.keep(number_rows(nodes, order, "node", 0), "nodes-numbered")
    below = scratch.keep(
        numbered.where(F.col(parent[0]).isNotNull()).groupBy(*parent)
        .agg(F.min("node").alias("first_child"), F.count(F.lit(1)).alias("n_children"))
        .withColumnsRenamed(dict(zip(parent, MARK, strict=True))),
        "children",
    )
    full = scratch.keep(
        numbered.join(below, MARK, "left").withColumn("n_children", F.coalesce("n_children", zero)), "nodes-full"
    )
    above = full.where("n_children > 0").select(
        *[F.col(m).alias(p) for m, p in zip(MARK, parent, strict=True)],
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("siblings"),
    )
    kin = attach(full.where(F.col(parent[0]).isNotNull()), scratch.keep(above, "parents"), parent, "siblings")
    lone = full.where(F.col(parent[0]).isNull())
    named = scratch.keep(kin.drop("siblings").unionByName(lone, allowMissingColumns=True), "nodes-named")
    following = named.select((F.col("node") - 1).alias("node"), F.col("parent").alias("next_parent"))
    sibling = F.col("next_parent").eqNullSafe(F.col("parent")) & F.col("parent").isNotNull()
    enter, leave = F.col("node") * 2, F.col("node") * 2 + 1
    saved = (F.col("n_convs") - 1) * F.col("words")
    arcs = named.join(following, "node", "left").select(
        F.inline(
            F.array(
                F.struct(
                    enter.alias("id"),
                    F.coalesce(F.col("first_child") * 2, leave).alias("next"),
                    (F.col("n_children") == 0).cast("long").alias("leaves"),
                    saved.alias("saved"),
                ),
                F.struct(
                    leave.alias("id"),
                    F.when(sibling, (F.col("node") + 1) * 2).otherwise(F.col("parent") * 2 + 1).alias("next"),
                    zero.alias("leaves"),
                    zero.alias("saved"),
                ),
            )
        )
    )
    sums, paths = list_sums(arcs, ["leaves", "saved"], finish)
    scratch.paths += paths
    sign = F.when(F.col("id") % 2 == 1, 1).otherwise(-1)
    subtree = sums.groupBy(F.floor(F.col("id") / 2).alias("node")).agg(
        F.sum(sign * F.col("leaves")).alias("n_leaves"), F.sum(sign * F.col("saved")).alias("saved_tokens")
    )
    closed = marked.where("place = length").select(*MARK, "conv_id")
    turnless = plans.where("length = 0").select(zero.alias("mark1"), zero.alias("mark2"), "conv_id")
    ends = _ends(closed.unionByName(turnless), scratch)
    answer = named.join(subtree, "node").join(ends, MARK, "left").select(
        "conv_id", F.col("place").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
    result, _ = staged(answer, "trie")
    scratch.drop()
    return result
