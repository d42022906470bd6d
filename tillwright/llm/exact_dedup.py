"""Exact dedup: a persistent digest index, bucketed and sorted by hash (DataFrame only).

Two texts are equal when they are identical after deleting white space
(``[\\x20\\x09-\\x0D]``). The index is a table of one row per known text, bucketed
and sorted by its SHA-256. A batch is deduplicated within itself, then against the
index by a sort-merge anti-join that reads the index bucket by bucket, and what is
new is appended under the batch's name. A batch that is repeated under its name, as
after a lost driver, takes its own rows in the index as new and gets the same answer.

Rows are told apart by a stored row number, so a group of any number of copies, also of
rows that are alike in all columns, is counted and joined, never gathered.

Defined results: null text counts as empty; empty texts are equal to each other; a
null id is kept as null and loses every tie; of rows that repeat the same id, text
and length exactly one is kept; an empty batch gives an empty result and leaves the
index as it is; other columns of the input, whatever their names, are not read unless
``carry`` names them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm.common import Scratch, attach, discard, keep, prepare
from tillwright.session import shared_dir

SPACE = "[\\x20\\x09-\\x0D]+"
INDEX_COLUMNS = "digest BINARY, keep_id BIGINT, n_chars INT, batch STRING"


def digests(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[Column] | None = None
) -> DataFrame:
    """doc_id, SHA-256 of the text without white space, code points of the original, row."""
    value = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.unhex(F.sha2(F.regexp_replace(value, SPACE, ""), 256)).alias("digest"),
        F.char_length(value).alias("own_chars"),
        F.monotonically_increasing_id().alias("row"),
        *(carry or []),
    )


class DigestIndex:
    """All texts seen so far, by digest.

    ``path`` is where the table lives; without one it goes below the shared folder.
    The bucket count is part of the folder's name, so one index is never written
    with two counts; it should grow with the corpus (about 1 GB of index a bucket).
    """

    def __init__(
        self, spark: SparkSession, name: str, path: str | None = None, buckets: int = 32
    ):
        self.spark, self.name = prepare(spark), name
        self.root = path or f"{shared_dir(spark)}/digest-index-{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({INDEX_COLUMNS}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
            f"LOCATION '{self.root}/buckets={buckets}'"
        )
        self.buckets = buckets

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def forget(self) -> None:
        """Drop the table's name from the catalogue; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def append(self, new: DataFrame, batch: str) -> None:
        """Add the batch's texts that the index does not have yet."""
        own = new.select("digest", "keep_id", "n_chars", F.lit(batch).alias("batch"))
        missing = own.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        missing.repartition(self.buckets, "digest").write.insertInto(self.name)

    def add(
        self,
        docs: DataFrame,
        doc_id: str = "doc_id",
        text: str = "text",
        batch: str | None = None,
        carry: list[Column] | None = None,
    ) -> DataFrame:
        """Deduplicate a batch and append what is new.

        Returns doc_id, keep_id, group_size (rows of the batch with that text),
        kept, text_sha256 and what ``carry`` names for every row. ``keep_id`` is the row
        with the most code points, then the smallest id, or the one that the index
        already has. A batch that may be repeated after a failure needs a name of its own,
        the same each time; without one every call is another batch.
        """
        scratch, batch = Scratch(self.spark), batch or uuid.uuid4().hex
        # Read by the result, hence not among the tables that go.
        seen_rows = keep(digests(docs, doc_id, text, carry), "digests")
        extra = seen_rows.columns[4:]
        best = F.min(F.struct(-F.col("own_chars"), F.col("doc_id").isNull(), "doc_id", "row"))
        groups = scratch.keep(
            seen_rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size"))
            .select(
                "digest", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"),
                (-F.col("best.col1")).alias("n_chars"),
            ),
            "digest-groups",
        )
        # The joins run side by side with the buckets: only the batch is shuffled.
        others = self.rows().where(F.col("batch") != batch).hint("merge")
        new = scratch.keep(groups.join(others.select("digest"), "digest", "left_anti"), "digest-new")
        known = groups.select("digest", "group_size").join(others.select("digest", "keep_id"), "digest")
        decided = keep(
            new.drop("n_chars").unionByName(known.withColumn("keep_row", F.lit(None).cast("long"))),
            "digest-decided",
        )
        self.append(new, batch)
        scratch.drop()
        found = attach(seen_rows, decided, "digest", "group_size")
        return found.select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("row").eqNullSafe(F.col("keep_row")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            *extra,
        )


def exact_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[Column] | None = None
) -> DataFrame:
    """One batch through an index of its own."""
    index = DigestIndex(docs.sparkSession, f"digest_index_{uuid.uuid4().hex}")
    decisions = index.add(docs, doc_id, text, carry=carry)
    index.forget()
    discard(docs.sparkSession, index.root)
    return decisions
