"""A corpus pipeline: language ID, exact dedup, near dedup, decontamination, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage
before kept. All but the last return the columns of ``docs`` as they came, with fewer
rows; the last returns the packed pieces.

A row is named by its id and its text (two hashes), so rows without an id and rows that
share one are judged like any other: language ID and decontamination drop a row for what
its text says, the two dedup stages keep one row of each group. There, of rows alike in
id and text, one stays. Null texts count as empty. Columns beyond those of ``documents``
pass through whatever their names; an empty table gives an empty result in every stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.llm.catalogue import TOKENIZER, language_training_rows
from tillwright.llm.common import TEXT_MARKS, attach, keep, prepare, table, text_marks, tidy
from tillwright.llm.decontaminate import decontaminate
from tillwright.llm.exact_dedup import exact_dedup
from tillwright.llm.langid import UNDETERMINED, learn, predict
from tillwright.llm.packing import pack
from tillwright.llm.simhash import near_duplicates

#: A document is rejected when the mean probability of its best language is below so
#: many times what guessing gives, which is 1 / languages.
TIMES_CHANCE = 1.2
#: Names of dropped rows (24 bytes each) that are broadcast at most.
BROADCAST_NAMES = 1_000_000
_TEMP = "_stage_value"


def least_score(languages: int) -> float:
    """The limit for so many learned languages; 0.6 at most, also with one or two."""
    return min(TIMES_CHANCE / max(languages, 1), 0.6)


KEY = ["doc_id", *TEXT_MARKS]


def _same_row(left: DataFrame, right: DataFrame) -> Column:
    """Equality of the rows' names; null ids are equal to each other."""
    marks = [left[n] == right[n] for n in TEXT_MARKS]
    return left["doc_id"].eqNullSafe(right["doc_id"]) & marks[0] & marks[1]


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(*docs.columns, *text_marks("text"))


def _without(docs: DataFrame, dropped: DataFrame, name: str) -> DataFrame:
    """``docs`` but for the dropped names, which are written first.

    Up to BROADCAST_NAMES of them are sent to the texts, beyond that both sides are shuffled.
    """
    gone = keep(dropped.select(*KEY).distinct(), name)
    if gone.count() <= BROADCAST_NAMES:
        gone = F.broadcast(gone)
    named = _named(docs)
    return named.join(gone, _same_row(named, gone), "left_anti").select(*docs.columns)


def _one_of_each(docs: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """``docs`` with one row for every kept row of ``found`` (its name and ``kept``).

    Texts are moved only where rows are alike in id and text.
    """
    judged = keep(
        found.groupBy(*KEY).agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n")), name
    )
    rest = _without(docs, judged.where("NOT stays"), f"{name}-dropped")
    alike = keep(judged.where("stays AND n > 1").select(*KEY), f"{name}-alike")
    if alike.isEmpty():
        return rest
    named = _named(rest)
    # Spark limits each task to one row of a name before the shuffle.
    first = Window.partitionBy(*KEY).orderBy(F.xxhash64(*docs.columns))
    several = named.join(alike, _same_row(named, alike), "left_semi")
    one = several.withColumn(_TEMP, F.row_number().over(first)).where(F.col(_TEMP) == 1)
    single = named.join(alike, _same_row(named, alike), "left_anti")
    return single.select(*docs.columns).unionByName(one.select(*docs.columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those without a clear language."""
    prepare(spark)
    network = learn(language_training_rows(docs))
    found = docs.withColumn(_TEMP, predict(network, F.col("text")))
    least = least_score(len(network.labels) if network else 0)
    clear = (F.col(f"{_TEMP}.lang") != UNDETERMINED) & (F.col(f"{_TEMP}.score") >= least)
    return found.where(clear).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the longest original of equal texts, then the smallest id."""
    prepare(spark)
    return _one_of_each(docs, exact_dedup(docs, carry=text_marks("text")), "exact-copies")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of every group of linked fingerprints (null ids last)."""
    prepare(spark)
    found = keep(
        near_duplicates(docs, words=3, distance=3, carry=text_marks("text")).select(*KEY, "group_fp"), "near-groups"
    )
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), *KEY)
    best = keep(found.groupBy("group_fp").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n")), "near-best")
    judged = attach(found, best, "group_fp", "n").select(*KEY, (order == F.col("best")).alias("kept"))
    return _one_of_each(docs, judged.withColumn("kept", F.coalesce("kept", F.lit(False))), "near-copies")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that share a window of ten words with a benchmark item."""
    prepare(spark)
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), carry=text_marks("text"))
    return _without(docs, found.where("contaminated"), "contaminated")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 4096 tokens; one row per piece."""
    prepare(spark)
    return pack(docs, TOKENIZER)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: Neither the network nor SimHash can be said in SQL; tests/llm/test_pipeline.py
#: checks the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next reads it.

    What the stages wrote goes as soon as the next one has read it; the pieces stay.
    """
    prepare(spark)
    with tidy(spark):
        docs = table(spark, sf_dir, "documents")
        for name, stage in STAGES[:-1]:
            with tidy(spark):
                docs = keep(stage(spark, docs, sf_dir), name, stays=True)
        return STAGES[-1][1](spark, docs, sf_dir)
