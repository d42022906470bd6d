"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.session import apply_settings, shared_dir, staged

# Arrow batches between the JVM and Python stay small whatever the texts' length:
# a batch closes at the first of these bounds.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}

#: A group counts as hot when it holds more than one row in so many of all rows,
#: so there are at most as many hot groups as this number, at any input size.
HOT_SHARE = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on."""
    apply_settings(spark)
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)
    shared_dir(spark)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


#: Folders written inside each ``tidy`` that has not ended: those that go and those that stay.
_WRITTEN: list[tuple[list[str], list[str]]] = []


def keep(df: DataFrame, name: str, stays: bool = False) -> DataFrame:
    """The frame written once to the shared folder and read back.

    Inside ``tidy`` its folder goes in the end, unless it ``stays`` for a result that reads it.
    """
    out, path = staged(df, name)
    if _WRITTEN:
        _WRITTEN[-1][stays].append(path)
    return out


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Remove the folders that ``keep`` writes in here, once nothing reads them.

    What stays is left to an outer ``tidy``, if there is one, else to the caller.
    """
    own: tuple[list[str], list[str]] = ([], [])
    _WRITTEN.append(own)
    try:
        yield
    finally:
        _WRITTEN.pop()
        discard(spark, *own[0])
        if _WRITTEN:
            _WRITTEN[-1][0].extend(own[1])


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove intermediate folders that nothing will read again."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """Intermediate tables of one call, removed together once nothing reads them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        out, path = staged(df, name)
        self.paths.append(path)
        return out

    def drop(self) -> None:
        discard(self.spark, *self.paths)
        self.paths = []


#: Two hashes of a text, 128 bits together, under names that a document has hardly.
TEXT_MARKS = ("_text_mark_1", "_text_mark_2")


def text_marks(text: Column | str) -> list[Column]:
    """The hashes that, with the id, name a row whatever its id is worth."""
    return [F.xxhash64(F.lit(seed), text).alias(n) for seed, n in enumerate(TEXT_MARKS)]


def attach(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str) -> DataFrame:
    """``rows`` with the columns of their group; inner join on ``key``.

    ``groups`` has one row per key, and ``size`` in it is the number of rows that
    the group has. Groups with more than one in HOT_SHARE of all rows (HOT_SHARE
    groups at most) are broadcast, so a hot key never meets in one task; the rest
    is an ordinary shuffled join. Both frames should be stored ones: they are read
    twice.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    is_hot = F.col(size) * HOT_SHARE > F.lit(total)
    hot = F.broadcast(groups.where(is_hot))
    cold = groups.where(~is_hot)
    head = rows.join(hot, key)
    tail = rows.join(hot, key, "left_anti").join(cold, key)
    return head.unionByName(tail)


def bounded_sample(rows: DataFrame, size: int, *key: str) -> DataFrame:
    """The ``size`` rows with the smallest hash of ``key``, in that order (column ``order``).

    ``key`` should tell rows apart: all rows of one key have one hash, and a cut takes all
    of them or none.

    A cut at the hash that leaves half as many again keeps what tasks send on near the
    sample's size, however many tasks there are; fewer rows than ``size`` are all kept.
    """
    ordered = rows.withColumn("order", F.xxhash64(*key))
    total = rows.count()
    wanted = size + size // 2 + 200
    if total > wanted:
        ordered = ordered.where(F.col("order") < -(1 << 63) + (1 << 64) * wanted // total)
    return ordered.orderBy("order", *key).limit(size)


def text_blocks(texts: Iterable[bytes | None], limit: int = 2_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in blocks of about ``limit`` bytes, with the place of each block's first."""
    block, size, first = [], 0, 0
    for place, text in enumerate(texts):
        text = text or b""
        if block and size + len(text) > limit:
            yield first, block
            block, size, first = [], 0, place
        block.append(text)
        size += len(text)
    if block:
        yield first, block


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 of a string column."""
    return column.cast(pa.binary()).to_pylist()
