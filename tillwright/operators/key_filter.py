"""A filter of reference keys that drops certain misses before a shuffle.

The keys set bits of a bitmap, HASHES each, built by Spark's bitmap aggregate: in parts of
32,768 bits, combined in every task before they are shuffled. A row whose key misses a bit
is in no reference; one that has all its bits goes on to the join, which decides. So the
join's result is exact, and what a filter lets through by chance (about 1 in 70 at
BITS_PER_KEY, more where the bitmap is at its limit) only costs its way to the join.

The bitmap is broadcast: MOST_BITS bounds it at 32 MB, whatever the number of keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tillwright.session import staged

BITS_PER_KEY = 16
HASHES = 2
#: Bits of one part of the bitmap, as Spark's aggregate makes them.
PART = 1 << 15
MOST_BITS = 1 << 28


@dataclass(frozen=True)
class KeyFilter:
    """The bitmap of a reference's keys; an empty reference lets nothing through."""

    parts: DataFrame
    bits: int
    kind: DataType

    @staticmethod
    def build(reference: DataFrame, key: str, kind: DataType | None = None) -> KeyFilter:
        """From the keys that are not null, compared in the given type (their own)."""
        kind = kind or reference.schema[key].dataType
        keys = reference.select(F.col(key).try_cast(kind).alias("key")).where("key IS NOT NULL")
        n = keys.agg(F.approx_count_distinct("key")).first()[0]
        bits = PART
        while bits < min(MOST_BITS, BITS_PER_KEY * n):
            bits *= 2
        places = F.explode(F.array(*[_place("key", i, bits) for i in range(HASHES)]))
        parts = keys.select(places.alias("place")).groupBy(_part("place")).agg(
            F.bitmap_construct_agg(F.col("place") % PART).alias("__bitmap")
        )
        return KeyFilter(staged(parts, "key-filter")[0], bits, kind)

    def possible(self, df: DataFrame, key: str) -> DataFrame:
        """The rows of ``df`` whose key may be in the reference; null keys are not."""
        out = df.withColumn("__key", F.col(key).try_cast(self.kind)).where("__key IS NOT NULL")
        for i in range(HASHES):
            out = out.withColumn("__place", _place("__key", i, self.bits)).withColumn("__part", _part("__place"))
            byte = F.substring("__bitmap", (F.floor(F.col("__place") % PART / 8) + 1).cast("int"), F.lit(1))
            number = F.conv(F.hex(byte), 16, 10).cast("int")
            held = F.getbit(number, (F.col("__place") % 8).cast("int")) == 1
            out = out.join(F.broadcast(self.parts), "__part").where(held).drop("__part", "__bitmap", "__place")
        return out.drop("__key")


def _place(key: str, which: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(which), key), F.lit(bits))


def _part(place: str) -> Column:
    return F.floor(F.col(place) / PART).alias("__part")


def semi_join(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is in the reference; certain misses are not shuffled."""
    own = KeyFilter.build(reference, key, df.schema[key].dataType)
    keys = reference.select(F.col(key).try_cast(own.kind).alias(key)).where(F.col(key).isNotNull())
    return own.possible(df, key).join(keys, key, "left_semi").select(*df.columns)
