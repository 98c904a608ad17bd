"""Duplicate removal with a fixed survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per ``keys``: the first by ``order``, which should be total.

    The filter on the rank lets Spark keep one row per key in every input partition
    before the shuffle, so a key that holds much of the table arrives as one row per
    task. Rows that tie on ``order`` differ in nothing the caller ordered by.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(_RANK, F.row_number().over(ranked))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )


# --- keys of earlier runs --------------------------------------------------------------

# Bits that a key sets in a filter, and bits of a filter for a key: about one in a hundred keys
# that were not stored seems to be.
HASHES, BITS_A_KEY = 4, 10
# The most bits of a filter (128 MB). A fuller one lets more keys through to the exact check.
MOST_BITS = 1 << 30


def filter_bits(keys: int) -> int:
    """Bits of a filter for about so many keys: a power of two, so that filters of runs can be
    merged as long as their sizes are equal."""
    return min(MOST_BITS, max(1 << 15, 1 << (BITS_A_KEY * max(1, keys) - 1).bit_length()))


def _places(key: str, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), F.col(key)), F.lit(bits)) for i in range(HASHES)]


def key_filter(stored: DataFrame, key: str, bits: int) -> DataFrame:
    """A Bloom filter of keys as rows (bucket, bitmap) of 32,768 bits each, built by an aggregate
    that sums up in tasks first."""
    place = stored.select(F.explode(F.array(*_places(key, bits))).alias("place"))
    return place.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))


def merged_filters(filters: DataFrame) -> DataFrame:
    """One filter of the rows of several of the same bits."""
    return filters.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def with_seen(df: DataFrame, key: str, filter_rows: DataFrame, bits: int, name: str = "maybe_seen") -> DataFrame:
    """Add whether the filter says that a key may be stored; false is certain."""
    seen = F.lit(True)
    for i, place in enumerate(_places(key, bits)):
        one = filter_rows.select(F.col("bucket").alias(f"__bucket_{i}"), F.col("bitmap").alias(f"__bitmap_{i}"))
        df = df.withColumn(f"__place_{i}", place).withColumn(f"__of_{i}", F.bitmap_bucket_number(f"__place_{i}"))
        df = df.join(one, F.col(f"__of_{i}") == F.col(f"__bucket_{i}"), "left")
        bit = F.bitmap_bit_position(f"__place_{i}")
        byte = F.conv(F.hex(F.substring(f"__bitmap_{i}", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        seen = seen & F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    extra = [f"__{x}_{i}" for x in ("bucket", "bitmap", "place", "of") for i in range(HASHES)]
    return df.withColumn(name, seen).drop(*extra)


def drop_seen(df: DataFrame, stored: DataFrame, key: str, filter_rows: DataFrame, bits: int) -> DataFrame:
    """Rows of df whose key is not among the stored ones.

    Keys that the filter does not know pass as they are read. Only the others, those that are stored
    and a hundredth of the rest, meet the stored keys in a join. df is read twice, so give a written
    table where it is dear to make. A null key is a key like others to the filter but equals none in the join, so it stays.
    """
    known = with_seen(df, key, filter_rows, bits, "__maybe")
    fresh = known.where("NOT __maybe").drop("__maybe")
    rest = known.where("__maybe").drop("__maybe").join(stored.select(key), key, "left_anti")
    return fresh.unionByName(rest)
