"""Ids of two tables compared by digests.

Ids are dealt to ranges of their hashes. A range's digest is the number of its rows and the sums
of two hashes of their ids, so tables with equal ids have equal digests in every range, and only
ranges whose digests differ are read again and joined. The digests of a table form a tree: those
of a level are sums of those below, so two roots tell whether anything differs at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.operators import gates

# Bits of a hash that name a range on the lowest level, and bits between levels.
BITS, STEP = 12, 4

_DIGEST = ["rows", "one", "two"]


def range_of(key: str, bits: int = BITS) -> Column:
    """The range of an id: the first bits of its hash."""
    if not 1 <= bits <= 24:
        raise ValueError("bits must lie between 1 and 24")
    return F.shiftrightunsigned(F.xxhash64(key), 64 - bits).cast("int")


def digests(df: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """(range, rows, one, two) of every range that has rows: 2 ** bits at most. Sums are taken in
    tasks first, so a task sends a row a range. Equal ids add up and don't cancel."""
    exact = "decimal(20,0)"
    return df.select(range_of(key, bits).alias("range"), F.xxhash64(key).cast(exact).alias("one"),
                     F.xxhash64(F.lit(1), F.col(key)).cast(exact).alias("two")).groupBy("range").agg(
        F.count("*").alias("rows"), F.sum("one").alias("one"), F.sum("two").alias("two"))


def folded(lower: DataFrame, step: int = STEP) -> DataFrame:
    """The digests of the level above."""
    return lower.groupBy(F.shiftright("range", step).alias("range")).agg(*[F.sum(c).alias(c) for c in _DIGEST])


def root(leaves: DataFrame) -> tuple:
    """What all ranges come to; equal for tables with equal ids."""
    return tuple(leaves.agg(*[F.sum(c) for c in _DIGEST]).first())


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Ranges (of digests of one level) in which two tables differ."""
    same = F.lit(True)
    for c in _DIGEST:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    both = left.alias("l").join(right.alias("r"), F.col("l.range") == F.col("r.range"), "full")
    return both.where(~same).select(F.coalesce("l.range", "r.range").alias("range"))


def unmatched_by_digest(
    left: DataFrame, right: DataFrame, key: str, left_digests: DataFrame | None = None,
    right_digests: DataFrame | None = None, bits: int = BITS,
) -> DataFrame:
    """Ids that are not on both sides: (key, in_left, in_right), as ``gates.unmatched_ids`` finds
    them. Digests may be given, as kept from when a table was written. Where all digests agree
    nothing else is shuffled. Ranges are at most 2 ** bits, so they can be broadcast."""
    one = digests(left, key, bits) if left_digests is None else left_digests
    two = digests(right, key, bits) if right_digests is None else right_digests
    ranges = F.broadcast(differing(one, two))

    def chosen(df: DataFrame) -> DataFrame:
        return df.select(key, range_of(key, bits).alias("range")).join(ranges, "range", "left_semi").select(key)

    return gates.unmatched_ids(chosen(left), chosen(right), key)
