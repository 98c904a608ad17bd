"""Counts, distributions and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions import text


def row_balance(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """One row: raw_rows, clean_rows, dropped_rows.

    Both sides are counted by an aggregate of their own. A metric observed below the
    dedupe shuffle would save a scan, but counts a task again when its executor is lost.
    """
    count, zero = F.count(F.lit(1)), F.lit(0).cast("bigint")
    sides = raw.agg(count.alias("raw_rows"), zero.alias("clean_rows")).unionAll(
        clean.agg(zero.alias("raw_rows"), count.alias("clean_rows"))
    )
    return sides.agg(
        F.sum("raw_rows").alias("raw_rows"), F.sum("clean_rows").alias("clean_rows")
    ).withColumn("dropped_rows", F.col("raw_rows") - F.col("clean_rows"))


def value_counts(df: DataFrame, column: str, by: str = "value") -> DataFrame:
    """(column, count), ordered by the value ascending or by the count descending."""
    if by not in ("value", "count"):
        raise ValueError(f"by must be 'value' or 'count', not {by!r}")
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    if by == "count":
        return counts.orderBy(F.desc("count"), F.asc(column))
    return counts.orderBy(F.asc(column))


def preview(
    df: DataFrame, rows: int, width: int, order: Sequence[Column | str] = ()
) -> DataFrame:
    """The first rows with long text cells shortened; fixed rows if ``order`` is total."""
    first = (df.orderBy(*order) if order else df).limit(rows)
    strings = {name for name, dtype in df.dtypes if dtype == "string"}
    return first.select(*[
        text.shorten(F.col(c), width).alias(c) if c in strings else F.col(c)
        for c in df.columns
    ])


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as rows: position, column, type, nullable."""
    rows = [
        (i, field.name, field.dataType.simpleString(), field.nullable)
        for i, field in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, type string, nullable boolean"
    )
