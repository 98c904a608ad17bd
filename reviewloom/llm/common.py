"""Helpers of the operators: the shared folder, words as columns, hashing of words in tasks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the contracts, as Java patterns: words that white space parts, and words of
#: ASCII letters, digits and all characters beyond ASCII.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors see.

    Where that is not set, a local master gets a temporary folder; a cluster gets an error,
    as its executors would write to disks of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
    return f"{base}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, and whole if an executor goes."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else unchanged."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower()))


def words(text: Column, pattern: str) -> Column:
    """The words of a text in order, given by the pattern of a run of a negated set of characters;
    none for null. Splitting at the set itself takes half the time of finding the words."""
    if not (pattern.startswith("[^") and pattern.endswith("]+")):
        raise ValueError(f"not a run of a negated set: {pattern}")
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{pattern[2:]}"), "")


def count_matches(text: Column, pattern: str) -> Column:
    """Characters of the text inside matches of a pattern of single characters."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")
