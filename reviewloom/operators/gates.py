"""Checks between stages. These run jobs and raise."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class GateError(Exception):
    """A stage's input or output is not there."""


def require_input(spark: SparkSession, path: str) -> int:
    """Bytes under a file, folder or glob. Lists files and opens none."""
    try:
        files = spark.read.format("binaryFile").load(path)
        row = files.agg(
            F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
        ).first()
    except AnalysisException as error:
        raise GateError(f"missing input: {path}") from error
    if not row["files"]:
        raise GateError(f"missing input: {path}")
    return row["bytes"]


def input_files(spark: SparkSession, path: str) -> int:
    """How many files are under a file, folder or glob."""
    return spark.read.format("binaryFile").load(path).select("path").count()


def input_report(spark: SparkSession, inputs: dict[str, str]) -> DataFrame:
    """(input, there, ok) for every input: whether files are there, and whether they hold bytes."""
    rows = []
    for name, path in inputs.items():
        try:
            held = require_input(spark, path)
        except GateError:
            held = None
        rows.append((name, held is not None, bool(held)))
    return spark.createDataFrame(rows, "input string, there boolean, ok boolean")


def require_rows(df: DataFrame, name: str) -> int:
    """The row count, which must not be zero. Parquet answers it from file footers."""
    rows = df.count()
    if rows == 0:
        raise GateError(f"no rows in {name}")
    return rows


def unmatched_ids(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Ids that are not on both sides: (key, in_left, in_right)."""
    sides = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return (
        sides.groupBy(key)
        .agg((F.max("l") == 1).alias("in_left"), (F.max("r") == 1).alias("in_right"))
        .filter(~(F.col("in_left") & F.col("in_right")))
    )


def require_same_ids(left: DataFrame, right: DataFrame, key: str) -> None:
    extra = unmatched_ids(left, right, key).count()
    if extra:
        raise GateError(f"{extra} values of {key} are on one side only")


def gate_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, ok) for all tables in one job."""
    report = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", (F.col("row_count") > 0).alias("ok")
        )
        report = row if report is None else report.unionAll(row)
    return report
