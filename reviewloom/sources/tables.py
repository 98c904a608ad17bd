"""CSV and Parquet in, Parquet out."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bits of a column's rank in a clustered table, and rows that the ranks are taken from.
RANK_BITS, RANK_SAMPLE = 6, 10_000

# The setting by which Spark removes the shuffle files of a job when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """A CSV file, folder or glob with a header, every column as text.

    Types are never inferred: that takes a second pass and turns the id ``007`` into 7.
    A file whose header differs from the first one's is an error instead of being read
    by position. Quoted newlines (``multi_line``) make each file one task; give many
    files, or pass ``multi_line=False`` for data known to be one record per line, which
    Spark splits.
    """
    return spark.read.csv(
        path,
        header=True,
        inferSchema=False,
        multiLine=multi_line,
        escape='"',
        enforceSchema=False,
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs that end in here leave no shuffle files. Otherwise these stay until the driver happens to
    collect garbage, so that steps written one after another pile up what each has shuffled."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def write_table(
    df: DataFrame,
    path: str,
    files: int | None = None,
    partition_by: Sequence[str] = (),
    max_rows_per_file: int | None = None,
    append: bool = False,
    compression: str = "snappy",
) -> None:
    """Replace a Parquet table, or add to it. What the job shuffled is removed when it ends.

    ``files`` asks for a number of files by a shuffle at the end, so the work before it
    stays parallel; by default every task writes its own. With ``partition_by`` rows are
    first dealt by those columns, so that a folder gets a file or a few and not one of every
    task; Spark splits what a frequent value would make too large for a task.
    """
    if files is not None:
        df = df.repartition(files)
    elif partition_by:
        columns = ", ".join("`" + c.replace("`", "``") + "`" for c in partition_by)
        df = df.sparkSession.sql(f"SELECT /*+ REBALANCE({columns}) */ * FROM {{rows}}", rows=df)
    writer = df.write.mode("append" if append else "overwrite").option("compression", compression)
    if max_rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_removed(df.sparkSession):
        writer.parquet(path)


def rank_bounds(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS, sample: int = RANK_SAMPLE) -> dict[str, list]:
    """For each column at most 2 ** bits - 1 values that part a random sample of ``sample`` rows
    evenly. Any values give right results; fitting ones give files of even size."""
    rows = df.select(*columns).orderBy(F.rand(7)).limit(sample).collect()
    found = {}
    for c in columns:
        values = sorted(r[c] for r in rows if r[c] is not None)
        at = (len(values) * i >> bits for i in range(1, 1 << bits))
        found[c] = sorted(set(values[i] for i in at)) if values else []
    return found


def interleaved(ranks: Sequence[Column], bits: int = RANK_BITS) -> Column:
    """A number made of the ranks' bits in turn, so that near numbers have near ranks in all of them."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for place, rank in enumerate(ranks):
            one = F.shiftright(rank.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            out = out + F.shiftleft(one, bit * len(ranks) + place)
    return out


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = RANK_BITS) -> None:
    """Replace a Parquet table whose files each hold a box of the columns' values.

    Rows are sorted by the interleaved bits of the columns' ranks and cut into ``files`` of about
    even size, so the least and largest values in a file's footer leave most files out for a filter on
    any of the columns, not only on the first. Nulls rank lowest. df is read three times (the
    sample, the cut and the sort), so give a written table where it is dear to make.
    """
    if not 1 <= len(columns) * bits <= 62:
        raise ValueError("columns times bits must lie between 1 and 62")
    bounds = rank_bounds(df, columns, bits)
    types = dict(df.dtypes)

    def rank(c: str) -> Column:
        array = F.array(*[F.lit(x) for x in bounds[c]]).cast(f"array<{types[c]}>")
        return F.when(F.col(c).isNull(), 0).otherwise(F.size(F.filter(array, lambda x: x <= F.col(c))))

    ordered = df.withColumn("__z", interleaved([rank(c) for c in columns], bits))
    ordered = ordered.repartitionByRange(files, "__z").sortWithinPartitions("__z").drop("__z")
    ordered.write.mode("overwrite").option("compression", "snappy").parquet(path)


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
