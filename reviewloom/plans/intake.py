"""Raw reviews to clean ones with a record of every row that goes, reading the raw files once.

Each raw row is judged where it is read and written under its outcome: what is kept, typed, and
what goes, with the reason, the file and the raw text of a record that does not parse. Clean
reviews are made of the kept rows. How many rows there were is asked of the files that were
committed, whose footers say it; a task that runs twice commits once, so it counts once.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions import lenient
from reviewloom.operators import gates, reviews
from reviewloom.sources import tables

# Files whose headers are read at a time.
HEADERS_AT_ONCE = 16

KEPT, OUTCOME, CORRUPT = "kept", "outcome", "_corrupt_record"


def header_groups(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> dict[tuple[str, ...], list[str]]:
    """Files by their header. The driver gets the files' names and first lines, which Spark reads
    a few at a time; no file is read further."""
    files = sorted(r.path for r in spark.read.format("binaryFile").load(path).select("path").collect())
    with ThreadPool(HEADERS_AT_ONCE) as pool:
        headers = pool.map(lambda file: tuple(tables.read_csv(spark, file, multi_line).columns), files)
    groups: dict[tuple[str, ...], list[str]] = {}
    for header, file in zip(headers, files, strict=True):
        if header:  # an empty file has none
            groups.setdefault(header, []).append(file)
    return groups


def read_csv_with_rejects(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """CSV files as text columns, with ``_corrupt_record`` and ``file``.

    Files are put together by the names in their headers, in whatever order and number they stand;
    a column that a file lacks is null there. A record with more or fewer cells than its file's
    header has its raw text in ``_corrupt_record``; others have null there.
    """
    found = None
    for header, files in sorted(header_groups(spark, path, multi_line).items()):
        schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*header, CORRUPT])
        rows = spark.read.schema(schema).csv(
            files, header=True, multiLine=multi_line, escape='"', enforceSchema=False, mode="PERMISSIVE",
            columnNameOfCorruptRecord=CORRUPT).withColumn("file", F.col("_metadata.file_name"))
        found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
    if found is None:
        raise gates.GateError(f"no file with a header: {path}")
    return found


def judged(raw: DataFrame) -> DataFrame:
    """raw with ``outcome``: ``kept`` or why the row goes, by the first reason that holds. A row
    goes for the same reasons for which ``clean_reviews`` drops it, copies apart, and for cells too
    many or too few."""
    named = reviews.rename_reviews(raw)
    kinds = {f.name: f.dataType for f in named.schema.fields}
    rating = lenient.null_outside(
        lenient.to_int(F.col("rating_raw"), kinds["rating_raw"]), reviews.LOWEST_RATING, reviews.HIGHEST_RATING)
    reason = (
        F.when(F.col(CORRUPT).isNotNull() if CORRUPT in named.columns else F.lit(False), "malformed")
        .when(F.col("review_text").isNull(), "no text")
        .when(F.col("product_name").isNull(), "no product")
        .when(F.col("rating_raw").isNull(), "no rating")
        .when(rating.isNull(), "rating out of range")
        .otherwise(KEPT))
    back = {new: old for old, new in reviews.RAW_TO_STANDARD.items() if old in raw.columns}
    return named.withColumn(OUTCOME, reason).withColumnsRenamed(back)


def build_reviews(raw: DataFrame, staged: str, clean: str, **options) -> DataFrame:
    """Write ``raw`` under its outcomes to ``staged``, clean reviews to ``clean``, and return the
    balance. ``options`` go to ``clean_reviews``."""
    rows = judged(raw)
    rows.write.mode("overwrite").option("compression", "snappy").partitionBy(OUTCOME).parquet(staged)
    written = raw.sparkSession.read.schema(rows.schema).parquet(staged)
    kept = written.where(F.col(OUTCOME) == KEPT).drop(OUTCOME, CORRUPT, "file")
    tables.write_table(reviews.clean_reviews(kept, **options), clean)
    return balance(written, tables.read_table(raw.sparkSession, clean))


def outcomes(staged: DataFrame) -> DataFrame:
    """(outcome, rows). The outcome is a folder's name, so no column of a file is read."""
    return staged.groupBy(OUTCOME).agg(F.count("*").alias("rows"))


def balance(staged: DataFrame, clean: DataFrame) -> DataFrame:
    """One row: raw_rows, clean_rows, dropped_rows, of written tables. Neither side's columns are
    read: rows are counted by the footers of the files."""
    zero = F.lit(0).cast("bigint")
    sides = staged.agg(F.count("*").alias("raw_rows"), zero.alias("clean_rows")).unionAll(
        clean.agg(zero.alias("raw_rows"), F.count("*").alias("clean_rows")))
    return sides.agg(F.sum("raw_rows").alias("raw_rows"), F.sum("clean_rows").alias("clean_rows")).withColumn(
        "dropped_rows", F.col("raw_rows") - F.col("clean_rows"))


def rejects(staged: DataFrame) -> DataFrame:
    """(outcome, file, record) of the rows that went: a record that does not parse as it was read,
    another as JSON of its cells."""
    cells = [c for c in staged.columns if c not in (OUTCOME, CORRUPT, "file")]
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in cells]))
    if CORRUPT in staged.columns:
        record = F.coalesce(CORRUPT, record)
    file = F.col("file") if "file" in staged.columns else F.lit(None).cast("string")
    return staged.where(F.col(OUTCOME) != KEPT).select(OUTCOME, file.alias("file"), record.alias("record"))
