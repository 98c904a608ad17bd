"""Documents to packed training sequences: five stages, each one operator of reviewloom.llm.

A stage takes (spark, docs, sf_dir) and returns the columns of documents; the last returns the
pieces of the sequences. Rows without an id, or with equal ids, are told apart by their texts.

In all stages other columns of docs, whatever their names, are left out, whole texts are read,
however long, and an empty table gives an empty one. What a stage makes of nulls, empty texts, ties
and repeated rows is in its own docstring.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import decontaminate, language, near_dup, packing, suffix
from reviewloom.llm.common import written

VOCABULARY = "byte_bpe_50k.json"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Bytes of a repeated string that goes, and of the anchors in it: a passage of 50 words of four
#: letters holds it, wherever words begin.
REPEAT, ANCHOR = 250, 60


def _same(docs: DataFrame, judged: DataFrame, text: Column) -> Column:
    return docs["doc_id"].eqNullSafe(judged["doc_id"]) & (F.xxhash64(text) == judged["text_hash"])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: a text that is null, has no letter or is far from all
    learnt ones goes. Learnt from the labelled documents but a fifth. Repeated rows stay or go together."""
    model = language.fit(docs.where(~language.held_out("doc_id")))
    return language.identify(docs.select(*COLUMNS), model).where("NOT rejected").select(*COLUMNS)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id, once. Rows that repeat
    an id and text are one document, also where both are null; texts without a word are in no group and stay."""
    judged = near_dup.near_duplicates(docs).where("kept").select("doc_id", "text_hash").distinct()
    rows = docs.select(*COLUMNS, F.xxhash64("text").alias("hash"))
    kept = rows["doc_id"].eqNullSafe(judged["doc_id"]) & (rows["hash"] == judged["text_hash"])
    return rows.join(judged, kept, "left_semi").dropDuplicates(["doc_id", "hash"]).select(*COLUMNS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of repeated strings of REPEAT bytes, all places of which go;
    n_chars follows the text. Null texts stay null; rows with equal texts lose them from REPEAT bytes
    on; repeated rows stay as many as they were."""
    judged = (suffix.remove_repeats(docs, window=REPEAT, anchor=ANCHOR).where("kept IS NOT NULL")
              .select("doc_id", "text_hash", "kept").dropDuplicates(["doc_id", "text_hash"]))
    rows = docs.select(*COLUMNS).alias("rows")
    same = _same(rows, judged, F.coalesce("rows.text", F.lit("")))
    cut = rows.join(judged, same, "left").withColumn("left_text", F.coalesce("kept", "rows.text"))
    return cut.select("rows.doc_id", F.col("left_text").alias("text"), "lang", "source",
                      F.when(F.col("kept").isNull(), F.col("n_chars"))
                      .otherwise(F.length("left_text")).cast("long").alias("n_chars"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without contamination by the benchmark table. Null and empty texts hold none and
    stay; repeated rows stay or go together."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    judged = (decontaminate.contaminated(docs, benchmark).where("contaminated")
              .select("doc_id", "text_hash").distinct())
    rows = docs.select(*COLUMNS)
    return rows.join(judged, _same(rows, judged, rows["text"]), "left_anti")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and place there. A null or empty text is
    the end token alone; repeated rows are packed each."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("minhash_near_dedup", minhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]
#: No SQL can express the near-duplicate groups, the language model or the packing.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = written(docs)
    return docs
