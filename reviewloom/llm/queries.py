"""The registered queries of the operators, one for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import (
    decontaminate, html_main, language, licenses, near_dup, packing, personal, phrases,
    quality, spelling, substring, suffix, url_rules,
)

VOCABULARY = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(_table(spark, sf_dir, "pages"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contaminated(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last column is the text that is left, of every document."""
    return suffix.remove_repeats(_table(spark, sf_dir, "documents"), whole=True).drop("text_hash")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", language.held_out("doc_id").alias("held_out"))
    model = language.fit(docs.where("NOT held_out"))
    return language.identify(docs.drop("lang"), model).select(
        "doc_id", "held_out", "lang_pred", "score")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_rules.judge(pages).select("page_id", "host", "path", "rule", "verdict")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents")).drop("text_hash")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("good")).alias("kept"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


QUERIES = [op1_html_extraction, op2_substring_dedup, op3_benchmark_decontamination,
           op4_best_fit_packing, op5_suffix_array_dedup,
           op6_language_id, op7_url_filters, op8_license_scan,
           op9_minhash_near_dedup, op10_quality_rules,
           op11_phrase_collocations, op12_personal_data, op13_spelling_variants]
