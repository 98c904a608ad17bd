"""

The tables stand in for the raw files: every document is a review (its language is the
product), every part a product, every user turn of a conversation a question.
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reviewloom.functions import lenient  # noqa: E402
from reviewloom.functions import vectors as vector_functions
from reviewloom.operators import (
    answers, collection, dedupe, digests, embed, gates, products, prompts, pruned, reviews, search, stats, vector_index,
)
from reviewloom.plans import intake, sql, stages
from reviewloom.plans.ask import ask
from reviewloom.sources import tables

try:  # the operators for training data can be taken out as a whole
    import corpus_pipeline
    from reviewloom.llm import oracles as llm_oracles
    from reviewloom.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "reviewloom.llm"):
        raise  # they are there and lack something else
    corpus_pipeline = llm_queries = llm_oracles = None

PRODUCT = "the example product"
CELLS = search.Cells(bits=6, width=64)
PROBES = 48
# Vectors and questions of a few hundred rows, so that small tables make many blocks.
SMALL_BLOCKS = (1 << 18, 1 << 17)


# --- inputs ----------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.read_table(spark, f"{sf_dir}/{name}.parquet")


def _scratch(spark: SparkSession) -> str:
    """A new folder that all executors share. Where none is configured, a local master gets a
    local one, as in tests; on a cluster that is an error."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="reviewloom-")
    return f"{shared}/{uuid.uuid4().hex}"


def _raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw reviews. A few by id have a null title, a null or blank text, a null
    product, a null rating, or a rating from 0 to 7."""
    return _table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "concat('/reviews/', doc_id) AS Pageurl",
        "CASE WHEN doc_id % 11 <> 3 THEN concat('  ', source, ' in ', lang, ' ') END AS Title",
        "CASE WHEN doc_id % 29 = 7 THEN '   ' WHEN doc_id % 23 <> 5 THEN text END AS `Review Text`",
        "concat(' ', upper(lang)) AS `Review Color`",
        "CASE lang WHEN 'en' THEN ' Verified Purchase' WHEN 'fr' THEN 'verified purchase'"
        " WHEN 'de' THEN 'Unverified' END AS `User Verified`",
        "concat(doc_id % 13 + 1, '/', doc_id % 28 + 1, '/', 2000 + doc_id % 20) AS `Review Date`",
        "concat(doc_id, ' people found this helpful') AS `Review Useful Count`",
        "CASE WHEN doc_id % 31 <> 4 THEN concat(' ', upper(lang), ' Edition ') END AS `Configuration Text`",
        "CASE WHEN doc_id % 37 = 6 THEN NULL WHEN doc_id % 7 = 0 THEN concat(doc_id % 8, '.', length(source))"
        " ELSE concat(7 - length(cast(n_chars AS string)), '.', length(source)) END AS Rating",
        "source AS `Declaration Text`",
    )


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews.clean_reviews(_raw_reviews(spark, sf_dir), tie_break=["doc_id"])


def _raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as raw products. A few by key have no name, or no description; under the brand as
    key such rows would sort first."""
    return _table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS asin",
        "CASE WHEN p_partkey % 13 <> 5 THEN concat(' ', upper(p_name), ' ') END AS `Product Title`",
        "CASE WHEN p_partkey % 17 <> 3 THEN concat(p_type, ' ', p_name, ' ') END AS `About Product`",
        "concat(' ', p_type) AS Department",
        "concat('$', p_retailprice) AS `Actual Price`",
        "p_brand AS Manufacturer",
        "concat(p_size / 10.0, '') AS `Average Rating`",
        "concat(p_size, '.7') AS num_reviews",
    )


def _questions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every turn is a question. A few by turn are blank or null, or have an earlier turn's id."""
    turns = _table(spark, sf_dir, "conversations").selectExpr(
        "concat(conv_id, '-', CASE WHEN turn % 9 = 8 THEN 0 ELSE turn END) AS question_id",
        "CASE WHEN turn % 5 = 3 THEN ' \\t\\n ' WHEN turn % 7 <> 6 THEN text END AS question",
    )
    return search.split_questions(turns)


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = embed.with_embed_text(_reviews(spark, sf_dir))
    return embed.vector_rows(embed.hashed_embeddings(texts))


def _embed_questions(questions: DataFrame) -> DataFrame:
    return embed.hashed_embeddings(questions, "question")


def _written_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector table as a search finds it: written once, then read."""
    path = f"{_scratch(spark)}/vectors"
    tables.write_table(
        embed.with_shard(_vectors(spark, sf_dir)), path, partition_by=[embed.SHARD], compression="zstd")
    return tables.read_table(spark, path)


def _found(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid questions, their hits, vectors), all written."""
    valid = _kept(_questions(spark, sf_dir)[0], "questions")
    vectors = _written_vectors(spark, sf_dir)
    hits = search.search_questions(vectors, valid, _embed_questions, search.TOP_K, folder=_scratch(spark))
    return valid, hits, vectors


def _model():
    """A factory for a stand-in for a sentence model: hashed counts, token by token."""

    def load():
        import functools
        import hashlib
        import re

        @functools.lru_cache(maxsize=1 << 16)
        def dimension(token: str) -> int:
            return int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 384

        def encode(texts: list[str]) -> list[list[float]]:
            vectors = []
            for text in texts:
                vector = [0.0] * 384
                for token in re.findall("[a-z0-9]+", text.lower()):
                    vector[dimension(token)] += 1.0
                vectors.append(vector)
            return vectors

        return encode

    return load


def _client():
    """A factory for a stand-in for an answering service: it names the prompt, or fails."""

    def connect():
        import hashlib

        def answer(prompt: str, max_tokens: int) -> str:
            digest = hashlib.md5(prompt.encode()).hexdigest()
            if digest[0] == "0":
                raise RuntimeError("service is busy")
            return f"  {digest} in at most {max_tokens} tokens\n"

        return answer

    return connect


# --- queries ---------------------------------------------------------------------------


def _shown(clean: DataFrame) -> DataFrame:
    """Clean reviews without the ingestion time, which no second engine can repeat."""
    return clean.drop("ingestion_ts").withColumn("review_date", F.col("review_date").cast("string"))


def reviews_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(reviews.clean_reviews(
        _raw_reviews(spark, sf_dir), id_col="doc_id", tie_break=["doc_id"]))


def reviews_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_scratch(spark)}/raw_reviews"
    _raw_reviews(spark, sf_dir).write.csv(
        path, header=True, escape='"', quoteAll=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    raw = tables.read_csv(spark, path)
    raw = raw.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return _shown(reviews.clean_reviews(raw, id_col="doc_id", tie_break=["doc_id"]))


def reviews_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_scratch(spark)}/reviews_clean"
    clean = reviews.clean_reviews(
        _raw_reviews(spark, sf_dir), id_col="doc_id", tie_break=["doc_id"])
    tables.write_table(clean, path, partition_by=["rating"])
    return _shown(tables.read_table(spark, path)).select(reviews_clean(spark, sf_dir).columns)


def review_id_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reviews(spark, sf_dir).select("review_id", "product_id", "helpful_votes")


def reviews_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.row_balance(_raw_reviews(spark, sf_dir), _reviews(spark, sf_dir))


def rating_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.value_counts(_reviews(spark, sf_dir), "rating")


def product_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.value_counts(_reviews(spark, sf_dir), "product_id", by="count")


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.preview(_reviews(spark, sf_dir), 5, 60, ["review_id"]).select(
        "review_id", "review_title", "review_text", "rating")


def raw_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of both raw tables before cleaning, long cells cut."""
    shown = [stats.preview(raw, n, 60, [F.col(f"`{key}`")]).select(
        F.lit(name).alias("table_name"), F.col(f"`{key}`").cast("string").alias("row_key"),
        F.col(f"`{title}`").alias("title"), F.col(f"`{body}`").alias("body"))
        for name, raw, n, key, title, body in (
            ("reviews", _raw_reviews(spark, sf_dir), 3, "doc_id", "Title", "Review Text"),
            ("products", _raw_products(spark, sf_dir), 5, "asin", "Product Title", "About Product"))]
    return shown[0].unionByName(shown[1])


def raw_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and types of both raw tables as read from CSV: all text."""
    paths = _stage_paths(spark, sf_dir)
    found = [stats.schema_rows(tables.read_csv(spark, path)).withColumn("table_name", F.lit(name))
             for name, path in (("reviews", paths.raw_reviews), ("products", paths.raw_products))]
    return found[0].unionByName(found[1])


def _money(df: DataFrame) -> DataFrame:
    return df.drop("ingestion_ts").withColumns({
        "price": F.round(F.col("price").cast("double"), 2),
        "avg_rating": F.round(F.col("avg_rating").cast("double"), 2),
    })


def products_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money(products.clean_products(_table(spark, sf_dir, "part")))


def products_first_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money(products.clean_products(_table(spark, sf_dir, "part"), missing="first_column"))


def products_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money(products.clean_products(_raw_products(spark, sf_dir)))


def products_normalised_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_products(spark, sf_dir).withColumn("asin", F.col("Manufacturer"))
    return _money(products.clean_products(raw, normalise_key=True))


def products_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _table(spark, sf_dir, "part")
    return stats.row_balance(raw, products.clean_products(raw))


def avg_rating_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = products.clean_products(_raw_products(spark, sf_dir))
    return stats.value_counts(clean, "avg_rating").withColumn(
        "avg_rating", F.round(F.col("avg_rating").cast("double"), 2))


def lenient_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_chars").cast("string")
    return _table(spark, sf_dir, "documents").select(
        "doc_id",
        lenient.to_int(n).alias("int_plain"),
        lenient.to_int(F.concat(F.lit(" -"), n, F.lit(".9 "))).alias("int_cut"),
        lenient.to_int(F.concat(n, F.lit("d"))).alias("int_suffix"),
        lenient.to_int(F.concat(n, F.lit("00000000"))).alias("int_large"),
        lenient.digits(F.concat(n, F.lit(".0"))).alias("digits_double"),
        lenient.digits(F.concat(n, F.lit(",5 people"))).alias("digits_people"),
        lenient.digits(F.col("lang")).alias("digits_none"),
        F.round(lenient.price(F.concat(F.lit("-$"), n, F.lit(".5"))).cast("double"), 1)
        .alias("price_sign"),
        lenient.price(F.concat(n, F.lit(".00 - 9.99"))).cast("double").alias("price_range"),
        lenient.to_float(F.concat(n, F.lit("x"))).cast("double").alias("float_suffix"),
        lenient.null_outside(F.col("n_chars"), 100, 5000).alias("in_range"),
        lenient.null_outside(F.col("n_chars"), low=1000).alias("from_1000"),
    )


def lenient_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    month, day = F.col("doc_id") % 13 + 1, F.col("doc_id") % 31 + 1
    year = F.lit(1990) + F.col("n_chars") % 40

    def parsed(form: str, *parts) -> F.Column:
        return lenient.parse_date(F.format_string(form, *parts)).cast("string")

    return _table(spark, sf_dir, "documents").select(
        "doc_id",
        parsed("%d/%d/%d", month, day, year).alias("short"),
        parsed("%02d/%02d/%d", month, day, year).alias("padded"),
        parsed("%d-%02d-%02d", year, month, day).alias("iso"),
        parsed("%d/%d/%d", month, day, F.col("n_chars") % 100).alias("two_digit_year"),
        parsed("%d/%d/%d", day, month, year).alias("day_first"),
        parsed("%d-%02d-%02d 23:11:12", year, month, day).alias("iso_time"),
        parsed("%d-%02d-%02dT00:11:12.5", year, month, day).alias("iso_t_time"),
        lenient.flag(F.concat(F.lit(" "), F.upper("lang")), "en").alias("is_en"),
        lenient.flag(F.nullif("lang", F.lit("en")), "fr").alias("is_fr"),
    )


def typed_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices and counts of typed columns, above the size from which their text has an exponent."""
    large = F.col("o_totalprice").cast("double") * 1000
    double = T.DoubleType()
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.round(lenient.price(large, double).cast("double") / 1e4).alias("price_large"),
        F.round(lenient.price(-large / 1e10, double).cast("double"), 5).alias("price_small"),
        lenient.digits(F.floor(large / 100) + 0.5, double).alias("digits_large"),
    )


def embed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.with_embed_text(_reviews(spark, sf_dir)).select("review_id", "embed_text")


def hashed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = embed.hashed_embeddings(_table(spark, sf_dir, "documents"), "text", unit=True)
    return embed.dimension_rows(vectors, "doc_id").withColumn(
        "weight", F.round(F.col("weight").cast("double"), 6))


def embed_with(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = embed.embed_with(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                               _model(), "text")
    return embed.dimension_rows(vectors, "doc_id").withColumn(
        "weight", F.col("weight").cast("bigint"))


def vector_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written_vectors(spark, sf_dir).select(
        "review_id", "document", "product_id", "rating", "review_title",
        F.size("embedding").alias("width"),
        F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("tokens"),
    )


def _self_search(spark: SparkSession, sf_dir: str, k: int, **limits) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    asked = vectors.select(F.col("vec_id").alias("question_id"), "embedding")
    return search.cosine_topk(vectors, asked, k, id_col="vec_id", **limits)


def _rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("similarity", F.round("similarity", 6))


def knn_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_self_search(spark, sf_dir, search.TOP_K))


def knn_top2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_self_search(spark, sf_dir, search.CHECK_K))


def cosine_of_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The similarity of every hit once more, by the column function."""
    vectors = _table(spark, sf_dir, "embeddings")
    asked = vectors.select(F.col("vec_id").alias("question_id"), F.col("embedding").alias("q"))
    hits = _self_search(spark, sf_dir, search.CHECK_K).drop("similarity")
    pairs = hits.join(vectors, "vec_id").join(asked, "question_id")
    cosine = vector_functions.cosine(F.col("embedding"), F.col("q"))
    return pairs.select("question_id", "rank", "vec_id", F.round(cosine, 6).alias("similarity"))


def knn_top5_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_self_search(spark, sf_dir, search.TOP_K, block_bytes=SMALL_BLOCKS))


def _lsh(spark: SparkSession, sf_dir: str, **limits) -> DataFrame:
    path = f"{_scratch(spark)}/cells"
    stored = search.assign_cells(_table(spark, sf_dir, "embeddings"), CELLS)
    tables.write_table(stored, path, partition_by=["cell"])
    vectors = tables.read_table(spark, path)
    asked = vectors.select(F.col("vec_id").alias("question_id"), "embedding")
    return _rounded(search.lsh_topk(
        vectors, asked, CELLS, search.TOP_K, PROBES, id_col="vec_id", **limits))


def knn_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lsh(spark, sf_dir)


def knn_lsh_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lsh(spark, sf_dir, block_bytes=SMALL_BLOCKS)


def questions_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _questions(spark, sf_dir)[0]


def questions_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _questions(spark, sf_dir)[1].select("question_id", "reason")


def search_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = _questions(spark, sf_dir)
    hits = search.search_questions(
        _written_vectors(spark, sf_dir), valid, _embed_questions, folder=_scratch(spark))
    return _rounded(hits)


def prompts_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts are several times the reviews, and those of a task with the same first review pack well."""
    path = f"{_scratch(spark)}/prompts"
    for number, built in enumerate(prompts.build_in_rounds(*_found(spark, sf_dir), PRODUCT)):
        tables.write_table(built.drop("question").sortWithinPartitions("prompt"), path,
                           append=number > 0, compression="zstd")
    return tables.read_table(spark, path)


def answers_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_scratch(spark)}/answers"
    for number, built in enumerate(prompts.build_in_rounds(*_found(spark, sf_dir), PRODUCT)):
        given = answers.generate_answers(built, _client(), tasks=spark.sparkContext.defaultParallelism)
        tables.write_table(given, path, append=number > 0)
    return tables.read_table(spark, path)


def ask_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, rejected = _questions(spark, sf_dir)
    done = ask(
        _written_vectors(spark, sf_dir), valid.unionAll(rejected.drop("reason")),
        _embed_questions, _client(), PRODUCT, _scratch(spark))
    return done.answers.select(
        "question_id", "question", "answer", "error", F.posexplode("reviews_used"),
    ).select(
        "question_id", "question", "answer", "error", (F.col("pos") + 1).alias("rank"),
        "col.id", "col.rating", "col.title", "col.text",
    )


def hit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, hits, vectors = _found(spark, sf_dir)
    return answers.hit_records(prompts.with_reviews(hits, answers.shown(vectors)))


def gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["documents", "part", "embeddings", "conversations"]
    return gates.gate_report({name: _table(spark, sf_dir, name) for name in names})


def _csv(df: DataFrame, path: str, compression: str = "none") -> str:
    df.write.csv(path, header=True, escape='"', quoteAll=True, compression=compression,
                 ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


def products_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _csv(_raw_products(spark, sf_dir), f"{_scratch(spark)}/raw_products")
    return _money(products.clean_products(tables.read_csv(spark, path)))


def _stage_paths(spark: SparkSession, sf_dir: str) -> stages.Paths:
    folder = _scratch(spark)
    return stages.Paths(
        _csv(_raw_reviews(spark, sf_dir).drop("doc_id"), f"{folder}/raw/reviews", "gzip"),
        _csv(_raw_products(spark, sf_dir), f"{folder}/raw/products", "gzip"),
        f"{folder}/reviews", f"{folder}/products", f"{folder}/vectors")


def stages_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from raw files to checked vectors, and what they report."""
    report = stages.run(spark, _stage_paths(spark, sf_dir), count_raw=True)
    raw = report.raw_rows | {"vectors": report.rows["reviews"]}
    rows = [(name, raw[name], n, raw[name] - n) for name, n in report.rows.items()]
    return spark.createDataFrame(rows, "stage string, raw_rows long, rows long, dropped_rows long")


def inputs_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs that are there, and one that is not."""
    names = ["documents", "part", "no_such_table"]
    return gates.input_report(spark, {n: f"{sf_dir}/{n}.parquet" for n in names})


def clean_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and types of both clean tables as written, with their row counts."""
    found = None
    for name, df in (("reviews", _reviews(spark, sf_dir)),
                     ("products", products.clean_products(_raw_products(spark, sf_dir)))):
        path = f"{_scratch(spark)}/{name}"
        tables.write_table(df, path)
        back = tables.read_table(spark, path)
        rows = stats.schema_rows(back).select(
            F.lit(name).alias("table_name"), "position", "column", "type").crossJoin(
            back.agg(F.count("*").alias("row_count")))
        found = rows if found is None else found.unionByName(rows)
    return found


def ingestion_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ingestion time for all rows of a clean table, and none missing."""
    return _reviews(spark, sf_dir).agg(
        F.countDistinct("ingestion_ts").alias("times"), F.count("ingestion_ts").alias("rows_with_time"),
        F.count("*").alias("row_count"))


def knn_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Double vectors: differences below single precision decide the order."""
    fine = F.transform("embedding", lambda x, i: x.cast("double") + F.col("vec_id") * 1e-13 * (i % 3))
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", fine.alias("embedding"))
    asked = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("question_id"), "embedding")
    return _rounded(search.cosine_topk(vectors, asked, search.TOP_K, id_col="vec_id"))


def questions_searched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The look at a new vector table that closes its stage."""
    paths = _stage_paths(spark, sf_dir)
    stages.build_reviews(spark, paths)
    stages.build_vectors(spark, paths)
    turns = _table(spark, sf_dir, "conversations").selectExpr(
        "concat(conv_id, '-', turn) AS question_id", "text AS question")
    hits = stages.check_search(spark, paths, turns, _embed_questions, _scratch(spark))
    return hits.select("question_id", "rank", F.round("similarity", 6).alias("similarity"))


def unmatched_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return gates.unmatched_ids(documents, labels, "doc_id")


def _kept(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    path = f"{_scratch(df.sparkSession)}/{name}"
    tables.write_table(df, path, partition_by=partition_by)
    return tables.read_table(df.sparkSession, path)


def knn_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hits of knn_top5, by blocks that triangle bounds leave over."""
    vectors = _table(spark, sf_dir, "embeddings")
    pivots = pruned.choose_pivots(vectors, "vec_id")
    blocked = _kept(pruned.with_blocks(vectors.select("vec_id", "embedding"), pivots), "blocked", ("cell",))
    asked = vectors.select(F.col("vec_id").alias("question_id"), "embedding")
    hits = pruned.pruned_topk(blocked, asked, pivots, _scratch(spark), search.TOP_K, "vec_id")
    return _rounded(hits.drop("blocks_read", "blocks"))


def _pruned_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _written_vectors(spark, sf_dir)
    pivots = pruned.choose_pivots(vectors)
    blocked = _kept(pruned.with_blocks(vectors.select("review_id", "embedding"), pivots), "blocked", ("cell",))
    asked = _kept(_embed_questions(_questions(spark, sf_dir)[0]), "asked")
    return pruned.pruned_topk(blocked, asked, pivots, _scratch(spark), search.CHECK_K)


def questions_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hits of search_questions, by blocks that triangle bounds leave over."""
    return _rounded(_pruned_reviews(spark, sf_dir).drop("blocks_read", "blocks"))


def blocks_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of that search the bounds save: blocks read and there, over all questions."""
    one = _pruned_reviews(spark, sf_dir).where("rank = 1")
    return one.agg(F.count("*").alias("questions"), F.sum("blocks_read").alias("blocks_read"),
                   F.sum("blocks").alias("blocks")).withColumn(
        "skipped_share", F.round(1 - F.col("blocks_read") / F.col("blocks"), 4))


def _indexed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """(vectors, questions, candidates, hits) by the compressed index, a tenth of the vectors read."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = vector_index.fit(vectors, "vec_id")
    rows, schema = vector_index.index_rows(index)
    index = vector_index.read_index(_kept(spark.createDataFrame(rows, schema), "index"))
    codes = _kept(vector_index.with_codes(vectors, index).drop("embedding"), "codes", ("cell",))
    asked = vectors.select(F.col("vec_id").alias("question_id"), "embedding")
    lists = len(index.centroids)
    found = _kept(vector_index.candidates_of(codes, asked, index, lists, id_col="vec_id"), "candidates")
    return vectors, asked, found, vector_index.rerank(vectors, asked, found, search.TOP_K, "vec_id")


def knn_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest vectors by compressed lists and exact re-ranking."""
    return _rounded(_indexed(spark, sf_dir)[-1])


def knn_index_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the index finds nine of ten exact hits and reads under a fifth of the vectors."""
    vectors, asked, found, hits = _indexed(spark, sf_dir)
    exact = search.cosine_topk(vectors, asked, search.TOP_K, id_col="vec_id")
    report = vector_index.recall_report(hits, exact, found, vectors, "vec_id")
    return report.select("questions", (F.col("recall") >= 0.9).alias("recall_enough"),
                         (F.col("read_share") < 0.2).alias("few_read"))


def _staged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(written rows by outcome, balance) of the reviews."""
    folder = _scratch(spark)
    balance = intake.build_reviews(
        _raw_reviews(spark, sf_dir), f"{folder}/staged", f"{folder}/clean", tie_break=["doc_id"])
    return tables.read_table(spark, f"{folder}/staged"), balance


def balance_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """reviews_balance by the footers of what was written, the raw rows read once."""
    return _staged(spark, sf_dir)[1]


def review_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept and rows that go, by reason."""
    return intake.outcomes(_staged(spark, sf_dir)[0])


def review_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row that goes, with its reason and what it held."""
    held = F.get_json_object("record", "$.Pageurl")
    return intake.rejects(_staged(spark, sf_dir)[0]).select("outcome", held.alias("page"))


def _changed(spark: SparkSession, sf_dir: str, compact: bool) -> DataFrame:
    """The vectors as a collection: most at first, then the rest with some replaced, then some
    deleted, of which a few come back."""
    vectors = _table(spark, sf_dir, "embeddings")
    kept = collection.Collection(spark, _scratch(spark), "vec_id")
    kept.add(vectors.where("vec_id % 10 < 8"))
    kept.add(vectors.where("vec_id % 10 IN (1, 8, 9)").withColumn("label", F.col("label") + 100))
    if compact:
        kept.compact()
    kept.delete(vectors.where("vec_id % 10 IN (2, 8)"))
    kept.add(vectors.where("vec_id % 20 = 2").withColumn("label", F.col("label") + 200))
    if compact:
        kept.compact()
    return kept.rows().select("vec_id", "label", F.size("embedding").alias("width"))


def collection_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changed(spark, sf_dir, compact=False)


def collection_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changed(spark, sf_dir, compact=True)


def unmatched_by_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """unmatched_ids, of which only ranges with different digests are joined."""
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return digests.unmatched_by_digest(documents, labels, "doc_id")


def reviews_in_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean reviews of one half of the documents, then of the other against the first's keys."""
    raw = _raw_reviews(spark, sf_dir)
    first = _kept(reviews.clean_reviews(raw.where("doc_id % 2 = 0")).select("review_id", "product_id"), "first")
    bits = dedupe.filter_bits(first.count())
    known = _kept(dedupe.key_filter(first, "review_id", bits), "filter")
    second = _kept(reviews.clean_reviews(raw.where("doc_id % 2 = 1")).select("review_id", "product_id"), "second")
    return first.unionByName(dedupe.drop_seen(second, first, "review_id", known, bits))


def reviews_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean reviews in files by product, rating and date, asked by rating and date."""
    path = f"{_scratch(spark)}/clustered"
    tables.write_clustered(_reviews(spark, sf_dir), path, ["product_id", "rating", "review_date"], 16)
    return tables.read_table(spark, path).where("rating = 4 AND review_date >= date'2010-01-01'").select(
        "review_id", "product_id", "rating", F.col("review_date").cast("string").alias("review_date"))


def _by_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A query as text in a session of its own, so that its views and functions meet no others."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    sql.register(own, reviews=_reviews(own, sf_dir), products=products.clean_products(_raw_products(own, sf_dir)),
                 raw_reviews=_raw_reviews(own, sf_dir), embeddings=_table(own, sf_dir, "embeddings"))
    return own.sql(text)


def sql_rating_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_sql(spark, sf_dir, "SELECT rating, count(*) AS count FROM reviews GROUP BY rating ORDER BY rating")


def sql_product_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_sql(spark, sf_dir, "SELECT product_id, count(*) AS count FROM reviews GROUP BY product_id"
                                  " ORDER BY count DESC, product_id")


def sql_reviews_of_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table function by product, laterally."""
    return _by_sql(spark, sf_dir, "SELECT p.product_id, r.shown, count(*) AS reviews"
                                  " FROM (SELECT DISTINCT product_id FROM reviews) p, LATERAL reviews_of(p.product_id) r"
                                  " GROUP BY p.product_id, r.shown")


def sql_similar_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of each vector with the first of its label."""
    return _by_sql(spark, sf_dir, "WITH first AS (SELECT label, min_by(embedding, vec_id) AS one FROM embeddings"
                                  " GROUP BY label) SELECT vec_id, round(cosine(embedding, one), 6) AS similarity"
                                  " FROM embeddings JOIN first USING (label)")


def sql_title_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table function in Python over all review titles, and lenient numbers of the raw rows."""
    return _by_sql(spark, sf_dir, "SELECT t.token, sum(t.n) AS n, max(lenient_int(Rating)) AS best"
                                  " FROM raw_reviews r, LATERAL tokens(r.Title) t GROUP BY t.token")


_QUERIES = [
    reviews_clean, reviews_from_csv, reviews_written, review_id_stable, reviews_balance,
    rating_distribution, product_frequency, preview, products_clean, products_first_column,
    products_mapped, products_normalised_key, products_balance, avg_rating_distribution,
    lenient_numbers, lenient_dates, embed_text, hashed_vectors, embed_with, vector_rows,
    knn_top5, knn_top2, cosine_of_hits, knn_top5_blocks, knn_lsh, knn_lsh_blocks, questions_valid,
    questions_rejected, search_questions, prompts_built, answers_generated, ask_records,
    hit_records, gate_report, unmatched_ids, typed_numbers, products_from_csv, stages_run,
    inputs_checked, clean_schemas, ingestion_time, knn_doubles, questions_searched, knn_pruned,
    questions_pruned, blocks_skipped, knn_index, knn_index_recall, balance_of_files, review_outcomes,
    review_rejects, collection_changed, collection_compacted, unmatched_by_digest,
    sql_rating_distribution, sql_product_frequency, sql_reviews_of_products, sql_similar_labels,
    sql_title_tokens, raw_preview, raw_schemas, reviews_in_two_runs,
    reviews_clustered,
]
#: Learnt or measured: SQL cannot say it, tests hold it against brute force.
_NO_SQL = {"blocks_skipped", "knn_index"}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: how the cleaned reviews rate."""
    return rating_distribution(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {query.__name__: query for query in _QUERIES}
    if llm_queries:
        found |= {query.__name__: query for query in llm_queries.QUERIES}
        found["pipeline"] = corpus_pipeline.run
    return found


# --- the same in SQL -------------------------------------------------------------------

_RAW_REVIEWS = r"""
raw AS (
  SELECT doc_id,
    CASE WHEN doc_id % 11 <> 3 THEN concat('  ', source, ' in ', lang, ' ') END AS title,
    CASE WHEN doc_id % 29 = 7 THEN '   ' WHEN doc_id % 23 <> 5 THEN text END AS text,
    concat(' ', upper(lang)) AS color,
    CASE lang WHEN 'en' THEN ' Verified Purchase' WHEN 'fr' THEN 'verified purchase'
      WHEN 'de' THEN 'Unverified' END AS verified,
    concat(doc_id % 13 + 1, '/', doc_id % 28 + 1, '/', 2000 + doc_id % 20) AS day,
    concat(doc_id, ' people found this helpful') AS votes,
    CASE WHEN doc_id % 31 <> 4 THEN concat(' ', upper(lang), ' Edition ') END AS product,
    CASE WHEN doc_id % 37 = 6 THEN NULL WHEN doc_id % 7 = 0 THEN concat(doc_id % 8, '.', length(source))
      ELSE concat(7 - length(CAST(n_chars AS VARCHAR)), '.', length(source)) END AS rating
  FROM documents)"""

_REVIEWS = _RAW_REVIEWS + r""",
typed AS (
  SELECT doc_id, trim(title, ' ') AS review_title, trim(text, ' ') AS review_text,
    lower(trim(product, ' ')) AS product_id, lower(trim(color, ' ')) AS product_variant,
    coalesce(lower(trim(verified, ' ')) = 'verified purchase', false) AS is_verified,
    TRY_CAST(regexp_extract(rating, '^\s*([+-]?\d+)(?:\.\d*)?\s*$', 1) AS INTEGER) AS rating,
    TRY_CAST(regexp_replace(votes, '[^0-9]', '', 'g') AS INTEGER) AS helpful_votes,
    CAST(CAST(try_strptime(day, '%m/%d/%Y') AS DATE) AS VARCHAR) AS review_date
  FROM raw),
valid AS (
  SELECT * FROM typed
  WHERE review_text IS NOT NULL AND product_id IS NOT NULL AND rating BETWEEN 1 AND 5),
reviews AS (
  SELECT sha256(concat(length(product_id), ':', product_id, review_text)) AS review_id,
    * EXCLUDE (place)
  FROM (SELECT *, row_number() OVER (
          PARTITION BY product_id, review_text ORDER BY doc_id) AS place FROM valid)
  WHERE place = 1)"""

_OWN_ORDER = ", ".join(f"{c} NULLS FIRST" for c in (
    "rating", "review_title", "product_variant", "is_verified", "helpful_votes", "review_date"))

_REVIEW_ROWS = f"""WITH {_REVIEWS}
SELECT CAST(doc_id AS VARCHAR) AS review_id, product_id, review_title, review_text, rating,
  is_verified, product_variant, helpful_votes, review_date FROM reviews"""

_PARTS = r"""
mapped AS (
  SELECT p_name AS product_id, lower(trim(p_name, ' ')) AS title,
    trim(p_name, ' ') AS description,
    {category} AS category,
    TRY_CAST(regexp_replace(CAST(p_retailprice AS VARCHAR), '[^0-9.]', '', 'g') AS FLOAT) AS price,
    lower(trim(p_brand, ' ')) AS brand,
    {avg_rating} AS avg_rating,
    {review_count} AS review_count
  FROM part WHERE p_name IS NOT NULL)"""

_RAW_PRODUCTS = r"""
mapped AS (
  SELECT {product_id} AS product_id,
    CASE WHEN p_partkey % 13 <> 5 THEN lower(trim(upper(p_name), ' ')) END AS title,
    CASE WHEN p_partkey % 17 <> 3 THEN trim(concat(p_type, ' ', p_name, ' '), ' ') END AS description,
    lower(trim(p_type, ' ')) AS category,
    TRY_CAST(regexp_replace(concat('$', p_retailprice), '[^0-9.]', '', 'g') AS FLOAT) AS price,
    lower(trim(p_brand, ' ')) AS brand,
    CASE WHEN p_size BETWEEN 10 AND 50 THEN CAST(p_size / 10.0 AS FLOAT) END AS avg_rating,
    p_size AS review_count
  FROM part)"""

_ONE_PRODUCT = """,
products AS (
  SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (
    PARTITION BY product_id ORDER BY title NULLS FIRST, description NULLS FIRST,
      category NULLS FIRST, price NULLS FIRST, brand NULLS FIRST, avg_rating NULLS FIRST,
      review_count NULLS FIRST) AS place
    FROM mapped WHERE title IS NOT NULL AND description IS NOT NULL) WHERE place = 1)"""

_PRODUCT_ROWS = """
SELECT product_id, title, description, category, round(CAST(price AS DOUBLE), 2) AS price, brand,
  round(CAST(avg_rating AS DOUBLE), 2) AS avg_rating, review_count FROM products"""

_PARTS_NULL = _PARTS.format(
    category="CAST(NULL AS VARCHAR)", avg_rating="CAST(NULL AS FLOAT)",
    review_count="CAST(NULL AS INTEGER)") + _ONE_PRODUCT
_PARTS_FIRST = _PARTS.format(
    category="CASE WHEN p_partkey IS NULL THEN 'true' ELSE 'false' END",
    avg_rating="CASE WHEN p_partkey BETWEEN 1 AND 5 THEN CAST(p_partkey AS FLOAT) END",
    review_count="TRY_CAST(p_partkey AS INTEGER)") + _ONE_PRODUCT
_MAPPED = _RAW_PRODUCTS.format(product_id="CAST(p_partkey AS VARCHAR)") + _ONE_PRODUCT
_MAPPED_KEY = _RAW_PRODUCTS.format(product_id="lower(trim(p_brand, ' '))") + _ONE_PRODUCT

_QUESTIONS = """
turns AS (
  SELECT concat(conv_id, '-', CASE WHEN turn % 9 = 8 THEN 0 ELSE turn END) AS question_id,
    CASE WHEN turn % 5 = 3 THEN concat(' ', chr(9), chr(10), ' ') WHEN turn % 7 <> 6 THEN text END
      AS question
  FROM conversations),
usable AS (
  SELECT *, count(*) OVER (PARTITION BY question_id) AS same
  FROM turns WHERE trim(question, concat(' ', chr(9), chr(10), chr(13))) <> ''),
questions AS (SELECT question_id, question FROM usable WHERE same = 1)"""


def _counts(name: str, source: str, key: str, text: str) -> str:
    return rf"""
{name} AS (
  SELECT {key}, CAST(concat('0x', substr(md5(token), 1, 8)) AS BIGINT) % 384 AS dim,
    count(*) AS n
  FROM (SELECT {key}, unnest(regexp_split_to_array(lower({text}), '[^a-z0-9]+')) AS token
        FROM {source})
  WHERE token <> '' GROUP BY ALL)"""


_EMBED_TEXT = r"""
texts AS (
  SELECT *, trim(concat(coalesce(review_title, ''), ' ', coalesce(review_text, '')),
    concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13), chr(28), chr(29), chr(30), chr(31),
      chr(133), chr(160))) AS embed_text
  FROM reviews)"""

_TEXT_HITS = f"""{_REVIEWS},{_EMBED_TEXT},{_QUESTIONS},
{_counts("r", "texts", "review_id", "embed_text")},
{_counts("q", "questions", "question_id", "question")},
r_norm AS (SELECT review_id, sqrt(sum(n * n)) AS norm FROM r GROUP BY 1),
q_norm AS (SELECT question_id, sqrt(sum(n * n)) AS norm FROM q GROUP BY 1),
dots AS (
  SELECT question_id, review_id, sum(q.n * r.n) AS dot FROM q JOIN r USING (dim) GROUP BY 1, 2),
scored AS (
  SELECT question_id, review_id,
    CASE WHEN q_norm.norm > 0 AND r_norm.norm > 0
      THEN coalesce(CAST(dot AS DOUBLE), 0) / (q_norm.norm * r_norm.norm) END AS similarity
  FROM questions CROSS JOIN reviews
  LEFT JOIN dots USING (question_id, review_id)
  LEFT JOIN q_norm USING (question_id) LEFT JOIN r_norm USING (review_id)),
hits AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY question_id
      ORDER BY similarity DESC NULLS LAST, review_id) AS INTEGER) AS rank FROM scored)
  WHERE rank <= 5),
ranked AS (SELECT * FROM hits JOIN reviews USING (review_id))"""

_TURN_HITS = _TEXT_HITS.replace(_QUESTIONS, """
usable AS (
  SELECT concat(conv_id, '-', turn) AS question_id, text AS question, count(*) OVER (
    PARTITION BY conv_id, turn) AS same
  FROM conversations
  WHERE trim(text, concat(' ', chr(9), chr(10), chr(13))) <> ''),
questions AS (SELECT question_id, question FROM usable WHERE same = 1)""")


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _block() -> str:
    """A review's block as SQL, from the operator's own format."""
    values = ["rank", "rating", "coalesce(review_title, '')", "review_text"]
    parts = prompts.REVIEW_BLOCK.replace("%d", "%s").split("%s")
    return f"concat({', '.join(x for pair in zip(map(_sql, parts), values) for x in pair)}, {_sql(parts[-1])})"


_BLOCK = _block()
_PROMPTS = f"""{_TEXT_HITS},
contexts AS (
  SELECT question_id, string_agg({_BLOCK}, '' ORDER BY rank) AS context
  FROM ranked GROUP BY 1),
prompts AS (
  SELECT question_id, question, concat(
    {_sql(prompts.INSTRUCTIONS.format(product=PRODUCT))}, {_sql(prompts.REVIEWS_HEADING)}, context,
    {_sql(prompts.QUESTION_HEADING)}, question, {_sql(prompts.ANSWER_CUE)}) AS prompt
  FROM questions JOIN contexts USING (question_id)),
answers AS (
  SELECT question_id, sha256(prompt) AS prompt_hash,
    CASE WHEN md5(prompt)[1] <> '0' THEN concat(md5(prompt), ' in at most 500 tokens') END AS answer,
    CASE WHEN md5(prompt)[1] = '0' THEN 'service is busy' END AS error
  FROM prompts)"""

_VECTOR_SCORES = """
scored AS (
  SELECT q.vec_id AS question_id, v.vec_id AS vec_id,
    list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))
      AS similarity
  FROM embeddings v, embeddings q{where})"""


def _best(k: int, id_col: str = "vec_id") -> str:
    return f"""
SELECT question_id, rank, {id_col}, round(similarity, 6) AS similarity
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY question_id
        ORDER BY similarity DESC NULLS LAST, {id_col}) AS INTEGER) AS rank FROM scored)
WHERE rank <= {k}"""


_LSH = f"""WITH elements AS (
  SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x,
    generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings),
planes AS (
  SELECT bit, dim, CASE WHEN substr(md5(concat('0:', bit, ':', dim)), 1, 1) < '8'
    THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS side
  FROM range({CELLS.bits}) b(bit), range({CELLS.width}) d(dim)),
projected AS (
  SELECT vec_id, bit, sum(x * side) AS p FROM elements JOIN planes USING (dim) GROUP BY 1, 2),
cells AS (
  SELECT vec_id, CAST(sum(CASE WHEN p >= 0 THEN 1 << CAST(bit AS INTEGER) ELSE 0 END) AS INTEGER)
    AS cell FROM projected GROUP BY 1),
distances AS (
  SELECT vec_id, mask, sum(CASE WHEN (mask >> CAST(bit AS INTEGER)) & 1 = 1 THEN p * p ELSE 0 END)
    AS distance
  FROM projected, range(1 << {CELLS.bits}) m(mask) GROUP BY 1, 2),
probes AS (
  SELECT vec_id, CAST(xor(CAST(cell AS BIGINT), mask) AS INTEGER) AS cell
  FROM cells JOIN (SELECT *, row_number() OVER (
      PARTITION BY vec_id ORDER BY distance, mask) AS place FROM distances) USING (vec_id)
  WHERE place <= {PROBES}),
scored AS (
  SELECT p.vec_id AS question_id, c.vec_id AS vec_id,
    list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))
      AS similarity
  FROM probes p JOIN cells c ON p.cell = c.cell
  JOIN embeddings v ON v.vec_id = c.vec_id JOIN embeddings q ON q.vec_id = p.vec_id)
""" + _best(search.TOP_K)

_SHORTEN = "CASE WHEN length({c}) > 60 THEN concat(substr({c}, 1, 57), '...') ELSE {c} END AS {c}"


def _mdy(text: str) -> str:
    return (rf"CAST(CASE WHEN regexp_full_match({text}, '\d{{1,2}}/\d{{1,2}}/\d{{4}}') "
            rf"THEN CAST(try_strptime({text}, '%m/%d/%Y') AS DATE) END AS VARCHAR)")


def oracle_sql() -> dict[str, str]:
    found = _own_oracles()
    if llm_queries:
        found |= llm_oracles.ORACLES
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _own_oracles() -> dict[str, str]:
    month, day, year = "(doc_id % 13 + 1)", "(doc_id % 31 + 1)", "(1990 + n_chars % 40)"
    knn = f"WITH {_VECTOR_SCORES.format(where='')}"
    iso = (f"CAST(CAST(try_strptime(format('{{:d}}-{{:02d}}-{{:02d}}', {year}, {month}, {day}),"
           " '%Y-%m-%d') AS DATE) AS VARCHAR)")
    types = {"reviews": "string string string string int boolean string int date timestamp",
             "products": "string string string string float string float int timestamp"}
    columns = {"reviews": reviews.CLEAN_COLUMNS, "products": products.CLEAN_COLUMNS}
    schema_rows = ", ".join(
        f"('{t}', {i}, '{c}', '{kind}')" for t in types
        for i, (c, kind) in enumerate(zip(columns[t], types[t].split(), strict=True)))
    raw_columns = {
        "reviews": ["Pageurl", "Title", "Review Text", "Review Color", "User Verified", "Review Date",
                    "Review Useful Count", "Configuration Text", "Rating", "Declaration Text"],
        "products": ["asin", "Product Title", "About Product", "Department", "Actual Price", "Manufacturer",
                     "Average Rating", "num_reviews"]}
    raw_rows = ", ".join(f"('{t}', {i}, '{c}', 'string', true)" for t, cs in raw_columns.items() for i, c in enumerate(cs))
    judged = f"""{_REVIEWS},
judged AS (
  SELECT r.doc_id, CASE WHEN r.text IS NULL THEN 'no text' WHEN r.product IS NULL THEN 'no product'
    WHEN r.rating IS NULL THEN 'no rating' WHEN t.rating BETWEEN 1 AND 5 THEN 'kept' ELSE 'rating out of range' END
    AS outcome FROM raw r JOIN typed t USING (doc_id))"""
    changed = """
SELECT vec_id, label + CASE WHEN vec_id % 20 = 2 THEN 200 WHEN vec_id % 10 IN (1, 9) THEN 100 ELSE 0 END AS label,
  len(embedding) AS width FROM embeddings WHERE vec_id % 10 NOT IN (2, 8) OR vec_id % 20 = 2"""
    return {
        "raw_preview": f"""WITH {_RAW_REVIEWS},
sides AS (
  (SELECT 'reviews' AS table_name, CAST(doc_id AS VARCHAR) AS row_key, title, text AS body FROM raw
   ORDER BY doc_id LIMIT 3)
  UNION ALL
  (SELECT 'products', CAST(p_partkey AS VARCHAR), CASE WHEN p_partkey % 13 <> 5 THEN concat(' ', upper(p_name), ' ') END,
     CASE WHEN p_partkey % 17 <> 3 THEN concat(p_type, ' ', p_name, ' ') END
   FROM part ORDER BY p_partkey LIMIT 5))
SELECT table_name, row_key, {_SHORTEN.format(c='title')}, {_SHORTEN.format(c='body')} FROM sides""",
        "raw_schemas": f"""SELECT * FROM (VALUES {raw_rows}) t(table_name, position, "column", type, nullable)""",
        "balance_of_files": f"""WITH {_REVIEWS}
SELECT raw_rows, clean_rows, raw_rows - clean_rows AS dropped_rows
FROM (SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM reviews) AS clean_rows)""",
        "review_outcomes": f"WITH {judged} SELECT outcome, count(*) AS rows FROM judged GROUP BY outcome",
        "review_rejects": f"WITH {judged} SELECT outcome, concat('/reviews/', doc_id) AS page FROM judged"
                          " WHERE outcome <> 'kept'",
        "reviews_clustered": f"""WITH {_REVIEWS} SELECT review_id, product_id, rating, review_date FROM reviews
WHERE rating = 4 AND review_date >= '2010-01-01'""",
        "collection_changed": changed,
        "reviews_in_two_runs": f"WITH {_REVIEWS} SELECT review_id, product_id FROM reviews",
        "collection_compacted": changed,
        "unmatched_by_digest": """
SELECT doc_id, d.doc_id IS NOT NULL AS in_left, l.doc_id IS NOT NULL AS in_right
FROM documents d FULL JOIN labels l USING (doc_id)
WHERE d.doc_id IS NULL OR l.doc_id IS NULL""",
        "sql_rating_distribution": f"""WITH {_REVIEWS}
SELECT rating, count(*) AS "count" FROM reviews GROUP BY rating""",
        "sql_product_frequency": f"""WITH {_REVIEWS}
SELECT product_id, count(*) AS "count" FROM reviews GROUP BY 1""",
        "sql_reviews_of_products": f"""WITH {_REVIEWS}
SELECT product_id, repeat('★', rating) AS shown, count(*) AS reviews FROM reviews GROUP BY 1, 2""",
        "sql_similar_labels": """
WITH first AS (SELECT label, arg_min(embedding, vec_id) AS one FROM embeddings GROUP BY label)
SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(one AS DOUBLE[])), 6) AS similarity
FROM embeddings JOIN first USING (label)""",
        "sql_title_tokens": rf"""WITH {_REVIEWS}
SELECT token, count(*) AS n,
  max(TRY_CAST(regexp_extract(rating, '^\s*([+-]?\d+)(?:\.\d*)?\s*$', 1) AS INTEGER)) AS best
FROM (SELECT unnest(regexp_extract_all(lower(title), '[a-z0-9]+')) AS token, rating FROM raw) GROUP BY token""",
        "reviews_clean": _REVIEW_ROWS,
        "reviews_from_csv": _REVIEW_ROWS,
        "reviews_written": _REVIEW_ROWS,
        "review_id_stable": f"WITH {_REVIEWS} SELECT review_id, product_id, helpful_votes FROM reviews",
        "reviews_balance": f"""WITH {_REVIEWS}
SELECT raw_rows, clean_rows, raw_rows - clean_rows AS dropped_rows
FROM (SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM reviews) AS clean_rows)""",
        "rating_distribution": f"""WITH {_REVIEWS}
SELECT rating, count(*) AS "count" FROM reviews GROUP BY rating ORDER BY rating""",
        "product_frequency": f"""WITH {_REVIEWS}
SELECT product_id, count(*) AS "count" FROM reviews GROUP BY 1 ORDER BY 2 DESC, 1""",
        "preview": f"""WITH {_REVIEWS}
SELECT {_SHORTEN.format(c='review_id')}, {_SHORTEN.format(c='review_title')},
  {_SHORTEN.format(c='review_text')}, rating
FROM (SELECT * FROM reviews ORDER BY review_id LIMIT 5)""",
        "products_clean": f"WITH {_PARTS_NULL} {_PRODUCT_ROWS}",
        "products_first_column": f"WITH {_PARTS_FIRST} {_PRODUCT_ROWS}",
        "products_mapped": f"WITH {_MAPPED} {_PRODUCT_ROWS}",
        "products_normalised_key": f"WITH {_MAPPED_KEY} {_PRODUCT_ROWS}",
        "products_balance": f"""WITH {_PARTS_NULL}
SELECT raw_rows, clean_rows, raw_rows - clean_rows AS dropped_rows
FROM (SELECT (SELECT count(*) FROM part) AS raw_rows, (SELECT count(*) FROM products) AS clean_rows)""",
        "avg_rating_distribution": f"""WITH {_MAPPED}
SELECT round(CAST(avg_rating AS DOUBLE), 2) AS avg_rating, count(*) AS "count"
FROM products GROUP BY products.avg_rating ORDER BY 1 NULLS FIRST""",
        "lenient_numbers": """
SELECT doc_id, CAST(n_chars AS INTEGER) AS int_plain, CAST(-n_chars AS INTEGER) AS int_cut,
  CAST(NULL AS INTEGER) AS int_suffix,
  TRY_CAST(n_chars * 100000000 AS INTEGER) AS int_large,
  CAST(n_chars AS INTEGER) AS digits_double, CAST(n_chars * 10 + 5 AS INTEGER) AS digits_people,
  CAST(NULL AS INTEGER) AS digits_none,
  round(CAST(CAST(n_chars + 0.5 AS FLOAT) AS DOUBLE), 1) AS price_sign,
  CAST(NULL AS DOUBLE) AS price_range, CAST(NULL AS DOUBLE) AS float_suffix,
  CASE WHEN n_chars BETWEEN 100 AND 5000 THEN n_chars END AS in_range,
  CASE WHEN n_chars >= 1000 THEN n_chars END AS from_1000
FROM documents""",
        "lenient_dates": f"""
SELECT doc_id, {_mdy(f"concat({month}, '/', {day}, '/', {year})")} AS short,
  {_mdy(f"format('{{:02d}}/{{:02d}}/{{:d}}', {month}, {day}, {year})")} AS padded,
  {iso} AS iso,
  CAST(NULL AS VARCHAR) AS two_digit_year,
  {_mdy(f"concat({day}, '/', {month}, '/', {year})")} AS day_first,
  {iso} AS iso_time, {iso} AS iso_t_time,
  coalesce(lang = 'en', false) AS is_en, coalesce(lang = 'fr', false) AS is_fr
FROM documents""",
        "embed_text": f"WITH {_REVIEWS},{_EMBED_TEXT} SELECT review_id, embed_text FROM texts",
        "hashed_vectors": f"""WITH {_counts("d", "documents", "doc_id", "text")},
norms AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM d GROUP BY 1)
SELECT doc_id, CAST(dim AS INTEGER) AS dim,
  round(CAST(CAST(n / norm AS FLOAT) AS DOUBLE), 6) AS weight FROM d JOIN norms USING (doc_id)""",
        "embed_with": f"""WITH {_counts("d", "documents", "doc_id", "text")}
SELECT doc_id, CAST(dim AS INTEGER) AS dim, n AS weight FROM d""",
        "vector_rows": f"""WITH {_REVIEWS},{_EMBED_TEXT},
{_counts("r", "texts", "review_id", "embed_text")},
sums AS (SELECT review_id, CAST(sum(n) AS BIGINT) AS tokens FROM r GROUP BY 1)
SELECT review_id, coalesce(review_text, '') AS document, product_id, coalesce(rating, 0) AS rating,
  coalesce(review_title, '') AS review_title, 384 AS width, coalesce(tokens, 0) AS tokens
FROM reviews LEFT JOIN sums USING (review_id)""",
        "knn_top5": knn + _best(5),
        "knn_top2": knn + _best(2),
        "cosine_of_hits": knn + _best(2),
        "knn_top5_blocks": knn + _best(5),
        "knn_lsh": _LSH,
        "knn_lsh_blocks": _LSH,
        "questions_valid": f"WITH {_QUESTIONS} SELECT question_id, question FROM questions",
        "questions_rejected": f"""WITH {_QUESTIONS}
SELECT question_id,
  CASE WHEN question IS NULL THEN 'question is null' ELSE 'question is empty' END AS reason
FROM turns WHERE coalesce(trim(question, concat(' ', chr(9), chr(10), chr(13))), '') = ''
UNION ALL SELECT question_id, 'question_id is not unique' FROM usable WHERE same > 1""",
        "search_questions": f"""WITH {_TEXT_HITS}
SELECT question_id, rank, review_id, round(similarity, 6) AS similarity FROM hits WHERE rank <= 2""",
        "prompts_built": f"""WITH {_PROMPTS}
SELECT question_id, prompt, CAST(length(prompt) AS INTEGER) AS prompt_chars FROM prompts""",
        "answers_generated": f"WITH {_PROMPTS} SELECT * FROM answers",
        "ask_records": f"""WITH {_PROMPTS}
SELECT question_id, question, answer, error, rank, review_id AS id, rating,
  coalesce(review_title, '') AS title, substr(review_text, 1, 200) AS "text"
FROM questions JOIN answers USING (question_id) JOIN ranked USING (question_id)""",
        "hit_records": f"""WITH {_TEXT_HITS}
SELECT question_id, rank, review_id AS id, rating, coalesce(review_title, '') AS title,
  substr(review_text, 1, 200) AS "text", repeat('⭐', rating) AS stars FROM ranked""",
        "gate_report": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) > 0 AS ok FROM {t}"
            for t in ["documents", "part", "embeddings", "conversations"]),
        # no id reaches the raw files, so of equal reviews the operator's own order decides
        "questions_searched": f"""WITH {_TURN_HITS.replace("review_text ORDER BY doc_id", "review_text ORDER BY " + _OWN_ORDER)}
SELECT question_id, rank, round(similarity, 6) AS similarity FROM hits WHERE rank <= 2""",
        "typed_numbers": """
SELECT o_orderkey, round(CAST(CAST(o_totalprice * 1000 AS FLOAT) AS DOUBLE) / 1e4) AS price_large,
  round(CAST(CAST(CAST(o_totalprice AS DOUBLE) * 1000 / 1e10 AS FLOAT) AS DOUBLE), 5) AS price_small,
  TRY_CAST(floor(CAST(o_totalprice AS DOUBLE) * 1000 / 100) AS INTEGER) AS digits_large FROM orders""",
        "products_from_csv": f"WITH {_MAPPED} {_PRODUCT_ROWS}",
        "stages_run": f"""WITH {_REVIEWS}, {_MAPPED.strip()}
SELECT 'reviews' AS stage, (SELECT count(*) FROM raw) AS raw_rows, count(*) AS rows,
  (SELECT count(*) FROM raw) - count(*) AS dropped_rows FROM reviews
UNION ALL SELECT 'products', (SELECT count(*) FROM part), count(*),
  (SELECT count(*) FROM part) - count(*) FROM products
UNION ALL SELECT 'vectors', count(*), count(*), 0 FROM reviews""",
        "inputs_checked": "SELECT * FROM (VALUES ('documents', true, (SELECT count(*) > 0 FROM documents)),"
        " ('part', true, (SELECT count(*) > 0 FROM part)), ('no_such_table', false, false))"
        " t(input, there, ok)",
        "clean_schemas": f"""WITH {_REVIEWS}, {_MAPPED.strip()}
SELECT table_name, position, "column", type, CASE table_name
  WHEN 'reviews' THEN (SELECT count(*) FROM reviews) ELSE (SELECT count(*) FROM products) END AS row_count
FROM (VALUES {schema_rows}) t(table_name, position, "column", type)""",
        "ingestion_time": f"""WITH {_REVIEWS}
SELECT least(count(*), 1) AS times, count(*) AS rows_with_time, count(*) AS row_count FROM reviews""",
        "knn_doubles": f"""WITH fine AS (
  SELECT vec_id, list_transform(embedding, lambda x, i: CAST(x AS DOUBLE) + vec_id * 1e-13 * ((i - 1) % 3))
    AS v FROM embeddings),
scored AS (
  SELECT q.vec_id AS question_id, f.vec_id AS vec_id, list_cosine_similarity(f.v, q.v) AS similarity
  FROM fine f, fine q WHERE q.vec_id % 20 = 0){_best(5)}""",
        "knn_pruned": knn + _best(5),
        "questions_pruned": f"""WITH {_TEXT_HITS}
SELECT question_id, rank, review_id, round(similarity, 6) AS similarity FROM hits WHERE rank <= 2""",
        "knn_index_recall": "SELECT count(*) AS questions, true AS recall_enough, true AS few_read FROM embeddings",
        "unmatched_ids": """
SELECT doc_id, d.doc_id IS NOT NULL AS in_left, l.doc_id IS NOT NULL AS in_right
FROM documents d FULL JOIN labels l USING (doc_id)
WHERE d.doc_id IS NULL OR l.doc_id IS NULL""",
    }
