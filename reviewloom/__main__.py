"""Run the stages: ``python -m reviewloom STAGE ...`` or through spark-submit.

    reviews   RAW CLEAN            clean a reviews CSV into a Parquet table
    products  RAW CLEAN            clean a products CSV into a Parquet table
    vectors   REVIEWS VECTORS      embed clean reviews with hashed token counts
    search    VECTORS QUESTION...  print the nearest reviews of each question
    run       RAW_REVIEWS RAW_PRODUCTS OUTPUT   all stages, with checks
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.operators import embed, gates, products, prompts, reviews, search, stats
from reviewloom.plans import stages
from reviewloom.sources import tables


def _summary(raw: DataFrame, clean: DataFrame, counts: list[tuple[str, str]]) -> None:
    stats.schema_rows(raw).show(truncate=False)
    stats.preview(raw, 5, 60).show(truncate=False)
    stats.row_balance(raw, clean).show()
    stats.preview(clean, 5, 60).show(truncate=False)
    stats.schema_rows(clean).show(truncate=False)
    for column, by in counts:
        stats.value_counts(clean, column, by).show()


def _reviews(spark: SparkSession, args: argparse.Namespace) -> None:
    gates.require_input(spark, args.raw)
    raw = tables.read_csv(spark, args.raw, not args.single_line)
    tables.write_table(reviews.clean_reviews(raw), args.clean)
    clean = tables.read_table(spark, args.clean)
    _summary(raw, clean, [("rating", "value"), ("product_id", "count")])


def _products(spark: SparkSession, args: argparse.Namespace) -> None:
    gates.require_input(spark, args.raw)
    raw = tables.read_csv(spark, args.raw, not args.single_line)
    print(f"detected columns: {products.detect_columns(raw.columns)}")
    tables.write_table(products.clean_products(raw, args.missing), args.clean)
    _summary(raw, tables.read_table(spark, args.clean), [("avg_rating", "value")])


def _vectors(spark: SparkSession, args: argparse.Namespace) -> None:
    clean = embed.with_embed_text(tables.read_table(spark, args.reviews))
    rows = embed.with_shard(embed.vector_rows(embed.hashed_embeddings(clean)))
    tables.write_table(rows, args.vectors, partition_by=[embed.SHARD])
    print(f"{gates.require_rows(tables.read_table(spark, args.vectors), args.vectors)} vectors")


def _search(spark: SparkSession, args: argparse.Namespace) -> None:
    asked = spark.createDataFrame(
        list(enumerate(args.question)), "question_id bigint, question string")
    vectors = tables.read_table(spark, args.vectors)
    valid, _ = search.split_questions(asked)
    hits = search.search_questions(
        vectors, valid, lambda q: embed.hashed_embeddings(q, "question"), args.k)
    ranked = prompts.with_reviews(hits, vectors).join(valid, "question_id")
    ranked.orderBy("question_id", "rank").select(
        "question", "rank", "similarity", "rating", F.substring("document", 1, 100).alias("document"),
    ).show(args.k * len(args.question), truncate=False)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    paths = stages.Paths(
        args.raw_reviews, args.raw_products, f"{args.output}/reviews_clean",
        f"{args.output}/products_clean", f"{args.output}/vectors")
    report = stages.run(
        spark, paths, missing=args.missing, multi_line=not args.single_line, count_raw=True)
    for name, rows in report.rows.items():
        print(f"{name}: {rows} rows")
    for name in report.raw_rows:
        print(f"{name}: {report.input_bytes[name]} bytes, {report.dropped(name)} rows dropped")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(
        prog="reviewloom", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    commands = parser.add_subparsers(required=True)

    def command(name, action, *arguments, csv=False, missing=False):
        sub = commands.add_parser(name)
        for argument in arguments:
            sub.add_argument(argument, nargs="+" if argument == "question" else None)
        if csv:
            sub.add_argument("--single-line", action="store_true",
                             help="no cell holds a newline, so large files can be split")
        if missing:
            sub.add_argument("--missing", default="null", choices=["null", "first_column"])
        sub.set_defaults(action=action)
        return sub

    command("reviews", _reviews, "raw", "clean", csv=True)
    command("products", _products, "raw", "clean", csv=True, missing=True)
    command("vectors", _vectors, "reviews", "vectors")
    command("search", _search, "vectors", "question").add_argument(
        "-k", type=int, default=search.CHECK_K)
    command("run", _run, "raw_reviews", "raw_products", "output", csv=True, missing=True)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    args.action(SparkSession.builder.appName("reviewloom").getOrCreate(), args)


if __name__ == "__main__":
    main()
