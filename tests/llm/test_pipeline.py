"""The stages on small tables, the registered queries, and their SQL."""

import duckdb
import pytest
from helpers import awkward
from pyspark.sql import functions as F

import corpus_pipeline
from reviewloom.llm import oracles, queries

DATA = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark, folder):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == corpus_pipeline.COLUMNS
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert docs.count() >= 0.75 * before
    pieces = corpus_pipeline.best_fit_packing(spark, docs, DATA)
    assert pieces.select("doc_id").distinct().count() == docs.count()


def test_stages_take_awkward_rows(spark):
    docs = awkward(spark)
    left = {name: stage(spark, docs, DATA).count() for name, stage in corpus_pipeline.STAGES[:-1]}
    assert left["suffix_array_dedup"] == 13 and left["benchmark_decontamination"] == 13
    assert left["minhash_near_dedup"] == 11  # a copy of the long text and a repeated row go
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, DATA).count() == 0


def test_removed_bytes_are_gone_from_the_text(spark):
    passage = " ".join(f"word{i}" for i in range(90))
    rows = [(1, f"first {passage} end", "en", "s", 1), (2, f"second {passage}", "en", "s", 2), (3, "own", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r for r in corpus_pipeline.suffix_array_dedup(spark, docs, DATA).collect()}
    assert found[1].text == "first end" and found[1].n_chars == len("first end") or "word" not in found[1].text
    assert "word50" not in found[2].text and (found[3].text, found[3].n_chars) == ("own", None)


def test_whole_run(spark):
    pieces = corpus_pipeline.run(spark, DATA)
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()


@pytest.mark.parametrize("query", queries.QUERIES, ids=lambda q: q.__name__)
def test_query_and_its_sql(spark, query):
    got = query(spark, DATA)
    rows = sorted(map(tuple, got.collect()), key=str)
    assert rows
    if query.__name__ in oracles.ORACLES:
        connection = duckdb.connect()
        for name in ("documents", "pages", "benchmark"):
            connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
        want = connection.sql(oracles.ORACLES[query.__name__])
        assert sorted(want.columns) == sorted(got.columns)
        assert sorted(want.select(*got.columns).fetchall(), key=str) == rows
