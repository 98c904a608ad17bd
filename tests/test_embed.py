import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import embed

TEXTS = ["Good sound, GOOD price!", "", None, "Écoute bien", "a a a b", "  \n ", "x1-y2_z3"]


def expected_counts(text, width=384):
    tokens = re.findall("[a-z0-9]+", (text or "").lower())
    return Counter(int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % width for t in tokens)


def frame(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "i int, embed_text string")


def test_counts(spark):
    rows = embed.hashed_embeddings(frame(spark)).orderBy("i").collect()
    for row, text in zip(rows, TEXTS):
        assert len(row["embedding"]) == 384
        assert {d: x for d, x in enumerate(row["embedding"]) if x} == expected_counts(text)


def test_unit_vectors(spark):
    rows = embed.hashed_embeddings(frame(spark), unit=True).orderBy("i").collect()
    for row, text in zip(rows, TEXTS):
        length = math.sqrt(sum(x * x for x in row["embedding"]))
        assert length == pytest.approx(1.0 if expected_counts(text) else 0.0, abs=1e-6)


def test_width_and_batches(spark, monkeypatch):
    monkeypatch.setattr(embed, "_HASH_ROWS", 3)
    monkeypatch.setattr(embed, "_KNOWN_TOKENS", 2)
    rows = embed.hashed_embeddings(frame(spark), width=16).orderBy("i").collect()
    for row, text in zip(rows, TEXTS):
        assert {d: x for d, x in enumerate(row["embedding"]) if x} == expected_counts(text, 16)


def test_replaces_a_column_and_keeps_the_others(spark):
    df = frame(spark).withColumn("embedding", F.lit(1)).withColumn("other", F.col("i") * 2)
    out = embed.hashed_embeddings(df)
    assert sorted(out.columns) == sorted(["i", "embed_text", "other", "embedding"])
    assert dict(out.dtypes)["embedding"] == "array<float>"


def test_dimension_rows_evaluates_once(spark):
    out = embed.dimension_rows(embed.hashed_embeddings(frame(spark)), "i")
    assert {(r["i"], r["dim"]): r["weight"] for r in out.collect()} == {
        (i, d): n for i, t in enumerate(TEXTS) for d, n in expected_counts(t).items()}
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_no_shuffle(spark):
    plan = embed.hashed_embeddings(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def lengths_model():
    def load():
        sizes = []

        def encode(texts):
            sizes.append(len(texts))
            return [[float(len(t)), float(max(sizes)), float(len(sizes))] for t in texts]

        return encode

    return load


def test_embed_with_loads_once_and_batches(spark):
    df = frame(spark, ["x" * i for i in range(150)]).coalesce(1)
    rows = embed.embed_with(df, lengths_model()).orderBy("i").collect()
    assert [r["embedding"][0] for r in rows] == [float(i) for i in range(150)]
    assert rows[-1]["embedding"][1:] == [64.0, 3.0]
    assert rows[2]["embed_text"] == "xx"


def test_embed_with_null_text(spark):
    rows = embed.embed_with(frame(spark, [None, "ab"]), lengths_model(), batch_size=1).collect()
    assert sorted((r["embed_text"] or "", r["embedding"][0]) for r in rows) == [("", 0.0), ("ab", 2.0)]


def test_a_model_that_loses_rows_is_an_error(spark):
    def bad():
        return lambda texts: [[0.0]] * (len(texts) - 1)

    with pytest.raises(Exception, match="model returned"):
        embed.embed_with(frame(spark), bad).collect()


def test_vector_rows_default_nulls(spark):
    df = spark.createDataFrame(
        [(7, [1.0], None, "p", None, None)],
        "review_id int, embedding array<float>, review_text string, product_id string,"
        " rating int, review_title string")
    assert embed.vector_rows(df).first().asDict() == {
        "review_id": "7", "embedding": [1.0], "document": "", "product_id": "p", "rating": 0,
        "review_title": ""}


def test_models_run_in_as_many_tasks_as_asked(spark):
    df = spark.createDataFrame([(i % 50, f"text {i}") for i in range(400)], "k int, embed_text string")
    one = df.dropDuplicates(["k"])
    for first in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", first)
        try:
            for made in (embed.hashed_embeddings(one, tasks=7),
                         embed.embed_with(one, lambda: lambda texts: [[1.0]] * len(texts), tasks=7)):
                assert made.rdd.getNumPartitions() == 7
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")


def test_vectors_of_unequal_width_are_an_error(spark):
    df = spark.createDataFrame([("a",), ("bb",)], "embed_text string").coalesce(1)
    with pytest.raises(Exception, match="wide"):
        embed.embed_with(df, lambda: lambda texts: [[1.0] * len(t) for t in texts]).collect()


def test_new_tokens_without_end_take_no_more_memory():
    dimensions = embed._Dimensions(8)
    for at in range(0, 200_000, 50_000):
        for n in range(at, at + 50_000):
            dimensions[b"%d" % n]
        assert len(dimensions) <= 1 << 16
    want = int.from_bytes(hashlib.md5(b"7").digest()[:4], "big") % 8
    assert dimensions[b"7"] == want and dimensions[b""] == -1
