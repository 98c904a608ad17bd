"""The clean tables under SQL: views, functions and table functions of a session."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.operators.search import TOP_K

_FUNCTIONS = [
    "stars(rating INT) RETURNS STRING RETURN repeat('★', rating)",
    "lenient_int(cell STRING) RETURNS INT"
    r" RETURN try_cast(regexp_extract(cell, '^\\s*([+-]?\\d+)(?:\\.\\d*)?\\s*$', 1) AS INT)",
    "dot(a ARRAY<FLOAT>, b ARRAY<FLOAT>) RETURNS DOUBLE RETURN aggregate(zip_with(a, b,"
    " (x, y) -> CAST(x AS DOUBLE) * y), 0D, (s, x) -> s + x)",
    "cosine(a ARRAY<FLOAT>, b ARRAY<FLOAT>) RETURNS DOUBLE"
    " RETURN dot(a, b) / nullif(sqrt(dot(a, a)) * sqrt(dot(b, b)), 0D)",
]
_TABLE_FUNCTIONS = {
    "reviews": "reviews_of(product STRING) RETURNS TABLE (review_id STRING, rating INT, review_title STRING, shown STRING)"
    " RETURN SELECT review_id, rating, review_title, stars(rating) FROM reviews WHERE product_id = product",
    "vectors": "nearest_reviews(asked ARRAY<FLOAT>) RETURNS TABLE (review_id STRING, similarity DOUBLE)"
    " RETURN SELECT review_id, cosine(embedding, asked) AS similarity FROM vectors"
    f" ORDER BY similarity DESC NULLS LAST, review_id LIMIT {TOP_K}",
}


@F.udtf(returnType="token string, n int")
class Tokens:
    """The tokens of a text (runs of ASCII letters and digits, in lower case) and how often each comes."""

    def eval(self, text: str | None):
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        yield from Counter(re.findall("[a-z0-9]+", lowered)).items()


def register(spark: SparkSession, **views: DataFrame) -> None:
    """Name tables for ``spark.sql`` (``reviews``, ``products``, ``vectors`` and any others) with the
    functions ``stars``, ``lenient_int``, ``dot``, ``cosine`` and ``tokens``, and the table functions
    over those that are given: ``reviews_of`` a product, and ``nearest_reviews`` to a vector. All are
    the session's own and go with it. The scalar functions are SQL, which Spark puts into the plan."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    for function in [*_FUNCTIONS, *(f for view, f in _TABLE_FUNCTIONS.items() if view in views)]:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {function}")
    spark.udtf.register("tokens", Tokens)
