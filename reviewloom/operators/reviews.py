"""Raw reviews to clean reviews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions import lenient, text
from reviewloom.operators.dedupe import keep_one

# Raw header -> standard name.
RAW_TO_STANDARD = {
    "Title": "review_title",
    "Review Text": "review_text",
    "Review Color": "product_variant",
    "User Verified": "is_verified",
    "Review Date": "review_date_raw",
    "Review Useful Count": "helpful_votes_raw",
    "Configuration Text": "product_name",
    "Rating": "rating_raw",
    "Declaration Text": "declaration",
    "Pageurl": "page_url",
}
# The output columns in order.
CLEAN_COLUMNS = [
    "review_id", "product_id", "review_title", "review_text", "rating",
    "is_verified", "product_variant", "helpful_votes", "review_date", "ingestion_ts",
]
# Fixed values.
VERIFIED = "verified purchase"
LOWEST_RATING, HIGHEST_RATING = 1, 5

# Raw columns that the clean table does not need.
_UNUSED = {"declaration", "page_url"}
_ID = "__content_id"


def rename_reviews(raw: DataFrame) -> DataFrame:
    """Standard names; a header that is not there is passed over."""
    return raw.withColumnsRenamed(RAW_TO_STANDARD)


def clean_reviews(
    raw: DataFrame, id_col: str | None = None, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Typed, filtered and deduplicated reviews.

    A review is one (trimmed text, product) pair. Its id is a hash of that pair: the same
    on every run and under every partitioning, and at the same time the short shuffle key
    of the dedupe, so long texts are compared nowhere. ``id_col`` names a column that
    holds ids already; ``tie_break`` names raw columns that decide first which copy stays.
    """
    df = rename_reviews(raw)
    types = {field.name: field.dataType for field in df.schema.fields}
    missing = [c for c in RAW_TO_STANDARD.values() if c not in types and c not in _UNUSED]
    if missing:
        raise ValueError(f"raw reviews lack columns for: {', '.join(missing)}")

    # Trimming makes no nulls. On the raw columns these filters reach the scan, which they
    # do not on trimmed ones or as dropna.
    for needed in ("review_text", "product_name", "rating_raw"):
        df = df.filter(F.col(needed).isNotNull())

    tie_break = [RAW_TO_STANDARD.get(c, c) for c in tie_break]
    id_col = RAW_TO_STANDARD.get(id_col, id_col)
    extra = list(dict.fromkeys([*tie_break, *([id_col] if id_col else [])]))
    rating = lenient.to_int(F.col("rating_raw"), types["rating_raw"])
    typed = df.select(
        lenient.label(F.col("product_name")).alias("product_id"),
        F.trim(F.col("review_title").cast("string")).alias("review_title"),
        F.trim(F.col("review_text").cast("string")).alias("review_text"),
        lenient.null_outside(rating, LOWEST_RATING, HIGHEST_RATING).alias("rating"),
        lenient.flag(F.col("is_verified"), VERIFIED).alias("is_verified"),
        lenient.label(F.col("product_variant")).alias("product_variant"),
        lenient.digits(F.col("helpful_votes_raw"), types["helpful_votes_raw"]).alias("helpful_votes"),
        lenient.parse_date(F.col("review_date_raw"), types["review_date_raw"]).alias("review_date"),
        *[F.col(f"`{c}`").alias(f"__extra_{i}") for i, c in enumerate(extra)],
    )
    kept = typed.filter(F.col("rating").isNotNull())
    keyed = kept.withColumn(_ID, text.content_id(F.col("product_id"), F.col("review_text")))
    order = [f"__extra_{extra.index(c)}" for c in tie_break] + [
        "rating", "review_title", "product_variant", "is_verified", "helpful_votes", "review_date",
    ]
    if id_col:
        order.append(f"__extra_{extra.index(id_col)}")
    one = keep_one(keyed, [_ID], order)
    review_id = f"__extra_{extra.index(id_col)}" if id_col else _ID
    return (
        one.withColumn("review_id", F.col(review_id).cast("string"))
        .withColumn("ingestion_ts", F.current_timestamp())
        .select(*CLEAN_COLUMNS)
    )
