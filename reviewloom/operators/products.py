"""Raw products with unknown headers to clean products."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions import lenient
from reviewloom.operators.dedupe import keep_one


class HeaderRule(NamedTuple):
    """A header means ``field`` if it holds one of ``parts`` or is one of ``names``."""

    field: str
    parts: tuple[str, ...]
    names: tuple[str, ...] = ()
    without: tuple[str, ...] = ()

    def matches(self, header: str) -> bool:
        if any(part in header for part in self.without):
            return False
        return header in self.names or any(part in header for part in self.parts)


# What each standard field is called in the wild. The first rule that
# matches a header decides what it means.
HEADER_RULES = (
    HeaderRule("product_id", ("product_id",), names=("id", "asin")),
    HeaderRule("title", ("title", "name")),
    HeaderRule("description", ("description", "about", "feature")),
    HeaderRule("category", ("category", "department")),
    HeaderRule("price", ("price",)),
    HeaderRule("brand", ("brand", "manufacturer")),
    HeaderRule("avg_rating", ("rating",), without=("count", "num")),
    HeaderRule("review_count", ("review_count", "num_review", "total_review")),
)
# Fixed values.
LOWEST_AVG, HIGHEST_AVG = 1.0, 5.0
# The output columns in order.
CLEAN_COLUMNS = [
    "product_id", "title", "description", "category", "price", "brand",
    "avg_rating", "review_count", "ingestion_ts",
]
_OPTIONAL = ["category", "price", "brand", "avg_rating", "review_count"]


def detect_columns(headers: Sequence[str]) -> dict[str, str]:
    """Standard field -> header. Of several headers for one field the last one wins."""
    found: dict[str, str] = {}
    for header in headers:
        plain = header.lower().strip()
        field = next((rule.field for rule in HEADER_RULES if rule.matches(plain)), None)
        if field is not None:
            found[field] = header
    return found


def map_products(raw: DataFrame, missing: str = "null") -> DataFrame:
    """The eight standard columns, typed.

    An undetected id falls back to the title, an undetected description likewise, and an
    undetected title to the first column. Undetected optional columns are null, or with
    ``missing="first_column"`` made of the first column.
    """
    if missing not in ("null", "first_column"):
        raise ValueError(f"missing must be 'null' or 'first_column', not {missing!r}")
    headers = raw.columns
    found = detect_columns(headers)
    types = {field.name: field.dataType for field in raw.schema.fields}
    first = headers[0]

    def column(header: str) -> Column:
        return F.col("`" + header.replace("`", "``") + "`")

    title = found.get("title", first)
    sources = {
        "product_id": found.get("product_id", title),
        "title": title,
        "description": found.get("description", title),
    }
    selected = [column(h).cast("string").alias(field) for field, h in sources.items()]

    parse = {
        "category": lambda h: column(h).cast("string"),
        "price": lambda h: lenient.price(column(h), types[h]),
        "brand": lambda h: column(h).cast("string"),
        "avg_rating": lambda h: lenient.to_float(column(h)),
        "review_count": lambda h: lenient.to_int(column(h), types[h]),
    }
    # What the first column stands for where a field is not there.
    from_first = {
        "category": lambda: column(first).isNull().cast("string"),
        "price": lambda: lenient.to_float(column(first)),
        "brand": lambda: column(first).cast("string"),
        "avg_rating": lambda: lenient.to_float(column(first)),
        "review_count": lambda: lenient.to_int(column(first), types[first]),
    }
    null_types = {"category": "string", "price": "float", "brand": "string",
                  "avg_rating": "float", "review_count": "int"}
    for field in _OPTIONAL:
        if field in found:
            value = parse[field](found[field])
        elif missing == "first_column":
            value = from_first[field]()
        else:
            value = F.lit(None).cast(null_types[field])
        selected.append(value.alias(field))
    return raw.select(*selected)


def clean_products(
    raw: DataFrame, missing: str = "null", normalise_key: bool = False
) -> DataFrame:
    """One clean row per product id.

    Incomplete rows are filtered before the dedupe, so a product is lost only if none of
    its rows is complete, and the shuffle carries complete rows only. ``normalise_key``
    lower-cases and trims the id as review product ids are, so that the two tables join.
    """
    mapped = map_products(raw, missing).filter(
        F.col("product_id").isNotNull() & F.col("title").isNotNull()
        & F.col("description").isNotNull()
    )
    if normalise_key:
        mapped = mapped.withColumn("product_id", lenient.label(F.col("product_id")))
    tidy = mapped.select(
        "product_id",
        lenient.label(F.col("title")).alias("title"),
        F.trim(F.col("description")).alias("description"),
        lenient.label(F.col("category")).alias("category"),
        lenient.null_outside(F.col("price"), low=0).alias("price"),
        lenient.label(F.col("brand")).alias("brand"),
        lenient.null_outside(F.col("avg_rating"), LOWEST_AVG, HIGHEST_AVG).alias("avg_rating"),
        "review_count",
    )
    order = ["title", "description", *_OPTIONAL]
    return (
        keep_one(tidy, ["product_id"], order)
        .withColumn("ingestion_ts", F.current_timestamp())
        .select(*CLEAN_COLUMNS)
    )
