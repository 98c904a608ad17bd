import pytest

from reviewloom.operators import products


@pytest.mark.parametrize("headers,mapping", [
    ("product_id,title,description,category,price,brand,avg_rating,review_count",
     {f: f for f in ["product_id", "title", "description", "category", "price", "brand",
                     "avg_rating", "review_count"]}),
    ("asin,product_name,brand_name,about_product,discounted_price,actual_price,rating,rating_count",
     {"product_id": "asin", "title": "brand_name", "description": "about_product",
      "price": "actual_price", "avg_rating": "rating"}),
    ("ID,Name,Image Name,Sub Category,Features",
     {"product_id": "ID", "title": "Image Name", "category": "Sub Category",
      "description": "Features"}),
    ("Pageurl,Title,Review Text,Configuration Text,Rating",
     {"title": "Title", "avg_rating": "Rating"}),
    ("p_partkey,p_name,p_brand,p_type,p_size,p_retailprice",
     {"title": "p_name", "brand": "p_brand", "price": "p_retailprice"}),
    (" Asin , Department ,num_reviews,total_reviews,Manufacturer",
     {"product_id": " Asin ", "category": " Department ", "review_count": "total_reviews",
      "brand": "Manufacturer"}),
    ("rating_num,Valid", {}),
])
def test_detection(headers, mapping):
    assert products.detect_columns(headers.split(",")) == mapping


def frame(spark, headers, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"`{h}` string" for h in headers.split(",")))


FULL = "product_id,title,description,category,price,brand,avg_rating,review_count"


def test_an_ordinary_product(spark):
    df = products.clean_products(frame(spark, FULL, (
        "007", " Echo Dot ", " Small speaker ", " Audio ", "$1,299.99", " ACME ", "4.2", "12.0")))
    assert df.columns == products.CLEAN_COLUMNS
    assert dict(df.dtypes) == {
        "product_id": "string", "title": "string", "description": "string", "category": "string",
        "price": "float", "brand": "string", "avg_rating": "float", "review_count": "int",
        "ingestion_ts": "timestamp"}
    row = df.first()
    assert row["product_id"] == "007" and row["title"] == "echo dot"
    assert row["description"] == "Small speaker" and row["category"] == "audio"
    assert round(row["price"], 2) == 1299.99 and row["brand"] == "acme"
    assert round(row["avg_rating"], 2) == 4.2 and row["review_count"] == 12


@pytest.mark.parametrize("price,expected", [
    ("-5.00", 5.0), ("10.00 - 20.00", None), (None, None), ("0", 0.0)])
def test_price(spark, price, expected):
    row = products.clean_products(
        frame(spark, FULL, ("1", "t", "d", "c", price, "b", "4", "1"))).first()
    assert row["price"] == expected


@pytest.mark.parametrize("rating,expected", [
    ("0.5", None), ("5.1", None), ("NaN", None), ("1", 1.0), ("good", None), (None, None)])
def test_avg_rating(spark, rating, expected):
    row = products.clean_products(
        frame(spark, FULL, ("1", "t", "d", "c", "1", "b", rating, "1"))).first()
    assert row["avg_rating"] == expected


def test_the_complete_row_survives(spark):
    df = frame(spark, FULL, ("1", None, "d", "c", "1", "b", "4", "1"),
               ("1", "t", "d", "c", "2", "b", "4", "1"), ("2", "t", None, "c", "2", "b", "4", "1"),
               (None, "t", "d", "c", "2", "b", "4", "1"))
    rows = products.clean_products(df).collect()
    assert [(r["product_id"], r["price"]) for r in rows] == [("1", 2.0)]


def test_fallbacks(spark):
    row = products.map_products(frame(spark, "Title,x", ("A", "B"))).first()
    assert row["product_id"] == row["title"] == row["description"] == "A"
    row = products.map_products(frame(spark, "x,id", ("A", "B"))).first()
    assert (row["product_id"], row["title"], row["description"]) == ("B", "A", "A")


def test_missing_optional_columns(spark):
    df = frame(spark, "Sku,id", ("2.5", "a"), (None, "b"))
    optional = ["category", "price", "brand", "avg_rating", "review_count"]
    rows = products.map_products(df).select(optional).collect()
    assert [tuple(r) for r in rows] == [(None,) * 5] * 2
    rows = products.map_products(df, missing="first_column").select(optional).collect()
    assert [tuple(r) for r in rows] == [
        ("false", 2.5, "2.5", 2.5, 2), ("true", None, None, None, None)]
    with pytest.raises(ValueError):
        products.map_products(df, missing="zero")


def test_normalised_key(spark):
    df = frame(spark, FULL, (" A ", "t", "d", "c", "1", "b", "4", "1"),
               ("a", "t", "d", "c", "1", "b", "4", "1"))
    assert products.clean_products(df).count() == 2
    assert [r["product_id"] for r in products.clean_products(df, normalise_key=True).collect()] == ["a"]


def test_headers_with_dots_and_backticks(spark):
    df = spark.createDataFrame([("1", "t")], "`id` string, `a.title``x` string")
    assert products.map_products(df).first()["title"] == "t"


def test_null_filters_reach_the_scan(spark, folder):
    frame(spark, FULL, ("1", "t", "d", "c", "1", "b", "4", "1")).write.parquet(folder + "/p")
    plan = products.clean_products(spark.read.parquet(folder + "/p"))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "IsNotNull(product_id)" in text and text.count("Exchange") == 1
    assert text.count("WindowGroupLimit") == 2
