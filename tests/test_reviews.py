import datetime

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import dedupe, reviews, stats

HEADERS = ["Pageurl", "Title", "Review Text", "Review Color", "User Verified", "Review Date",
           "Review Useful Count", "Configuration Text", "Rating", "Declaration Text"]


def raw(spark, *rows):
    """Raw reviews; each row names the cells that differ from an ordinary review."""
    ordinary = dict(zip(HEADERS, [
        "/p/1", " Good ", " works ", " Black ", "Verified Purchase", "10/3/2017", "3 people",
        " Echo A ", "5", "x"]))
    data = [tuple({**ordinary, **row}[h] for h in HEADERS) for row in rows]
    return spark.createDataFrame(data, ", ".join(f"`{h}` string" for h in HEADERS))


def clean_one(spark, **cells):
    rows = reviews.clean_reviews(
        raw(spark, {k.replace("_", " "): v for k, v in cells.items()})).collect()
    assert len(rows) <= 1
    return rows[0] if rows else None


def test_an_ordinary_review(spark):
    df = reviews.clean_reviews(raw(spark, {}))
    assert df.columns == reviews.CLEAN_COLUMNS
    assert dict(df.dtypes) == {
        "review_id": "string", "product_id": "string", "review_title": "string",
        "review_text": "string", "rating": "int", "is_verified": "boolean",
        "product_variant": "string", "helpful_votes": "int", "review_date": "date",
        "ingestion_ts": "timestamp"}
    row = df.first()
    assert row["product_id"] == "echo a" and row["review_title"] == "Good"
    assert row["review_text"] == "works" and row["rating"] == 5 and row["is_verified"] is True
    assert row["product_variant"] == "black" and row["helpful_votes"] == 3
    assert row["review_date"] == datetime.date(2017, 10, 3)
    assert row["ingestion_ts"] is not None and len(row["review_id"]) == 64


@pytest.mark.parametrize("rating,kept", [
    ("1", 1), ("5", 5), ("4.5", 4), ("0", None), ("6", None), ("4d", None), ("1e1", None),
    (".5", None), ("5.0 out of 5 stars", None), ("NaN", None), (None, None)])
def test_rating(spark, rating, kept):
    row = clean_one(spark, Rating=rating)
    assert (row and row["rating"]) == kept


def test_null_text_and_product_are_dropped_and_blank_text_is_kept(spark):
    assert clean_one(spark, Review_Text=None) is None
    assert clean_one(spark, Configuration_Text=None) is None
    assert clean_one(spark, Review_Text="   ")["review_text"] == ""
    assert clean_one(spark, Review_Text="\tx ")["review_text"] == "\tx"


def test_null_cells_that_are_allowed(spark):
    row = clean_one(spark, Title=None, Review_Color=None, User_Verified=None,
                    Review_Useful_Count=None, Review_Date="13/3/2017")
    assert row["review_title"] is None and row["product_variant"] is None
    assert row["is_verified"] is False and row["helpful_votes"] is None
    assert row["review_date"] is None


def test_duplicates_are_text_and_product(spark):
    df = raw(spark,
             {"Review Text": "same", "Configuration Text": "Echo A", "Title": "b"},
             {"Review Text": " same ", "Configuration Text": " ECHO a", "Title": "a"},
             {"Review Text": "same", "Configuration Text": "Echo B"},
             {"Review Text": "Same", "Configuration Text": "Echo A"})
    rows = reviews.clean_reviews(df).collect()
    assert len(rows) == 3
    assert {r["review_title"] for r in rows if r["review_text"] == "same"
            and r["product_id"] == "echo a"} == {"a"}


def test_the_same_rows_and_ids_under_any_partitioning(spark):
    df = raw(spark, *[
        {"Review Text": f"t{i % 7}", "Configuration Text": f"P{i % 3}", "Title": f"x{i}",
         "Rating": str(1 + i % 5)} for i in range(60)])
    results = [
        {tuple(r) for r in reviews.clean_reviews(d).drop("ingestion_ts").collect()}
        for d in (df, df.repartition(7), df.orderBy(F.desc("Title")).coalesce(1))]
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == len({r[0] for r in results[0]}) == 21


def test_given_ids_and_tie_break(spark):
    df = raw(spark, {"Title": "a"}, {"Title": "b"}).withColumn(
        "key", F.when(F.col("Title") == "a", F.lit(9)).otherwise(F.lit(8)))
    row = reviews.clean_reviews(df, id_col="key", tie_break=["key"]).first()
    assert row["review_id"] == "8" and row["review_title"] == "b"


def test_unused_headers_may_be_missing_and_others_not(spark):
    df = raw(spark, {})
    assert reviews.clean_reviews(df.drop("Pageurl", "Declaration Text")).count() == 1
    with pytest.raises(ValueError, match="rating_raw"):
        reviews.clean_reviews(df.drop("Rating"))


def test_rename_passes_over_missing_headers(spark):
    assert reviews.rename_reviews(raw(spark, {}).select("Title", "Rating")).columns == [
        "review_title", "rating_raw"]


def test_balance(spark):
    df = raw(spark, {}, {}, {"Rating": "9"}, {"Review Text": None})
    row = stats.row_balance(df, reviews.clean_reviews(df)).first()
    assert row.asDict() == {"raw_rows": 4, "clean_rows": 1, "dropped_rows": 3}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().replace("`", "")


def test_one_shuffle_that_a_hot_key_enters_reduced(spark, folder):
    raw(spark, {}).write.parquet(folder + "/r")
    text = plan(reviews.clean_reviews(spark.read.parquet(folder + "/r")))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("WindowGroupLimit") == 2
    assert "IsNotNull(Review Text)" in text
    scan = text[text.index("FileScan"):]
    assert "Pageurl" not in scan and "Declaration" not in scan


def test_keep_one_of_a_hot_key(spark):
    df = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "id AS v")
    kept = dedupe.keep_one(df, ["k"], [F.desc("v")])
    assert kept.count() == 6001
    assert kept.filter("k = -1").first()["v"] == 8997
