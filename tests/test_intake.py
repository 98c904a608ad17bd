"""One reading of the raw files: rejects with reasons, counts of what was committed."""

import json

import pytest

from reviewloom.operators import gates, reviews, stats
from reviewloom.plans import intake
from reviewloom.sources import tables

HEADER = ["Pageurl", "Title", "Review Text", "Review Color", "User Verified", "Review Date", "Review Useful Count",
          "Configuration Text", "Rating", "Declaration Text"]


def line(text="good", product="Echo", rating="5", more=""):
    return f'u,"a, title","{text}",red,Verified Purchase,1/2/2017,3,{product},{rating},d{more}\n'


@pytest.fixture
def raw(folder):
    for name, lines in (("a.csv", [line(), line(), line(text=""), line(rating="9"), "u,short\n"]),
                        ("b.csv", [line(text="two\nlines"), line(product=""), line(rating=""), line(more=",x")])):
        with open(f"{folder}/{name}", "w") as out:
            out.write(",".join(HEADER) + "\n" + "".join(lines))
    return folder


def test_every_raw_row_has_an_outcome(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    rows = intake.read_csv_with_rejects(spark, f"{raw}/*.csv")
    balance = intake.build_reviews(rows, f"{out}/staged", f"{out}/clean").first()
    assert tuple(balance) == (9, 2, 7)
    staged, clean = tables.read_table(spark, f"{out}/staged"), tables.read_table(spark, f"{out}/clean")
    assert {tuple(r) for r in intake.outcomes(staged).collect()} == {
        ("kept", 3), ("malformed", 2), ("no text", 1), ("no product", 1), ("no rating", 1), ("rating out of range", 1)}
    found = {(r.outcome, r.file): r.record for r in intake.rejects(staged).collect()}
    assert found["malformed", "a.csv"] == "u,short" and found["malformed", "b.csv"].endswith(",d,x")
    assert json.loads(found["rating out of range", "a.csv"])["Rating"] == "9"
    whole = reviews.clean_reviews(rows.where("_corrupt_record IS NULL").drop("_corrupt_record", "file"))
    assert sorted(r.review_id for r in clean.collect()) == sorted(r.review_id for r in whole.collect())
    assert tuple(stats.row_balance(rows.cache(), clean).first()) == tuple(balance)


def test_counts_read_no_column(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    rows = intake.read_csv_with_rejects(spark, f"{raw}/*.csv")
    balance = intake.build_reviews(rows, f"{out}/staged", f"{out}/clean")
    plan = balance._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<>") == 2 and "csv" not in plan.lower()


def test_no_rows(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    none = intake.read_csv_with_rejects(spark, f"{raw}/*.csv").limit(0)
    assert tuple(intake.build_reviews(none, f"{out}/staged", f"{out}/clean").first()) == (0, 0, 0)


def test_files_are_put_together_by_name(spark, raw, tmp_path_factory):
    with open(f"{raw}/c.csv", "w") as out:  # other order, a column less, one more
        out.write("Rating,Configuration Text,Review Text,Store\n4,Dot,fine,x\n5,Dot\n")
    open(f"{raw}/d.csv", "w").close()
    assert {len(k): len(v) for k, v in intake.header_groups(spark, f"{raw}/*.csv").items()} == {10: 2, 4: 1}
    rows = intake.read_csv_with_rejects(spark, f"{raw}/*.csv")
    out = str(tmp_path_factory.mktemp("out"))
    assert tuple(intake.build_reviews(rows, f"{out}/staged", f"{out}/clean").first()) == (11, 3, 8)
    one = tables.read_table(spark, f"{out}/clean").where("product_id = 'dot'").first()
    assert (one.rating, one.review_text, one.review_title) == (4, "fine", None)
    lost = intake.rejects(tables.read_table(spark, f"{out}/staged")).where("file = 'c.csv'").first()
    assert (lost.outcome, lost.record) == ("malformed", "5,Dot")


def test_no_file_has_a_header(spark, folder):
    open(f"{folder}/a.csv", "w").close()
    with pytest.raises(gates.GateError):
        intake.read_csv_with_rejects(spark, f"{folder}/*.csv")
