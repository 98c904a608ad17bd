import pytest

from reviewloom.__main__ import main
from reviewloom.operators import embed, gates
from reviewloom.plans import stages
from reviewloom.sources import tables
from test_tables import HEADER, write


@pytest.fixture
def paths(tmp_path):
    write(tmp_path / "reviews.csv",
          'u,Good,"great\nsound",Black,Verified Purchase,10/3/2017,3,Echo,5,\n',
          "u,Bad,broken,Black,,10/3/2017,1,Echo,1,\n",
          "u,Bad,broken,White,,10/3/2017,1,echo ,1,\n",
          "u,Bad,broken,White,,10/3/2017,1,echo ,9,\n")
    write(tmp_path / "products.csv", "1,Echo,speaker,9.99\n", "1,Echo,,9.99\n",
          header="id,title,about,price\n")
    return stages.Paths(
        str(tmp_path / "reviews.csv"), str(tmp_path / "products.csv"),
        str(tmp_path / "out/reviews_clean"), str(tmp_path / "out/products_clean"),
        str(tmp_path / "out/vectors"))


def test_run(spark, paths):
    report = stages.run(spark, paths, count_raw=True)
    assert report.rows == {"reviews": 2, "products": 1, "vectors": 2}
    assert report.raw_rows == {"reviews": 4, "products": 2}
    assert report.dropped("reviews") == 2 and report.dropped("products") == 1
    assert report.input_bytes["reviews"] > len(HEADER)
    vectors = tables.read_table(spark, paths.vectors)
    assert vectors.columns == [
        "review_id", "embedding", "document", "product_id", "rating", "review_title", "shard"]


def test_large_multi_line_files_are_named(spark, paths, monkeypatch):
    monkeypatch.setattr(stages, "LARGE_FILE", 10)
    with pytest.warns(UserWarning, match="multi-line"):
        stages.run(spark, paths)


def test_the_search_that_closes_the_vector_stage(spark, paths):
    stages.run(spark, paths)
    asked = spark.createDataFrame([(1, "great sound"), (2, " ")], "question_id bigint, question string")
    rows = stages.check_search(
        spark, paths, asked, lambda q: embed.hashed_embeddings(q, "question")).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2] and "sound" in rows[0]["document"]


def test_inputs_as_rows(spark, paths):
    report = gates.input_report(spark, {"reviews": paths.raw_reviews, "none": "/nowhere/x.csv"})
    assert sorted(map(tuple, report.collect())) == [("none", False, False), ("reviews", True, True)]


def test_a_second_run_gives_the_same_tables(spark, paths):
    def content():
        stages.run(spark, paths)
        return [sorted(map(tuple, tables.read_table(spark, p).drop("ingestion_ts").collect()))
                for p in (paths.clean_reviews, paths.clean_products, paths.vectors)]

    assert content() == content()


def test_either_input_missing_stops_the_run(spark, paths):
    for field in ("raw_reviews", "raw_products"):
        broken = stages.Paths(**{**paths.__dict__, field: "/nowhere/x.csv"})
        with pytest.raises(gates.GateError, match="nowhere"):
            stages.run(spark, broken)


def test_an_empty_output_stops_the_run(spark, paths):
    write(paths.raw_reviews, "u,Bad,broken,White,,10/3/2017,1,echo ,9,\n")
    with pytest.raises(gates.GateError, match="no rows"):
        stages.run(spark, paths)


def test_vectors_of_other_reviews_are_noticed(spark, paths):
    stages.run(spark, paths)
    vectors = tables.read_table(spark, paths.vectors).drop("shard").limit(1).collect()
    tables.write_table(
        spark.createDataFrame(vectors, "review_id string, embedding array<float>, document string,"
                              " product_id string, rating int, review_title string"), paths.vectors)
    with pytest.raises(gates.GateError, match="1 values of review_id"):
        stages.check_outputs(spark, paths)


def test_commands(spark, paths, tmp_path, capfd):
    out = str(tmp_path / "cli")
    main(["reviews", paths.raw_reviews, out + "/r"])
    main(["products", paths.raw_products, out + "/p", "--missing", "first_column"])
    main(["vectors", out + "/r", out + "/v"])
    main(["search", out + "/v", "is the sound great", " ", "-k", "1"])
    main(["run", paths.raw_reviews, paths.raw_products, out + "/all"])
    printed = capfd.readouterr().out
    assert "2 vectors" in printed and "reviews: 2 rows" in printed
    assert "is the sound great" in printed and "detected columns" in printed
    assert tables.read_table(spark, out + "/p").first()["category"] == "false"
