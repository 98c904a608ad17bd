import os
import time

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import reviews
from reviewloom.sources import tables

HEADER = ("Pageurl,Title,Review Text,Review Color,User Verified,Review Date,"
          "Review Useful Count,Configuration Text,Rating,Declaration Text\n")


def write(path, *lines, header=HEADER):
    with open(path, "w", encoding="utf-8") as out:
        out.write(header + "".join(lines))
    return str(path)


def test_cells_survive_as_text(spark, tmp_path):
    path = write(
        tmp_path / "r.csv",
        'u,Good,"said ""wow""\nand, more",Black,Verified Purchase,2017-10-03,3.0,Echo,4.5,\n',
        'u,007,"",Black,,10/3/17,none,Echo,5,\n',
        "u,TRUE,,Black,,10/3/17,none,Echo,5,\n",
        "u,t,   ,Black,,10/3/17,none,Echo,5,\n",
    )
    df = tables.read_csv(spark, path)
    assert {t for _, t in df.dtypes} == {"string"}
    rows = df.collect()
    assert [r["Title"] for r in rows] == ["Good", "007", "TRUE", "t"]
    assert [r["Review Text"] for r in rows] == ['said "wow"\nand, more', None, None, "   "]
    clean = {r["review_text"]: r for r in reviews.clean_reviews(df).collect()}
    assert set(clean) == {'said "wow"\nand, more', ""}
    row = clean['said "wow"\nand, more']
    assert row["rating"] == 4 and row["helpful_votes"] == 3
    assert str(row["review_date"]) == "2017-10-03"


def test_many_files_and_globs(spark, tmp_path):
    line = "u,t,text {},Black,,10/3/2017,1,Echo,5,\n"
    for i in range(3):
        write(tmp_path / f"part{i}.csv", line.format(i))
    assert tables.read_csv(spark, str(tmp_path)).count() == 3
    assert tables.read_csv(spark, str(tmp_path / "part[01].csv")).count() == 2
    assert tables.read_csv(spark, [str(tmp_path / "part0.csv")]).count() == 1
    assert tables.read_csv(spark, str(tmp_path), multi_line=False).count() == 3


def test_a_file_with_other_headers_is_an_error(spark, tmp_path):
    write(tmp_path / "a.csv", "1,x\n", header="id,title\n")
    write(tmp_path / "b.csv", "x,1\n", header="title,id\n")
    with pytest.raises(Exception, match="header"):
        tables.read_csv(spark, str(tmp_path)).collect()


def test_a_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_csv(spark, str(tmp_path / "none.csv"))


def test_write_replaces_and_controls_files(spark, folder):
    path = folder + "/t"

    def files(at=path):
        return [f for f in os.listdir(at) if f.endswith(".snappy.parquet")]

    tables.write_table(spark.range(100).repartition(4), path)
    assert len(files()) == 4
    tables.write_table(spark.range(60), path, files=1)
    assert len(files()) == 1 and tables.read_table(spark, path).count() == 60
    tables.write_table(spark.range(60).coalesce(1), path, max_rows_per_file=20)
    assert len(files()) == 3
    tables.write_table(spark.range(6).selectExpr("id", "id % 2 AS p"), path, partition_by=["p"])
    assert sorted(d for d in os.listdir(path) if d.startswith("p=")) == ["p=0", "p=1"]


def test_read_if_there(spark, folder):
    assert tables.read_if_there(spark, folder + "/none") is None
    os.mkdir(folder + "/empty")
    assert tables.read_if_there(spark, folder + "/empty") is None
    tables.write_table(spark.range(2), folder + "/t")
    assert tables.read_if_there(spark, folder + "/t").count() == 2


def test_folders_get_few_files(spark, folder):
    rows = spark.range(4000).selectExpr("id", "cast(id % 16 AS int) AS cell").repartition(8)
    tables.write_table(rows, folder + "/t", partition_by=["cell"])
    files = [f for _, _, names in os.walk(folder + "/t") for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * 16 and tables.read_table(spark, folder + "/t").count() == 4000


def overlapping(folder, column, low, high):
    """(files whose footers leave room for a value from low to high, all files)."""
    import glob

    import pyarrow.parquet as pq

    found = total = 0
    for path in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        found += any(s is not None and s.has_min_max and s.min <= high and low <= s.max for s in stats)
        total += 1
    return found, total


def test_clustered_files_are_left_out_by_any_column(spark, folder):
    rows = spark.range(20_000).selectExpr(
        "concat('p', lpad(pmod(hash(id), 97), 2, '0')) AS product_id", "pmod(hash(id, 1), 50) AS rating",
        "date_add(date'2020-01-01', pmod(hash(id, 2), 700)) AS review_date", "IF(id % 50 = 0, NULL, id) AS n")
    columns = ["product_id", "rating", "review_date"]
    tables.write_clustered(rows, f"{folder}/clustered", columns, 64)
    tables.write_table(rows, f"{folder}/plain", files=64)
    back = tables.read_table(spark, f"{folder}/clustered")
    assert back.exceptAll(rows).isEmpty() and back.count() == 20_000
    for column, value in (("product_id", "p42"), ("rating", 7)):
        found, total = overlapping(f"{folder}/clustered", column, value, value)
        assert 1 <= found <= total / 2 and total >= 32
        assert overlapping(f"{folder}/plain", column, value, value)[0] > 60
    plan = back.where("rating = 7")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(rating,7)" in plan


def test_clustering_takes_nulls_ties_and_no_rows(spark, folder):
    rows = spark.range(300).selectExpr("IF(id % 3 = 0, NULL, 'same') AS a", "CAST(NULL AS int) AS b")
    tables.write_clustered(rows, f"{folder}/a", ["a", "b"], 4)
    assert tables.read_table(spark, f"{folder}/a").exceptAll(rows).isEmpty()
    tables.write_clustered(rows.limit(0), f"{folder}/b", ["a", "b"], 4)
    assert spark.read.schema(rows.schema).parquet(f"{folder}/b").count() == 0


def test_interleaved_bits(spark):
    from pyspark.sql import functions as F

    row = spark.sql("SELECT 5 AS a, 3 AS b").select(tables.interleaved([F.col("a"), F.col("b")], 3)).first()
    assert row[0] == 0b011011


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {os.path.join(root, f) for d in dirs for root, _, files in os.walk(str(d)) for f in files if f.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark, folder):
    """They stayed until the driver collected garbage, so those of several steps lay on disk at once."""
    df = spark.range(5000).selectExpr("id % 7 AS a", "id").repartition(5).groupBy("a").count()
    before = shuffle_files(spark)
    df.write.parquet(folder + "/plain")
    assert shuffle_files(spark) - before
    before = shuffle_files(spark)
    tables.write_table(df, folder + "/t", partition_by=["a"])
    tables.write_table(df, folder + "/t", partition_by=["a"], append=True)
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:  # Spark removes them in the background
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert sorted(map(tuple, spark.read.parquet(folder + "/t").groupBy("a", "count").agg(F.count("*")).collect())) == sorted(
        (r["a"], r["count"], 2) for r in df.collect())
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(key) == "false"
    spark.conf.set(key, "false")
    try:
        with tables.shuffles_removed(spark):
            assert spark.conf.get(key) == "true"
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.unset(key)
