import os

import pytest

from reviewloom.operators import gates, stats


def test_value_counts_orders(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "v string")
    assert [tuple(r) for r in stats.value_counts(df, "v").collect()] == [
        (None, 1), ("a", 1), ("b", 2), ("c", 1)]
    assert [tuple(r) for r in stats.value_counts(df, "v", by="count").collect()] == [
        ("b", 2), (None, 1), ("a", 1), ("c", 1)]
    with pytest.raises(ValueError):
        stats.value_counts(df, "v", by="name")


def test_a_count_of_null_is_a_row(spark):
    df = spark.createDataFrame([(None,), (4.5,), (None,)], "avg_rating float")
    assert [tuple(r) for r in stats.value_counts(df, "avg_rating").collect()] == [(None, 2), (4.5, 1)]


def test_preview(spark):
    df = spark.createDataFrame([(3, "x" * 90), (1, "short"), (2, None)], "i int, t string")
    rows = stats.preview(df, 2, 80, ["i"]).collect()
    assert [tuple(r) for r in rows] == [(1, "short"), (2, None)]
    assert stats.preview(df, 3, 80, ["i"]).collect()[2]["t"] == "x" * 77 + "..."
    assert stats.preview(df, 2, 80).count() == 2


def test_schema_rows(spark):
    df = spark.createDataFrame([(1, ["a"])], "i int not null, t array<string>")
    assert [tuple(r) for r in stats.schema_rows(df).orderBy("position").collect()] == [
        (0, "i", "int", False), (1, "t", "array<string>", True)]


def test_balance_reads_no_columns_for_the_raw_count(spark, folder):
    spark.range(10).selectExpr("id", "id AS b").write.parquet(folder + "/t")
    df = spark.read.parquet(folder + "/t")
    balance = stats.row_balance(df, df.filter("id < 4"))
    assert balance.first().asDict() == {"raw_rows": 10, "clean_rows": 4, "dropped_rows": 6}
    plan = balance._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan and "CartesianProduct" not in plan
    assert "NestedLoop" not in plan


def test_require_input(spark, folder):
    path = os.path.join(folder, "a.csv")
    with open(path, "w") as out:
        out.write("x" * 123)
    assert gates.require_input(spark, path) == 123
    assert gates.require_input(spark, folder) == 123
    assert gates.require_input(spark, folder + "/*.csv") == 123
    with pytest.raises(gates.GateError, match="missing input"):
        gates.require_input(spark, folder + "/b.csv")
    os.mkdir(folder + "/empty")
    with pytest.raises(gates.GateError, match="missing input"):
        gates.require_input(spark, folder + "/empty")


def test_require_rows(spark):
    assert gates.require_rows(spark.range(3), "t") == 3
    with pytest.raises(gates.GateError, match="no rows in t"):
        gates.require_rows(spark.range(0), "t")


def test_same_ids(spark):
    left, right = spark.range(5), spark.range(1, 6)
    got = {r["id"]: (r["in_left"], r["in_right"])
           for r in gates.unmatched_ids(left, right, "id").collect()}
    assert got == {0: (True, False), 5: (False, True)}
    gates.require_same_ids(left, spark.range(5), "id")
    with pytest.raises(gates.GateError, match="2 values of id"):
        gates.require_same_ids(left, right, "id")


def test_gate_report(spark):
    report = gates.gate_report({"a": spark.range(2), "b": spark.range(0)})
    assert sorted(tuple(r) for r in report.collect()) == [("a", 2, True), ("b", 0, False)]
