"""A collection against a dictionary; digests against the join; SQL functions."""

import random

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import dedupe, digests, gates
from reviewloom.operators.collection import Collection
from reviewloom.plans import sql

SCHEMA = "id string, n int, v array<float>"


def told(collection):
    rows = collection.rows()
    return {} if rows is None else {r.id: (r.n, tuple(r.v)) for r in rows.collect()}


def test_changes_give_the_rows_of_a_rebuild(spark, folder):
    rng, want, held = random.Random(6), {}, Collection(spark, folder, "id")
    assert held.rows() is None and held.expired() == []
    for step in range(9):
        ids = rng.sample([f"r{i}" for i in range(12)], 4)
        if step % 3 == 2:
            held.delete(spark.createDataFrame([(i,) for i in [*ids, "never"]], "id string"))
            for i in ids:
                want.pop(i, None)
        else:
            held.add(spark.createDataFrame([(i, step, [float(step)]) for i in ids], SCHEMA))
            want |= {i: (step, (float(step),)) for i in ids}
        if step in (4, 7):
            held.compact()
            assert len(held.commits()) == 1
        assert told(held) == want
    assert held.rows().count() == len(want) and len(held.expired()) >= 5
    assert told(Collection(spark, folder, "id")) == want  # another reader


def test_nothing_counts_before_its_commit(spark, folder, monkeypatch):
    held = Collection(spark, folder, "id")
    held.add(spark.createDataFrame([("a", 1, [1.0])], SCHEMA))
    with pytest.raises(gates.GateError):
        held.add(spark.createDataFrame([("b", 2, [1.0]), (None, 2, [1.0])], SCHEMA))
    monkeypatch.setattr(spark, "createDataFrame", None)  # dies between the rows and the commit
    for change in (held.compact, lambda: held.delete(held.rows().select("id"))):
        with pytest.raises(TypeError):
            change()
        assert told(held) == {"a": (1, (1.0,))} and len(held.commits()) == 1


def test_rows_of_one_id_in_one_addition(spark, folder):
    held = Collection(spark, folder, "id")
    held.add(spark.createDataFrame([("a", 2, [1.0]), ("a", 1, [3.0]), ("a", 1, [2.0])], SCHEMA))
    assert told(held) == {"a": (1, (2.0,))}


def test_compacted_rows_are_not_shuffled_for_few_changes(spark, folder):
    held = Collection(spark, folder, "id")
    held.add(spark.range(2000).selectExpr("concat('k', id) AS id", "1 AS n", "array(1f) AS v"))
    held.compact()
    held.delete(spark.createDataFrame([("k3",)], "id string"))
    rows = held.rows()
    assert rows.count() == 1999
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("bits", [1, 4, 12])
def test_digests_find_what_the_join_finds(spark, bits):
    left = spark.createDataFrame([(i,) for i in [*range(300), 5, 5, None]], "k long")
    right = spark.createDataFrame([(i,) for i in [*range(3, 304), 7]], "k long")
    want = sorted(map(tuple, gates.unmatched_ids(left, right, "k").collect()), key=str)
    assert sorted(map(tuple, digests.unmatched_by_digest(left, right, "k", bits=bits).collect()), key=str) == want
    assert len(want) == 8


def test_doubled_ids_do_not_hide_each_other(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    right = spark.createDataFrame([("b",), ("c",), ("c",)], "k string")
    got = digests.unmatched_by_digest(left, right, "k", bits=1)
    assert sorted(map(tuple, got.collect())) == [("a", True, False), ("c", False, True)]


def test_equal_tables_shuffle_only_digests(spark):
    left, right = spark.range(5000).withColumnRenamed("id", "k"), spark.range(5000).repartition(7).withColumnRenamed("id", "k")
    one, two = digests.digests(left, "k", 8), digests.digests(right, "k", 8)
    assert digests.root(one) == digests.root(two) == digests.root(digests.folded(one))
    assert digests.differing(digests.folded(one), digests.folded(two)).isEmpty()
    assert one.count() <= 256 and digests.differing(one, two).isEmpty()
    got = digests.unmatched_by_digest(left, right, "k", one, two, 8)
    assert got.isEmpty()
    other = digests.digests(spark.range(1, 5001).withColumnRenamed("id", "k"), "k", 8)
    assert 1 <= digests.differing(one, other).count() <= 2  # of 256


def test_sql_functions(spark):
    own = spark.newSession()
    rows = [("r1", "p", 3, "t"), ("r2", "q", 5, None)]
    vectors = own.createDataFrame([("r1", [1.0, 0.0]), ("r2", [0.0, 2.0]), ("r3", [0.0, 0.0])],
                                  "review_id string, embedding array<float>")
    sql.register(own, reviews=own.createDataFrame(rows, "review_id string, product_id string, rating int, review_title string"),
                 vectors=vectors)
    assert [tuple(r) for r in own.sql("SELECT * FROM reviews_of('p')").collect()] == [("r1", 3, "t", "★★★")]
    near = own.sql("SELECT review_id, round(similarity, 4) FROM nearest_reviews(array(1f, 1f))").collect()
    assert [tuple(r) for r in near] == [("r1", 0.7071), ("r2", 0.7071), ("r3", None)]
    assert own.sql("SELECT lenient_int(' 4.5 '), lenient_int('4d'), stars(NULL)").first() == (4, None, None)
    got = own.sql("SELECT token, n FROM VALUES ('Ab-ab É1 x'), (NULL) v(t), LATERAL tokens(t)").collect()
    assert sorted(map(tuple, got)) == [("1", 1), ("ab", 2), ("x", 1)]
    assert not any(f.name == "stars" for f in spark.catalog.listFunctions())


def test_filters_know_all_stored_keys_and_few_others(spark):
    bits = dedupe.filter_bits(3000)
    stored = spark.range(3000).selectExpr("concat('k', id) AS k")
    known = dedupe.key_filter(stored, "k", bits)
    assert dedupe.with_seen(stored, "k", known, bits).where("NOT maybe_seen").isEmpty()
    other = spark.range(3000, 23000).selectExpr("concat('k', id) AS k")
    assert dedupe.with_seen(other, "k", known, bits).where("maybe_seen").count() < 600
    halves = dedupe.key_filter(stored.where("k < 'k2'"), "k", bits).unionAll(
        dedupe.key_filter(stored.where("k >= 'k2'"), "k", bits))
    assert sorted(map(tuple, dedupe.merged_filters(halves).collect())) == sorted(map(tuple, known.collect()))


def test_only_unseen_rows_stay(spark):
    stored = spark.range(500).selectExpr("concat('k', id) AS k")
    rows = spark.range(400, 900).selectExpr("concat('k', id) AS k", "id AS n").unionAll(
        spark.sql("SELECT CAST(NULL AS STRING), 1000L"))
    for bits in (1 << 15, 64):  # a filter that is too small lets more keys through to the join
        left = dedupe.drop_seen(rows, stored, "k", dedupe.key_filter(stored, "k", bits), bits)
        assert sorted(r.n for r in left.collect()) == [*range(500, 900), 1000]
    none = stored.limit(0)
    assert dedupe.drop_seen(rows, none, "k", dedupe.key_filter(none, "k", 1 << 15), 1 << 15).count() == rows.count()
