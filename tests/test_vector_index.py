"""Pruned and indexed search against the full search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.operators import pruned, search, vector_index
from reviewloom.sources import tables


def grouped(spark, n=600, width=12, groups=8, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, width)) * 4
    rows = centres[rng.integers(groups, size=n)] + rng.normal(size=(n, width)) * 0.4
    rows[::97] = 0.0  # no direction
    rows[5::50] = rows[7 % n]  # ties
    return spark.createDataFrame([(i, x.astype(np.float32).tolist()) for i, x in enumerate(rows)],
                                 "vec_id long, embedding array<float>")


def asked_of(vectors, step=3):
    return vectors.where(F.col("vec_id") % step == 0).select(F.col("vec_id").alias("question_id"), "embedding")


def rows_of(hits):
    return sorted((r.question_id, r.rank, r.vec_id, None if r.similarity is None else round(r.similarity, 9))
                  for r in hits.collect())


def searched(spark, vectors, questions, folder, k=4, pivots=None):
    pivots = pivots or pruned.choose_pivots(vectors, "vec_id")
    tables.write_table(pruned.with_blocks(vectors, pivots), f"{folder}/blocked", partition_by=["cell"])
    blocked = tables.read_table(spark, f"{folder}/blocked")
    return pruned.pruned_topk(blocked, questions, pivots, f"{folder}/search", k, "vec_id")


def test_pruned_hits_are_those_of_the_full_search(spark, folder):
    vectors = grouped(spark)
    questions = asked_of(vectors)
    got = searched(spark, vectors, questions, folder)
    assert rows_of(got) == rows_of(search.cosine_topk(vectors, questions, 4, "vec_id"))
    known = got.join(questions.where("exists(embedding, x -> x <> 0)"), "question_id", "left_semi").where("rank = 1")
    read, there = known.agg(F.sum("blocks_read"), F.sum("blocks")).first()
    assert read < 0.5 * there
    zero = got.join(questions.where("forall(embedding, x -> x = 0)"), "question_id", "left_semi")
    assert zero.where("blocks_read <> blocks").isEmpty() and not zero.isEmpty()


def test_bounds_hold_for_random_vectors(spark, folder):
    rng = np.random.default_rng(4)
    rows = [(i, x.tolist()) for i, x in enumerate(rng.normal(size=(300, 6)))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    questions = asked_of(vectors, 7)
    pivots = pruned.choose_pivots(vectors, "vec_id", pivots=3)
    got = searched(spark, vectors, questions, folder, 11, pivots)
    assert rows_of(got) == rows_of(search.cosine_topk(vectors, questions, 11, "vec_id"))


def test_pruned_search_of_few_or_no_vectors(spark, folder):
    few = grouped(spark, 3)
    questions = asked_of(grouped(spark, 30))
    got = searched(spark, few, questions, f"{folder}/few", 5)
    assert rows_of(got) == rows_of(search.cosine_topk(few, questions, 5, "vec_id"))
    pivots = pruned.choose_pivots(few, "vec_id")
    none = pruned.with_blocks(few, pivots).limit(0)
    assert pruned.pruned_topk(none, questions, pivots, f"{folder}/none", 5, "vec_id").count() == 0


def test_files_of_other_blocks_are_left_alone(spark, folder):
    vectors = grouped(spark)
    pivots = pruned.choose_pivots(vectors, "vec_id")
    tables.write_table(pruned.with_blocks(vectors, pivots), folder, partition_by=["cell"])
    plan = tables.read_table(spark, folder).where("cell = 3")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan


def indexed(spark, vectors, questions, folder, candidates=40, k=5, probes=None):
    index = vector_index.fit(vectors, "vec_id")
    rows, schema = vector_index.index_rows(index)
    back = vector_index.read_index(spark.createDataFrame(rows, schema))
    assert (back.centroids == index.centroids).all() and (back.words == index.words).all()
    tables.write_table(vector_index.with_codes(vectors, back).drop("embedding"), folder, partition_by=["cell"])
    codes = tables.read_table(spark, folder)
    probes = probes or len(index.centroids)
    found = vector_index.candidates_of(codes, questions, back, probes, candidates, "vec_id")
    return found, vector_index.indexed_topk(vectors, codes, questions, back, probes, k, candidates, "vec_id")


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_nine_of_ten_hits_for_under_a_fifth_of_the_vectors(spark, folder, sf):
    vectors = tables.read_table(spark, f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding")
    questions = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("question_id"), "embedding")
    found, hits = indexed(spark, vectors, questions, folder)
    exact = search.cosine_topk(vectors, questions, 5, "vec_id")
    report = vector_index.recall_report(hits, exact, found, vectors, "vec_id").first()
    assert report.recall >= 0.9 and report.read_share < 0.2 and report.questions == questions.count()
    # each similarity is exact: pairs in both have the same one
    pairs = hits.join(exact.select("question_id", "vec_id", F.col("similarity").alias("exact")), ["question_id", "vec_id"])
    assert pairs.where("abs(similarity - exact) > 1e-9").isEmpty()


def test_few_lists_do_for_grouped_vectors(spark, folder):
    vectors = grouped(spark)
    questions = asked_of(vectors).where("exists(embedding, x -> x <> 0)")
    found, hits = indexed(spark, vectors, questions, folder, probes=6)
    exact = search.cosine_topk(vectors, questions, 5, "vec_id")
    assert vector_index.recall_report(hits, exact, found, vectors, "vec_id").first().recall >= 0.9
    zero = vectors.where("forall(embedding, x -> x = 0)").select("vec_id")
    assert found.join(zero, "vec_id", "left_semi").isEmpty()


def test_codes_are_near_their_vectors():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(2000, 10)).astype(np.float32)
    units = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    centroids = vector_index.cluster(units, 20)
    blank = vector_index.Index(centroids, np.zeros((3, 1, 4), np.float32))
    parts = blank.parts(units - centroids[vector_index.nearest(units, centroids)])
    words = np.stack([vector_index.cluster(parts[:, m], 64)[:50] for m in range(3)])
    index = vector_index.Index(centroids, words)
    lists, codes = index.encode(units)
    for number in range(3):  # a table tells the distance to what the code stands for
        own = np.flatnonzero(lists == number)
        table = index.tables(units[:5], number)
        told = sum(table[:, m, :][:, codes[own, m]] for m in range(3))
        stands = centroids[number] + np.concatenate([words[m][codes[own, m]] for m in range(3)], axis=1)[:, :10]
        assert np.allclose(told, ((units[:5, None] - stands[None]) ** 2).sum(axis=2), atol=1e-2)


def test_an_index_of_nothing(spark, folder):
    none = grouped(spark, 3).limit(0)
    index = vector_index.fit(none, "vec_id")
    codes = vector_index.with_codes(none, index)
    asked = grouped(spark, 3).select(F.col("vec_id").alias("question_id"), F.slice("embedding", 1, 1).alias("embedding"))
    assert vector_index.indexed_topk(none, codes, asked, index, 1, id_col="vec_id").count() == 0


def test_a_question_of_many_probes_is_sent_once(spark, folder, monkeypatch):
    """By list, a question and its best candidates would be there as often as there are lists."""
    vectors = grouped(spark, 900)
    questions = asked_of(vectors, 9)
    sent = []

    def meet(v, probing, *others):
        sent.append(probing.count())
        return search.meet(v, probing, *others)

    monkeypatch.setattr(vector_index, "meet", meet)
    found, _ = indexed(spark, vectors, questions, folder)
    assert sent[0] == questions.count() and found.count() == 40 * questions.count()


@pytest.mark.parametrize("probes", [4, 17, 25])
def test_candidates_are_the_best_by_their_codes(spark, folder, probes, monkeypatch):
    monkeypatch.setattr(vector_index, "_ROWS", 100)
    monkeypatch.setattr(vector_index, "_ASKED", 7)
    vectors = grouped(spark)
    questions = asked_of(vectors, 11).where("exists(embedding, x -> x <> 0)")
    index = vector_index.fit(vectors, "vec_id")
    probes = min(probes, len(index.centroids))
    codes = vector_index.with_codes(vectors, index)
    rows = codes.where("cell >= 0").orderBy("vec_id").collect()
    lists = np.array([r.cell for r in rows])
    held = np.array([list(r.code) for r in rows], np.uint8)
    stands = index.decode(lists, held).astype(np.float64)
    got = {}
    for r in vector_index.candidates_of(codes, questions, index, probes, 30, "vec_id").collect():
        got.setdefault(r.question_id, []).append(r)
    for q in questions.collect():
        unit = np.array(q.embedding) / np.linalg.norm(q.embedding)
        own = np.isin(lists, index.probed(unit[None].astype(np.float32), probes)[0])
        away = np.where(own, ((unit - stands) ** 2).sum(axis=1), np.inf)
        best = np.sort(away[own])[:30]
        mine = sorted(got[q.question_id], key=lambda r: r["rank"])
        assert len(mine) == len(best)
        assert np.allclose([r.similarity for r in mine], 1 - best / 2, atol=1e-4)
        place = {r.vec_id: i for i, r in enumerate(rows)}
        assert np.allclose([away[place[r.vec_id]] for r in mine], best, atol=2e-4)


@pytest.mark.parametrize("sizes", [(32 << 20, 64 << 20), (9_000, 4_000)])
def test_found_pairs_are_ranked_by_blocks(spark, monkeypatch, sizes):
    """A pair carries no vector: a question goes once to a block of vectors that holds candidates of it."""
    vectors = grouped(spark)
    questions = asked_of(vectors, 7)
    sent = []

    def meet(v, probing, *others):
        sent.append((v.select("cell").distinct().count(), probing.count(), probing.select(F.sum(F.size("ids"))).first()[0]))
        return search.meet(v, probing, *others)

    monkeypatch.setattr(vector_index, "meet", meet)
    found = questions.select("question_id").crossJoin(vectors.select("vec_id")).where("(vec_id + question_id) % 3 < 2")
    hits = vector_index.rerank(vectors, questions, found, 6, "vec_id", sizes)
    every = search.cosine_topk(vectors, questions, vectors.count(), "vec_id")
    best = search.rank_hits(every.join(found, ["question_id", "vec_id"]), 6, "vec_id")
    assert rows_of(hits) == rows_of(best)
    blocks, rows, pairs = sent[0]
    assert rows <= blocks * questions.count() and pairs == found.count()
    assert blocks == 1 if sizes[0] > 9_000 else blocks > 3


def test_a_question_is_sent_once_to_a_group_of_blocks(spark, folder, monkeypatch):
    """It was sent to each block that the bounds leave over, and each returned its best k."""
    met, vectors = [], grouped(spark)

    def counted(v, probing, *rest):
        hits = search.meet(v, probing, *rest)
        met.append((probing.count(), hits.count()))
        return hits

    monkeypatch.setattr(pruned, "meet", counted)
    questions = asked_of(vectors).where("exists(embedding, x -> x <> 0)")
    got = searched(spark, vectors, questions, folder)
    assert rows_of(got) == rows_of(search.cosine_topk(vectors, questions, 4, "vec_id"))
    n = questions.count()
    (first, _), (second, hits) = met
    assert first == n and second <= n and hits < 4 * n


def test_groups_of_blocks_hold_so_many_bytes():
    bounds = pruned.Bounds(np.arange(-1, 5), np.array([3, 4, 2, 9, 1, 1]), np.zeros((6, 1)), np.zeros((6, 1)))
    assert bounds.groups(10, 70).tolist() == [0, 0, 1, 2, 3, 3]


def test_pruned_search_in_rounds(spark, folder, monkeypatch):
    """Each step met all questions at once, so its shuffle grew with questions times groups of blocks."""
    met, vectors = [], grouped(spark)

    def counted(v, probing, *rest):
        met.append(probing.select("question_id").distinct().count())
        return search.meet(v, probing, *rest)

    questions = asked_of(vectors).where("exists(embedding, x -> x <> 0)")
    n = questions.count()
    held = questions.agg(F.sum(search.list_bytes("embedding"))).first()[0]
    whole = rows_of(searched(spark, vectors, questions, folder + "/one"))
    monkeypatch.setattr(search, "QUESTION_BLOCK_BYTES", -(-held // 9) * 16 // 15 + 1)
    monkeypatch.setattr(pruned, "meet", counted)
    assert rows_of(searched(spark, vectors, questions, folder + "/three")) == whole
    assert len(met) == 6 and sum(met[::2]) == n and max(met) < n
