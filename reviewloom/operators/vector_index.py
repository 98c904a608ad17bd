"""A compressed index of vectors: learnt lists, product-quantised residuals, exact re-ranking.

A vector belongs to the list of its nearest centroid. What is left of it there is cut into parts,
and each part is replaced by the number of its nearest codeword, so a vector is a few bytes. A
question goes through some lists; their vectors are scored as their codes tell them, and only the
best candidates are read in full and ranked by their true similarity.

Centroids and codewords are fitted on a bounded sample; every vector is indexed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.operators.search import (
    QUESTION_BLOCK_BYTES, TOP_K, VECTOR_BLOCK_BYTES, Questions, _column, _first_of_each, _hit_schema, _matrix, _norms,
    _one_cell, _similarity, _units, hit_types, list_bytes, meet, rank_hits,
)

# Vectors that the fit sees, the most lists, codewords of a part, and rounds of clustering.
SAMPLE, MOST_LISTS, WORDS, ROUNDS = 16_384, 1_024, 256, 12
# Elements of a part of a vector, and candidates of a question that are read in full.
PART, CANDIDATES = 4, 50
# Bytes of a question block: a task holds the best candidates of all its questions.
QUESTION_BYTES = 8 << 20
# Probes up to which a question is sent to each of its lists; with more it is sent to all codes once.
FEW_PROBES = 16
# Questions and vectors that a task compares at a time.
_ASKED, _ROWS = 256, 16_384


@dataclass(frozen=True)
class Index:
    """centroids: a row a list; words: (part, codeword, element) of the residuals."""

    centroids: np.ndarray
    words: np.ndarray

    @property
    def width(self) -> int:
        return self.centroids.shape[1]

    def units(self, embeddings: pa.Array) -> np.ndarray:
        matrix = _matrix(embeddings, self.width)
        return _units(matrix, _norms(matrix))

    def parts(self, residuals: np.ndarray) -> np.ndarray:
        """Residuals as (row, part, element), filled up with zeros."""
        n, _, size = self.words.shape
        out = np.zeros((len(residuals), n * size), np.float32)
        out[:, :self.width] = residuals
        return out.reshape(-1, n, size)

    def encode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(list, codes) of each row."""
        lists = nearest(units, self.centroids)
        parts = self.parts(units - self.centroids[lists])
        codes = np.empty(parts.shape[:2], np.uint8)
        for m, words in enumerate(self.words):
            codes[:, m] = nearest(parts[:, m], words)
        return lists, codes

    def decode(self, lists: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What the codes stand for, a row each."""
        parts = self.words[np.arange(len(self.words))[None, :], codes]
        return self.centroids[lists] + parts.reshape(len(codes), -1)[:, :self.width]

    def probed(self, units: np.ndarray, probes: int) -> np.ndarray:
        """The numbers of the nearest lists of each question."""
        away = (self.centroids ** 2).sum(axis=1)[None] - 2 * units @ self.centroids.T
        return np.argsort(away, axis=1, kind="stable")[:, :probes].astype(np.int32)

    def tables(self, units: np.ndarray, number: int) -> np.ndarray:
        """Squared distances of questions to the codewords of a list: (question, part, codeword)."""
        parts = self.parts(units - self.centroids[number])
        squares = (self.words ** 2).sum(axis=2)
        return squares[None] - 2 * np.einsum("qme,mwe->qmw", parts, self.words) + (parts ** 2).sum(axis=2)[:, :, None]


def nearest(rows: np.ndarray, centres: np.ndarray, step: int = 4_096) -> np.ndarray:
    """The nearest centre of each row; of equally near ones the first."""
    out = np.empty(len(rows), np.int64)
    squares = (centres ** 2).sum(axis=1)
    for at in range(0, len(rows), step):
        out[at:at + step] = (squares[None] - 2 * rows[at:at + step] @ centres.T).argmin(axis=1)
    return out


def cluster(rows: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """At most k centres, begun with rows spread over the sample's order; empty ones go."""
    centres = rows[np.unique(np.linspace(0, len(rows) - 1, min(k, len(rows))).astype(int))]
    for _ in range(rounds):
        of = nearest(rows, centres)
        n = np.bincount(of, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, of, rows)
        centres = sums[n > 0] / n[n > 0, None]
    return centres.astype(np.float32)


def fit(vectors: DataFrame, id_col: str = "review_id", lists: int | None = None, part: int = PART,
        sample: int = SAMPLE) -> Index:
    """An index for the vectors, learnt from the ``sample`` of them with the smallest hashes of
    their ids. Without ``lists`` there are as many as the root of the number of vectors, at most
    MOST_LISTS. Vectors are compared by direction."""
    rows = vectors.where(F.size("embedding") > 0)
    table = rows.orderBy(F.xxhash64(id_col), id_col).limit(sample).select("embedding").toArrow()
    matrix = _matrix(_column(table, "embedding"))
    units = _units(matrix, _norms(matrix))
    if not len(units):
        return Index(np.zeros((1, matrix.shape[1]), np.float32), np.zeros((1, 1, matrix.shape[1]), np.float32))
    lists = lists or int(min(MOST_LISTS, max(1, round(rows.count() ** 0.5))))
    centroids = cluster(units, lists)
    parts = -(-units.shape[1] // part)
    blank = Index(centroids, np.zeros((parts, 1, part), np.float32))
    pieces = blank.parts(units - centroids[nearest(units, centroids)])
    words = np.zeros((parts, WORDS, part), np.float32)
    for m in range(parts):
        found = cluster(pieces[:, m], WORDS)
        words[m] = found[np.arange(WORDS) % len(found)]
    return Index(centroids, words)


def with_codes(vectors: DataFrame, index: Index) -> DataFrame:
    """Add ``cell``, the number of a vector's list, and ``code``, a byte for each part. Written
    with ``partition_by=["cell"]``, a search reads the folders of the lists it goes through.
    All-zero vectors have no direction and are in list -1, which no question goes through."""

    @F.arrow_udf(T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("code", T.BinaryType())]))
    def coded(embeddings: pa.Array) -> pa.Array:
        units = index.units(embeddings)
        lists, codes = index.encode(units)
        lists[~units.any(axis=1)] = -1
        return pa.StructArray.from_arrays(
            [pa.array(lists, pa.int32()), pa.array([x.tobytes() for x in codes], pa.binary())], ["cell", "code"])

    return vectors.drop("cell", "code").withColumn("_coded", coded("embedding")).select("*", "_coded.*").drop("_coded")


def index_rows(index: Index) -> tuple[list[tuple], str]:
    """The index as rows of a table, to be kept beside the codes: (kind, part, number, elements)."""
    rows = [("list", 0, i, x.tolist()) for i, x in enumerate(index.centroids)]
    rows += [("word", m, i, x.tolist()) for m, words in enumerate(index.words) for i, x in enumerate(words)]
    return rows, "kind string, part int, number int, elements array<float>"


def read_index(table: DataFrame) -> Index:
    """An index from a table of ``index_rows``; its size is bounded by the bounds of the fit."""
    rows = sorted(tuple(r) for r in table.select("kind", "part", "number", "elements").collect())
    lists = np.array([r[3] for r in rows if r[0] == "list"], np.float32)
    words = [r for r in rows if r[0] == "word"]
    shape = (words[-1][1] + 1, words[-1][2] + 1, -1)
    return Index(lists, np.array([r[3] for r in words], np.float32).reshape(shape))


def candidates_of(codes: DataFrame, questions: DataFrame, index: Index, probes: int, most: int = CANDIDATES,
                  id_col: str = "review_id", block_bytes: tuple[int, int] = (VECTOR_BLOCK_BYTES, QUESTION_BYTES)
                  ) -> DataFrame:
    """(question_id, rank, id, similarity): the best ``most`` vectors per question by the similarity
    that their codes tell, among the ``probes`` nearest lists. Only ids and codes are read.

    A question of few probes meets each of its lists. One of many would be sent, and would have its
    best, as often as there are lists; it meets blocks of codes of all lists instead, and is compared
    there with those of its own.
    """
    if not 1 <= probes:
        raise ValueError("probes must be 1 at least")
    probes = min(probes, len(index.centroids))
    v = codes.where("cell >= 0").select(F.col(id_col).alias("id"), "code", F.col("cell").cast("int").alias("list"))
    q = questions.select("question_id", F.col("embedding").alias("asked"))
    by_list = probes <= FEW_PROBES

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def lists(asked: pa.Array) -> pa.Array:
        return pa.array(list(index.probed(index.units(asked), probes)), pa.list_(pa.int32()))

    if by_list:
        v = v.withColumn("cell", F.col("list"))
        probing = q.select("question_id", "asked", F.explode(lists("asked")).alias("cell"))
    else:
        v = v.withColumn("cell", _one_cell("id"))
        probing = q.withColumn("cell", _one_cell("question_id"))
    types = hit_types(v, q)

    def score(one: pa.Table, asked: pa.Table) -> pa.Table:
        one = one.select(["id", "code", "list"]).sort_by("id")
        ids, number = _column(one, "id"), _column(one, "list").to_numpy()
        held = np.frombuffer(b"".join(_column(one, "code").to_pylist()), np.uint8).reshape(len(ids), -1)
        units = index.units(_column(asked, "asked"))
        near, rows = _best_coded(index, units, number, held, most, None if by_list else probes)
        found = np.nonzero(rows >= 0)
        away = (units ** 2).sum(axis=1)[found[0]] - 2 * near[found]
        return pa.Table.from_arrays(
            [_column(asked, "question_id").take(pa.array(found[0])), ids.take(pa.array(rows[found])),
             pa.array((1 - away / 2).astype(np.float64))], names=types.names)

    hits = meet(v, probing, (F.octet_length("code") + 64, list_bytes("asked")), block_bytes, score,
                _hit_schema(v.schema, q.schema), types)
    return rank_hits(hits, most, "id").withColumnRenamed("id", id_col)


def _best_coded(index: Index, units: np.ndarray, lists: np.ndarray, codes: np.ndarray, most: int,
                probes: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(score, row) of the best ``most`` codes of each question, -1 where there are fewer; of equal
    ones the first. Without ``probes`` every code counts, else those of a question's lists. A part of
    the codes is decoded at a time, and of its scores those that beat the best so far are kept."""
    best = np.full((len(units), most), -np.inf, np.float32)
    rows = np.full((len(units), most), -1, np.int64)
    own = None
    if probes is not None and probes < len(index.centroids):
        own = np.zeros((len(units), len(index.centroids)), bool)
        for at in range(0, len(units), _ASKED):
            np.put_along_axis(own[at:at + _ASKED], index.probed(units[at:at + _ASKED], probes), True, axis=1)
    for start in range(0, len(codes), _ROWS):
        part = index.decode(lists[start:start + _ROWS], codes[start:start + _ROWS])
        half = (part ** 2).sum(axis=1) / 2
        for at in range(0, len(units), _ASKED):
            tile = slice(at, at + _ASKED)
            scores = units[tile] @ part.T - half
            if own is not None:
                scores[~own[tile][:, lists[start:start + _ROWS]]] = -np.inf
            least = best[tile, -1:]
            if start == 0 and scores.shape[1] > most:
                least = np.nextafter(np.partition(scores, -most, axis=1)[:, -most, None], np.float32(-np.inf))
            q, r = np.nonzero(scores > least)
            kept = np.nonzero(rows[tile] >= 0)
            q, r, score = (np.concatenate(x) for x in (
                (kept[0], q), (rows[tile][kept], r + start), (best[tile][kept], scores[q, r])))
            order = np.lexsort((r, -score, q))
            order = order[_first_of_each(q[order], most)]
            q, r, score = q[order], r[order], score[order]
            place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
            best[at + q, place], rows[at + q, place] = score, r
    return best, rows


def rerank(vectors: DataFrame, questions: DataFrame, found: DataFrame, k: int = TOP_K, id_col: str = "review_id",
           block_bytes: tuple[int, int] = (VECTOR_BLOCK_BYTES, QUESTION_BLOCK_BYTES)) -> DataFrame:
    """(question_id, rank, id, similarity): found pairs ranked by their true cosine similarity.

    Ids are unique on both sides. A question is sent once to each block of vectors that holds
    candidates of it, with their ids, and not once a pair.
    """
    one = _one_cell("id").alias("one")
    v = vectors.select(F.col(id_col).alias("id"), "embedding", one)
    blocks = F.broadcast(v.groupBy("one").agg(
        F.greatest(F.ceil(F.sum(list_bytes("embedding")) / block_bytes[0]), F.lit(1)).alias("blocks")))
    cell = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("cell")
    pairs = found.select("question_id", F.col(id_col).alias("id")).where("id IS NOT NULL").repartition("question_id")
    asked = questions.select("question_id", F.col("embedding").alias("asked"))
    q = (pairs.select("*", one).join(blocks, "one").select("question_id", "id", cell)
         .groupBy("question_id", "cell").agg(F.collect_list("id").alias("ids")).join(asked, "question_id"))
    v = v.join(blocks, "one").select("id", "embedding", cell)
    types = hit_types(v, q)

    def score(some: pa.Table, asking: pa.Table) -> pa.Table:
        ids, wanted = _column(some, "id"), _column(asking, "ids")
        of, wanted = pc.list_parent_indices(wanted).to_numpy(), wanted.flatten()
        rows = pc.index_in(wanted, value_set=ids)
        here = rows.is_valid()
        of, wanted = of[here.to_numpy(zero_copy_only=False)], wanted.filter(here)
        matrix = _matrix(_column(some, "embedding"))
        those = Questions(_column(asking, "question_id"), _matrix(_column(asking, "asked"), matrix.shape[1]))
        similarity = _similarity(matrix, _norms(matrix), rows.drop_null().to_numpy(), those, of)
        place = np.empty(len(ids), np.int64)
        place[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        order = np.lexsort((place[rows.drop_null().to_numpy()], np.nan_to_num(-similarity, nan=2.0), of))
        best = order[_first_of_each(of[order], k)]
        return pa.Table.from_arrays(
            [those.ids.take(pa.array(of[best])), wanted.take(pa.array(best)),
             pa.array(similarity[best], pa.float64(), from_pandas=True)], names=types.names)

    hits = meet(v, q, (list_bytes("embedding"), list_bytes("asked") + F.size("ids") * 16), block_bytes, score,
                _hit_schema(v.schema, q.schema), types)
    return rank_hits(hits.withColumnRenamed("id", id_col), k, id_col)


def indexed_topk(vectors: DataFrame, codes: DataFrame, questions: DataFrame, index: Index, probes: int,
                 k: int = TOP_K, candidates: int = CANDIDATES, id_col: str = "review_id") -> DataFrame:
    """Nearest vectors by the index: (question_id, rank, id, similarity), similarities exact.

    ``codes`` is a table of ``with_codes``; of ``vectors``, which has the same ids, the candidates
    are read. More probes and more candidates miss fewer hits.
    """
    return rerank(vectors, questions, candidates_of(codes, questions, index, probes, candidates, id_col), k, id_col)


def recall_report(hits: DataFrame, exact: DataFrame, found: DataFrame, vectors: DataFrame, id_col: str = "review_id"
                  ) -> DataFrame:
    """One row: questions, recall (share of the exact hits found), read_share (vectors read in full
    by all questions, of all pairs of questions and vectors)."""
    total = vectors.agg(F.count("*").alias("n"))
    both = exact.select("question_id", id_col).join(
        hits.select("question_id", id_col, F.lit(1).alias("hit")), ["question_id", id_col], "left")
    read = found.groupBy("question_id").count().agg(F.avg("count").alias("read"))
    one = both.agg(F.countDistinct("question_id").alias("questions"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
    sides = one.withColumn("side", F.lit(1)).join(read.withColumn("side", F.lit(1)), "side").join(
        total.withColumn("side", F.lit(1)), "side")
    return sides.select("questions", "recall", (F.col("read") / F.col("n")).alias("read_share"))
