"""Top-k reviews by cosine similarity for a whole table of questions.

Every question has to be compared with every vector, or in the approximate form with
every vector of the cells it probes. Both sides of a cell are cut into blocks by a hash of
their ids, and each block meets the other side's blocks of its cell through a join on the
block numbers. A cell has as many blocks as its bytes ask for, summed inside the plan, so a
cell that holds a third of all vectors is many blocks. Question blocks are as large as a task
can hold, so vectors are sent as seldom as possible: once, up to that many bytes of questions.
The plan is the same for one question and for millions.

Pairs are scored by matrix products inside tasks, and of each block only the best k per
question become rows. They are ranked in two steps, by question and part and then by question,
so that one question's hits from all blocks don't meet in a task before they are few.

The rows sent grow with the product of both tables. ``in_rounds`` searches a block of questions at
a time and writes its hits, so what lies on disk at once grows with the vectors alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from reviewloom.functions import text
from reviewloom.sources import tables

# Hits per question when answering, and when checking a new vector table.
TOP_K, CHECK_K = 5, 2

# Bytes of a block of vectors and of questions; a task holds one of each.
VECTOR_BLOCK_BYTES = 32 << 20
QUESTION_BLOCK_BYTES = 64 << 20
# Blocks of a cell and side that may be smaller, as a caller wants them; more grow to these sizes first.
SMALL_BLOCKS = 4
# Parts of a question's hits that are ranked apart first.
PARTS = 32
# Bits of a cell number, so at most 4,096 cells.
MOST_BITS = 12
# Elements of one similarity matrix, and groups of its rows.
_TILE, _GROUPS = 1 << 21, 256


def split_questions(questions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): rejected rows have a reason.

    A question that is null or all whitespace is rejected, and one whose id is null or also the
    id of another question: hits are kept by question id, so two questions of one id would end
    up in one ranking.
    """
    blank = text.is_blank(F.col("question"))
    reason = (F.when(F.col("question").isNull(), "question is null").when(blank, "question is empty")
              .otherwise("question_id is null"))
    unusable = blank | F.col("question_id").isNull()
    usable = questions.filter(~unusable)
    repeated = usable.groupBy("question_id").count().filter("count > 1").select("question_id")
    return (
        usable.join(repeated, "question_id", "left_anti").select(questions.columns),
        questions.filter(unusable).withColumn("reason", reason).unionByName(
            usable.join(repeated, "question_id", "left_semi").withColumn(
                "reason", F.lit("question_id is not unique")).select(*questions.columns, "reason")),
    )


def rank_hits(hits: DataFrame, k: int, id_col: str) -> DataFrame:
    """The best k per question with their 1-based rank; ties go to the lower id, and a
    similarity that is undefined (an all-zero vector) comes last. Parts of a question's hits
    are ranked first, so that a question with hits in very many tasks is not one task's."""
    order = (F.desc_nulls_last("similarity"), F.asc(id_col))
    by_part = Window.partitionBy("question_id", "part").orderBy(*order)
    best_first = Window.partitionBy("question_id").orderBy(*order)
    return (
        hits.withColumn("part", F.pmod(F.xxhash64(id_col), F.lit(PARTS)))
        .withColumn("rank", F.row_number().over(by_part))
        .filter(F.col("rank") <= k)
        .withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= k)
        .select("question_id", "rank", id_col, "similarity")
    )


def cosine_topk(
    vectors: DataFrame,
    questions: DataFrame,
    k: int = TOP_K,
    id_col: str = "review_id",
    block_bytes: tuple[int, int] | None = None,
) -> DataFrame:
    """Exact nearest vectors: (question_id, rank, id, similarity).

    ``vectors`` has the id column and ``embedding``; ``questions`` has ``question_id`` and
    ``embedding``, of float or double. Both ids have to be unique (``split_questions`` sees to
    that for questions). Both sides are read twice, to be sized and to be scored, so give
    written tables where they are dear to make. ``block_bytes`` of vectors and of questions
    meet in a task. Smaller ones than VECTOR_BLOCK_BYTES and QUESTION_BLOCK_BYTES make up to
    SMALL_BLOCKS blocks of a side; then blocks grow to those sizes before they become more, as
    each is sent to all blocks of the other side.
    """
    v = vectors.select(F.col(id_col).alias("id"), "embedding", _one_cell(id_col).alias("cell"))
    q = questions.select("question_id", F.col("embedding").alias("asked"))
    return _search(v, q, k, id_col, None, block_bytes)


def _one_cell(key: str) -> Column:
    """0 for every row, and no constant: joins by a constant would be planned as loops."""
    return F.pmod(F.hash(key), F.lit(1))


def search_questions(
    vectors: DataFrame, questions: DataFrame, embed, k: int = CHECK_K, id_col: str = "review_id",
    folder: str | None = None,
) -> DataFrame:
    """Exact search for question texts: ``embed`` maps a DataFrame with ``question`` to one
    with ``embedding`` and has to be the function that made the vectors. With a ``folder``, which
    all executors must share, embedded questions and hits are written there, ``in_rounds``."""
    if folder is None:
        return cosine_topk(vectors, embed(questions), k, id_col)
    tables.write_table(embed(questions).select("question_id", "embedding"), f"{folder}/asked")
    asked = tables.read_table(questions.sparkSession, f"{folder}/asked")
    return in_rounds(asked, f"{folder}/hits", lambda some: cosine_topk(vectors, some, k, id_col))


def part_of(rows: DataFrame, number: int, parts: int) -> DataFrame:
    """The rows of one part of the questions. The hash differs from that of blocks, so the questions of
    a part are spread over all of these."""
    if parts == 1:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("part"), "question_id"), F.lit(parts)) == number)


def in_rounds(questions: DataFrame, path: str, topk: Callable[[DataFrame], DataFrame], blocks: int = 1) -> DataFrame:
    """The hits that ``topk`` has for all of these questions, as a table at ``path``.

    Blocks of questions are sent to all blocks of vectors and these to those, so all at once they take
    disk with the product of both. A round has about so many ``blocks`` of questions, and what it shuffled is
    removed when its hits are written. ``topk`` has to rank each question by itself, as all searches here
    do. ``questions`` are read in every round: give a written table.
    """
    held = questions.agg(F.sum(list_bytes("embedding"))).first()[0] or 0
    rounds = max(1, -(-held // (blocks * QUESTION_BLOCK_BYTES * 15 // 16)))  # parts by a hash are not quite even
    for number in range(rounds):
        tables.write_table(topk(part_of(questions, number, rounds)), path, append=number > 0)
    return tables.read_table(questions.sparkSession, path)


# --- cells: the approximate form -------------------------------------------------------


def _md5(name: str) -> bytes:
    return hashlib.md5(name.encode(), usedforsecurity=False).digest()


@dataclass(frozen=True)
class Cells:
    """Locality-sensitive cells: the signs of a vector's projections on ``bits`` planes.

    Plane elements are +1 or -1, by the first hex digit of an MD5, so that the cells of a
    stored table can be recomputed anywhere from the three numbers.
    """

    bits: int
    width: int
    seed: int = 0
    planes: np.ndarray = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        if not 1 <= self.bits <= MOST_BITS:
            raise ValueError(f"bits must lie between 1 and {MOST_BITS}")
        names = (f"{self.seed}:{bit}:{dim}" for bit in range(self.bits) for dim in range(self.width))
        low = [_md5(name)[0] < 0x80 for name in names]
        planes = np.where(low, 1.0, -1.0).reshape(self.bits, self.width)
        object.__setattr__(self, "planes", planes)

    def project(self, matrix: np.ndarray) -> np.ndarray:
        if matrix.shape[1] != self.width:
            raise ValueError(f"vectors are {matrix.shape[1]} wide, cells are for {self.width}")
        return np.nan_to_num(matrix.astype(np.float64)) @ self.planes.T

    def of(self, matrix: np.ndarray) -> np.ndarray:
        weights = 1 << np.arange(self.bits)
        return ((self.project(matrix) >= 0) @ weights).astype(np.int32)

    def probes(self, matrix: np.ndarray, count: int) -> np.ndarray:
        """Per vector its own cell and the nearest others, ``count`` in all and in no order.

        How near a cell is follows from the planes between: the sum of the squared
        projections on them.
        """
        projected = self.project(matrix)
        own = ((projected >= 0) @ (1 << np.arange(self.bits))).astype(np.int32)
        between = (np.arange(1 << self.bits)[:, None] >> np.arange(self.bits)) & 1
        out = np.empty((len(matrix), count), np.int32)
        step = max(1, _TILE >> self.bits)
        for start in range(0, len(matrix), step):
            at = slice(start, start + step)
            distance = projected[at] ** 2 @ between.T
            nearest = np.argpartition(distance, count - 1, axis=1)[:, :count]
            out[at] = own[at, None] ^ nearest
        return out


def assign_cells(vectors: DataFrame, cells: Cells) -> DataFrame:
    """Add the ``cell`` column. Written with ``partition_by=["cell"]``, a search reads only
    the folders of the cells it probes."""

    @F.arrow_udf(T.IntegerType())
    def cell(embeddings: pa.Array) -> pa.Array:
        return pa.array(cells.of(_matrix(embeddings, cells.width)), pa.int32())

    return vectors.withColumn("cell", cell("embedding"))


def lsh_topk(
    vectors: DataFrame,
    questions: DataFrame,
    cells: Cells,
    k: int = TOP_K,
    probes: int = 4,
    id_col: str = "review_id",
    block_bytes: tuple[int, int] | None = None,
) -> DataFrame:
    """Nearest vectors among those in the probed cells, as ``cosine_topk`` ranks them.

    ``vectors`` has a ``cell`` column made with the same ``cells``. All vectors of a probed
    cell are scored; vectors of other cells are not, so hits can be missed. More probes
    miss fewer, and with all cells probed the result is exact.
    """
    if not 1 <= probes <= 1 << cells.bits:
        raise ValueError("probes must lie between 1 and the number of cells")
    v = vectors.select(F.col(id_col).alias("id"), "embedding", F.col("cell").cast("int").alias("cell"))
    q = questions.select("question_id", F.col("embedding").alias("asked"))
    return _search(v, q, k, id_col, lambda m: cells.probes(m, probes), block_bytes, cells.width)


# --- blocks ----------------------------------------------------------------------------


def _search(v, q, k, id_col, probe, block_bytes, width=None):
    sizes = block_bytes or (VECTOR_BLOCK_BYTES, QUESTION_BLOCK_BYTES)
    return rank_hits(_by_blocks(v, q, k, probe, width, *sizes).withColumnRenamed("id", id_col), k, id_col)


def _hit_schema(v_schema, q_schema) -> str:
    return (f"question_id {q_schema['question_id'].dataType.simpleString()}, "
            f"id {v_schema['id'].dataType.simpleString()}, similarity double")


def _by_blocks(v, q, k, probe, width, v_bytes, q_bytes) -> DataFrame:
    def add_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = probe(_matrix(batch.column("asked"), width))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(found), pa.list_(pa.int32()))],
                ["question_id", "asked", "cells"])

    if probe is None:
        probing = q.withColumn("cell", _one_cell("question_id"))
    else:
        probing = q.mapInArrow(add_cells, T.StructType([
            *q.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))]))
        probing = probing.withColumn("cell", F.explode("cells")).drop("cells")

    def score(one: pa.Table, other: pa.Table) -> pa.Table:
        asked = Questions(
            _column(other, "question_id"), _matrix(_column(other, "asked"), width))
        same_cell = pa.array(np.zeros(one.num_rows, np.int32))
        scored = _score(asked, k, _column(one, "id"), _column(one, "embedding"), same_cell)
        return pa.Table.from_batches([batch.cast(types) for batch in scored], types)

    types = hit_types(v, q)
    most = max(v_bytes, VECTOR_BLOCK_BYTES), max(q_bytes, QUESTION_BLOCK_BYTES)
    return meet(v, probing, (list_bytes("embedding"), list_bytes("asked")), most, score,
                _hit_schema(v.schema, q.schema), types, (v_bytes, q_bytes))


def list_bytes(column: str) -> Column:
    """About the bytes of a row with this list in a task."""
    return F.greatest(F.size(column), F.lit(0)) * 8 + 64


def hit_types(v: DataFrame, q: DataFrame) -> pa.Schema:
    return pa.schema([
        ("question_id", to_arrow_type(q.schema["question_id"].dataType)),
        ("id", to_arrow_type(v.schema["id"].dataType)),
        ("similarity", pa.float64()),
    ])


def meet(
    v: DataFrame, probing: DataFrame, row_bytes: tuple[Column, Column], most: tuple[int, int],
    score, schema: str, types: pa.Schema, wanted: tuple[int, int] | None = None,
) -> DataFrame:
    """score(rows of v, rows of probing) for blocks of both that share a ``cell``.

    Both have a ``cell``; ``v`` has an ``id`` and ``probing`` a ``question_id``, by whose hashes the
    rows of a cell are dealt to blocks of about ``most`` bytes, or of ``wanted`` bytes while these
    are no more than SMALL_BLOCKS.
    """
    wanted = wanted or most

    def blocks(df: DataFrame, held: Column, most: int, wanted: int, name: str) -> DataFrame:
        small = F.least(F.ceil(F.sum(held) / wanted), F.lit(SMALL_BLOCKS))
        return df.groupBy("cell").agg(F.greatest(F.ceil(F.sum(held) / most), small).cast("int").alias(name))

    # One row per cell that has both: at most 2 ** MOST_BITS, so it can be broadcast. Cells
    # that no question probes end here.
    sizes = F.broadcast(
        blocks(v, row_bytes[0], most[0], wanted[0], "v_blocks").join(
            blocks(probing, row_bytes[1], most[1], wanted[1], "q_blocks"), "cell"))

    def block(key: str, count: str) -> Column:
        return F.pmod(F.xxhash64(key), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = (
        v.join(sizes, "cell")
        .withColumn("v_block", block("id", "v_blocks"))
        .withColumn("q_block", every("q_blocks"))
        .drop("v_blocks", "q_blocks")
    )
    right = (
        probing.join(sizes, "cell")
        .withColumn("q_block", block("question_id", "q_blocks"))
        .withColumn("v_block", every("v_blocks"))
        .drop("v_blocks", "q_blocks")
    )

    def scored(one: pa.Table, other: pa.Table) -> pa.Table:
        if not one.num_rows or not other.num_rows:
            return types.empty_table()
        return score(one, other).cast(types)

    keys = ["cell", "v_block", "q_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(scored, schema)


# --- scoring inside a task -------------------------------------------------------------


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of a list column in its own precision; a null vector is a row of zeros."""
    lengths = pc.list_value_length(column)
    known = pc.unique(lengths.drop_null()).to_pylist()
    if width is None:
        width = known[0] if known else 1
    if any(length != width for length in known):
        raise ValueError(f"vectors of widths {sorted({*known, width})} in one table")
    kind = np.float64 if pa.types.is_float64(column.type.value_type) else np.float32
    out = np.zeros((len(column), width), kind)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    present = np.asarray(column.is_valid())
    out[present] = values.reshape(-1, width)
    return out


def _norms(matrix: np.ndarray) -> np.ndarray:
    """Lengths in double precision; 0 where no similarity is defined."""
    norms = np.empty(len(matrix))
    step = max(1, _TILE // matrix.shape[1])
    for start in range(0, len(matrix), step):
        part = matrix[start:start + step].astype(np.float64)
        norms[start:start + step] = np.sqrt((part * part).sum(axis=1))
    return np.where(np.isfinite(norms), norms, 0.0)


def _units(matrix: np.ndarray, norms: np.ndarray) -> np.ndarray:
    units = np.zeros(matrix.shape, np.float32)
    np.divide(matrix, norms[:, None], out=units, where=(norms > 0)[:, None], casting="unsafe")
    return units


class Questions:
    """Question vectors, grouped by the cells they probe; without any, all probe cell 0. ``least`` is
    the similarity a hit needs, where k hits of a question are known that have it; else NaN."""

    def __init__(
        self, ids: pa.Array, matrix: np.ndarray, cells: pa.Array | None = None, least: np.ndarray | None = None
    ) -> None:
        self.ids, self.matrix = ids, matrix
        self.norms = _norms(matrix)
        self.units = _units(matrix, self.norms)
        self.least = np.full(len(matrix), np.nan) if least is None else least.copy()
        self.best = None
        rows, probed = np.arange(len(matrix)), np.zeros(len(matrix), np.int32)
        if cells is not None:
            rows = np.repeat(rows, pc.list_value_length(cells).to_numpy())
            probed = cells.flatten().to_numpy()
        order = np.lexsort((rows, probed))
        found, first = np.unique(probed[order], return_index=True)
        self.by_cell = dict(zip(found.tolist(), np.split(rows[order], first[1:])))

    def raise_least(self, k: int, questions: np.ndarray, similarity: np.ndarray) -> None:
        """Takes the best k that a cell has for each of these questions, in order."""
        if self.best is None:
            self.best = np.full((len(self.matrix), k), -np.inf)
        some, first, each = np.unique(questions, return_index=True, return_counts=True)
        place = np.arange(len(questions)) - np.repeat(first, each)
        both = np.full((len(some), 2 * k), -np.inf)
        both[:, :k] = self.best[some]
        both[np.repeat(np.arange(len(some)), each), k + place] = np.nan_to_num(similarity, nan=-np.inf)
        self.best[some] = best = np.partition(both, k, axis=1)[:, k:]
        kth = best[:, 0]
        self.least[some] = np.fmax(self.least[some], np.where(kth > -np.inf, kth, np.nan))


def _score(
    asked: Questions, k: int, ids: pa.Array, embeddings: pa.Array, cells: pa.Array
) -> Iterator[pa.RecordBatch]:
    """The best k of these vectors per question and cell it probes."""
    if not len(ids) or not len(asked.ids):
        return
    order = pc.sort_indices(ids)
    ids, cells = ids.take(order), np.asarray(cells.take(order))
    matrix = _matrix(embeddings.take(order), asked.matrix.shape[1])
    norms = _norms(matrix)
    found = np.unique(cells)
    several = len(found) > 1
    for cell in found:
        questions = asked.by_cell.get(int(cell))
        if questions is None:
            continue
        rows = np.nonzero(cells == cell)[0]
        units = _units(matrix[rows], norms[rows])
        collapsed = False
        step = max(1, _TILE // len(rows))
        for start in range(0, len(questions), step):
            tile = questions[start:start + step]
            near = _near(units, norms[rows], asked, tile, k)
            if len(near[0]) > 16 * k * len(tile) and not collapsed:
                # Many equal vectors: of each only the k lowest ids can be among the best.
                keep = _lowest_of_equals(matrix[rows], k)
                rows, units, collapsed = rows[keep], units[keep], True
                near = _near(units, norms[rows], asked, tile, k)
            r, q = rows[near[0]], tile[near[1]]
            similarity = _similarity(matrix, norms, r, asked, q)
            enough = ~(similarity < asked.least[q])
            r, q, similarity = r[enough], q[enough], similarity[enough]
            order = np.lexsort((r, np.nan_to_num(-similarity, nan=2.0), q))
            best = order[_first_of_each(q[order], k)]
            r, q, similarity = r[best], q[best], similarity[best]
            if several:
                asked.raise_least(k, q, similarity)
            yield pa.RecordBatch.from_arrays(
                [asked.ids.take(pa.array(q)), ids.take(pa.array(r)),
                 pa.array(similarity, pa.float64(), from_pandas=True)],
                ["question_id", "id", "similarity"])


def _near(units, norms, asked: Questions, tile, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, position in tile) of the pairs that can be among the best k per question.

    Single precision and a slack that covers its error. Where no similarity is defined the
    score is below all others and falls with the row, because rows come in id order. The k-th
    of the best scores of groups of rows is no more than the k-th of all, and tells the groups
    that are looked at row by row.
    """
    scores = asked.units[tile] @ units.T
    undefined = (asked.norms[tile] == 0)[:, None] | (norms == 0)[None, :]
    if undefined.any():
        scores = np.where(undefined, np.float32(-2) - np.arange(len(units))[None, :], scores)
    slack = np.float32(4 * (units.shape[1] + 8) * np.finfo(np.float32).eps)
    known = asked.least[tile].astype(np.float32)
    if not np.isnan(known).any():
        enough = scores >= (known - slack)[:, None]
        if np.count_nonzero(enough) <= 4 * k * len(tile):
            question, row = np.divmod(np.flatnonzero(enough), len(units))
            return row, question
    n, groups = len(units), max(_GROUPS, 16 * k)
    each, rest = divmod(n, groups)
    if each < 4:
        at = max(0, n - k)
        least = np.partition(scores, at, axis=1)[:, at] - slack
        question, row = np.nonzero(scores >= least[:, None])
        return row, question
    best = scores[:, :each * groups].reshape(len(scores), each, groups).max(axis=1)
    best[:, :rest] = np.maximum(best[:, :rest], scores[:, each * groups:])
    least = np.partition(best, groups - k, axis=1)[:, groups - k] - slack
    question, group = np.nonzero(best >= least[:, None])
    if len(question) > 16 * k * len(tile):  # many equal scores
        question, row = np.nonzero(scores >= least[:, None])
        return row, question
    rows = group[:, None] + groups * np.arange(each + 1)
    found = (scores[question[:, None], np.minimum(rows, n - 1)] >= least[question, None]) & (rows < n)
    return rows[found], np.broadcast_to(question[:, None], rows.shape)[found]


def _similarity(matrix, norms, rows, asked: Questions, questions) -> np.ndarray:
    """Similarities in double precision, each the same sum wherever its row lies; NaN if
    there is none."""
    out = np.full(len(rows), np.nan)
    step = max(1, _TILE // matrix.shape[1])
    for start in range(0, len(rows), step):
        at = slice(start, start + step)
        r, q = rows[at], questions[at]
        products = matrix[r].astype(np.float64) * asked.matrix[q].astype(np.float64)
        lengths = norms[r] * asked.norms[q]
        np.divide(products.sum(axis=1), lengths, out=out[at], where=lengths > 0)
    return out


def _lowest_of_equals(matrix: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first k rows of each set of equal rows, in order."""
    raw = np.ascontiguousarray(matrix + matrix.dtype.type(0))  # -0.0 becomes 0.0
    rows = raw.view(np.dtype((np.void, raw.dtype.itemsize * raw.shape[1]))).ravel()
    _, group = np.unique(rows, return_inverse=True)
    order = np.argsort(group, kind="stable")
    return np.sort(order[_first_of_each(group[order], k)])


def _first_of_each(ordered: np.ndarray, k: int) -> np.ndarray:
    """True for the first k of each run of equal numbers."""
    return np.arange(len(ordered)) - np.searchsorted(ordered, ordered, side="left") < k
