"""Spelling variants by blocked Gram matrices.

Words at one edit differ by at most two in the squared distance of their letter counts: an added
or dropped letter changes one count, a replaced one two. Words are dealt to blocks in which such a
pair must meet, and the Gram matrix of a block's letter counts (one length against itself and the
next) gives the squared distances of all its pairs at once. What is at most two apart is then
compared letter by letter.

Blocks: the letters are dealt to five groups. One edit changes at most two groups, so two near
words have the same counts in three groups at least; each choice of three groups gives a block. A
block of very many words is cut into tiles that meet in pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import written
from reviewloom.llm.hashing import mix

#: Fixed values of the contract: what a run is, of which runs a letter is left out, the least
#: letters and occurrences of a word, and how much more often its form comes.
RUN = r"[A-Za-zÀ-ÿ]+"
DROP, LETTERS, OFTEN, TIMES = 97, 5, 3, 2
#: Groups of letters, and how many of them two near words share.
GROUPS, SHARED = 5, 3
#: Blocks of at most so many words are multiplied in stacks of about so many cells, and so many
#: pairs are compared letter by letter at a time.
STACKED, _CELLS, _VERIFIED = 48, 1 << 19, 1 << 16
#: Words of a tile, and words that a task counts before it passes them on.
TILE, HELD = 2048, 300_000
#: Code points of a text that are searched at a time.
_PART = 1 << 20


def _runs_of(text: str, pattern: re.Pattern) -> Iterator[list[str]]:
    """The maximal runs of a text, some at a time, with A-Z in lower case."""
    text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    if len(text) <= _PART:
        yield pattern.findall(text)
        return
    some = []
    for found in pattern.finditer(text):
        some.append(found.group())
        if len(some) >= _PART:
            yield some
            some = []
    yield some


def words(docs: DataFrame, id_col: str = "doc_id", text: str = "text", drop: int = DROP,
          letters: int = LETTERS, often: int = OFTEN) -> DataFrame:
    """(word, n): words of at least `letters` code points that come `often` times at least.

    A word is a run of letters with A-Z in lower case. Where `drop` divides the unsigned crc32 of
    id:run, one letter is left out, at crc32 modulo length. Counts are summed in tasks first, so a
    common word is a row a task. A null text has no words; a null id is empty in what is hashed.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, held = re.compile(RUN), Counter()

        def told() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                before = zlib.crc32(f"{'' if name is None else name}:".encode())
                for some in _runs_of(body.as_py() or "", pattern):
                    for run, n in Counter(some).items():
                        checked = zlib.crc32(run.encode(), before)
                        if checked % drop == 0:
                            at = checked % len(run)
                            run = run[:at] + run[at + 1:]
                        if len(run) >= letters:
                            held[run] += n
                    if len(held) >= HELD:
                        yield told()
        yield told()

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text).alias("text"))
    return (rows.mapInArrow(counted, "word string, n long").groupBy("word")
            .agg(F.sum("n").alias("n")).where(F.col("n") >= often))


def _codes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, and the lengths of the words."""
    joined = "".join(words.to_pylist())
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return codes, pa.compute.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)


def letter_counts(words: pa.Array) -> np.ndarray:
    """Letter counts as rows of 96 columns. Letters that share a column make distances smaller,
    so no near pair is lost; a-z and the letters from U+00C0 to U+00FF have one each."""
    codes, lengths = _codes(words)
    column = np.where(codes < 192, codes % 32, 32 + codes % 64)
    place = np.repeat(np.arange(len(lengths)), lengths) * 96 + column
    return np.bincount(place, minlength=96 * len(lengths)).reshape(-1, 96).astype(np.float32)


def block_keys(words: pa.Array) -> np.ndarray:
    """A key for each word and each choice of groups of letters: equal counts have equal keys."""
    codes, lengths = _codes(words)
    ends = np.cumsum(lengths)
    value, group = mix(codes.astype(np.uint64) + np.uint64(1)), codes % GROUPS
    sums = []
    for g in range(GROUPS):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(np.where(group == g, value, np.uint64(0)))))
        sums.append(mix((total[ends] - total[ends - lengths]) + np.uint64(g + 1)))
    return np.stack([mix(sum(sums[g] * np.uint64(2 * g + 3) for g in chosen) + np.uint64(k))
                     for k, chosen in enumerate(combinations(range(GROUPS), SHARED))], axis=1)


def _code_table(words: pa.Array) -> np.ndarray:
    """Code points of words as rows, filled up with zeros and one column more than the longest."""
    codes, lengths = _codes(words)
    table = np.zeros((len(lengths), int(lengths.max(initial=0)) + 1), np.int32)
    ends = np.cumsum(lengths)
    table[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(codes)) - np.repeat(ends - lengths, lengths)] = codes
    return table


def one_edit(short: np.ndarray, long: np.ndarray, added: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is one edit, place of the first difference) of rows of code points, filled up with zeros.
    With added, long has one letter more than short and one is inserted; else one is replaced."""
    other = short != long
    first = other.argmax(axis=1)
    later = np.arange(other.shape[1])[None] >= first[:, None]
    shifted = np.concatenate((long[:, 1:], np.zeros((len(long), 1), long.dtype)), axis=1)
    inserted = ((short == shifted) | ~later).all(axis=1)
    return np.where(added, inserted, other.sum(axis=1) == 1), first


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by block, as tables of whole blocks."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables(
            [rest, pa.Table.from_batches([batch])])
        keys = table.column("block").to_numpy()
        if not len(keys):
            continue
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if cut:
            yield table.slice(0, cut).combine_chunks()
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def close_pairs(counts: np.ndarray, lengths: np.ndarray, most: int = 2) -> np.ndarray:
    """Pairs of rows, of equal or adjacent lengths, with a squared distance of at most `most`.
    Rows ascend by length; a block of one length meets itself and the next by matrix product."""
    squares = np.einsum("ij,ij->i", counts, counts)
    starts = np.flatnonzero(np.diff(lengths, prepend=-1))
    ends = np.append(starts[1:], len(lengths))
    found = []
    for k, (start, end) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        last = end
        if k + 1 < len(starts) and lengths[starts[k + 1]] == lengths[start] + 1:
            last = int(ends[k + 1])
        gram = counts[start:end] @ counts[start:last].T
        near = squares[start:end, None] + squares[None, start:last] - 2 * gram <= most
        one, other = np.nonzero(near)
        keep = other > one
        found.append(np.stack((one[keep] + start, other[keep] + start), axis=1))
    return np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)


def pairs_of_blocks(counts: np.ndarray, lengths: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Close pairs of rows of all blocks, each ordered by length. Small blocks of one size are
    multiplied together, as one stack of Gram matrices."""
    found = [np.zeros((0, 2), np.int64)]
    squares = np.einsum("ij,ij->i", counts, counts)
    for size in np.unique(sizes).tolist():
        own = starts[sizes == size]
        if size > STACKED:
            found += [at + close_pairs(counts[at:at + size], lengths[at:at + size]) for at in own.tolist()]
            continue
        for at in range(0, len(own), max(1, _CELLS // size ** 2)):
            rows = own[at:at + max(1, _CELLS // size ** 2), None] + np.arange(size)
            block = counts[rows]
            square, length = squares[rows], lengths[rows]
            away = square[:, :, None] + square[:, None, :] - 2 * np.matmul(block, block.transpose(0, 2, 1))
            near = (away <= 2) & (length[:, None, :] - length[:, :, None] <= 1) & np.triu(np.ones((size, size), bool), 1)
            k, i, j = np.nonzero(near)
            found.append(np.stack((rows[k, i], rows[k, j]), axis=1))
    return np.concatenate(found)


def near_pairs(vocabulary: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, other, other_n), both ways, of all pairs of words at one edit; (word, n) given."""
    n_keys = len(list(combinations(range(GROUPS), SHARED)))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = block_keys(batch.column(0)).view(np.int64).reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(keys) + 1, n_keys), pa.int32()), pa.array(keys))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["word", "n", "keys"])

    rows = (vocabulary.select("word", "n").mapInArrow(keyed, "word string, n long, keys array<long>")
            .select("word", "n", F.explode("keys").alias("key")))
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    tiles = F.ceil(F.col("size") / tile)
    dealt = rows.join(sizes, "key").withColumn("tile", F.pmod(F.xxhash64("word"), tiles))
    other = F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1))
    blocks = dealt.withColumn("other", other).select(
        F.xxhash64("key", F.least("tile", "other"), F.greatest("tile", "other")).alias("block"), "word", "n", "tile")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches):
            lengths = pa.compute.utf8_length(table.column("word")).to_numpy()
            table = table.take(pa.array(np.lexsort((lengths, table.column("block").to_numpy())))).combine_chunks()
            words = table.column("word").combine_chunks()
            keys, tiles, n = (table.column(x).to_numpy() for x in ("block", "tile", "n"))
            lengths = pa.compute.utf8_length(words).to_numpy().astype(np.int64)
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            sizes = np.diff(np.append(starts, len(keys)))
            pairs = pairs_of_blocks(letter_counts(words), lengths, starts, sizes)
            across = np.repeat(np.maximum.reduceat(tiles, starts) != np.minimum.reduceat(tiles, starts), sizes)
            pairs = pairs[~across[pairs[:, 0]] | (tiles[pairs[:, 0]] != tiles[pairs[:, 1]])]
            for at in range(0, len(pairs), _VERIFIED):
                i, j = pairs[at:at + _VERIFIED].T
                used, of = np.unique(np.concatenate((i, j)), return_inverse=True)
                codes = _code_table(words.take(pa.array(used)))
                short, long = codes[of[:len(i)]], codes[of[len(i):]]
                good, first = one_edit(short, long, lengths[j] > lengths[i])
                # of equal lengths the smaller letter goes first, so a pair has one form
                place = np.arange(len(i))
                swap = (lengths[i] == lengths[j]) & (short[place, first] > long[place, first])
                a, b = np.where(swap, j, i)[good], np.where(swap, i, j)[good]
                if len(a):
                    yield pa.RecordBatch.from_arrays(
                        [words.take(pa.array(a)), words.take(pa.array(b)), pa.array(n[a]), pa.array(n[b])],
                        ["one", "other", "one_n", "other_n"])

    by_block = blocks.repartition("block").sortWithinPartitions("block")
    pairs = by_block.mapInArrow(compared, "one string, other string, one_n long, other_n long").distinct()
    ways = F.explode(F.array(F.struct(F.col("one").alias("word"), "other", "other_n"), F.struct(
        F.col("other").alias("word"), F.col("one").alias("other"), F.col("one_n").alias("other_n"))))
    return pairs.select(ways.alias("way")).select("way.*")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last. Each round doubles the steps, so
    six do for chains of 64, and a form that is twice as common can't come back to its word."""
    now = written(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(now.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", drop: int = DROP,
             letters: int = LETTERS, often: int = OFTEN, times: int = TIMES, tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of the texts.

    form is the near word that comes most often, of equally frequent ones the first in code-point
    order, if it comes `times` times as often as the word; root is where forms end, the word
    itself if it has none. Whole texts are read, however long. Rows without text give nothing;
    repeated rows count each time; an empty table gives an empty one; other columns are not read.
    """
    vocabulary = written(words(docs, id_col, text, drop, letters, often))
    near = near_pairs(vocabulary, tile).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    best_n = -F.col("best.less")
    judged = written(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(best_n >= times * F.col("n"), F.col("best.other")).alias("form"),
        F.when(best_n >= times * F.col("n"), best_n).alias("form_n")))
    roots = _roots(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
