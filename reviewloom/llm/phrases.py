"""Phrase collocation mining by Misra-Gries summaries.

Every n-gram belongs to a hash partition. Tasks count the n-grams of runs of texts, a partition at
a time; such exact counts are Misra-Gries summaries that have dropped nothing yet. A partition
merges its runs' summaries under a capacity above its mass divided by the threshold, so that an
n-gram which comes as often as the threshold can't be lost. What survives is counted exactly: its
hashes from the same rows, which leaves few, and then its words from the texts of the runs that
hold it. Phrases are scored by exact counts of their parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import written
from reviewloom.llm.hashing import WordHashes, mix

#: Fixed values of the contract: most words of a phrase, least occurrences, the share (in percent)
#: of a phrase's occurrences inside a longer one at which it goes, phrases of a language, and the
#: language of rows without one.
LONGEST, LEAST, INSIDE, TOP, UNKNOWN = 3, 10, 50, 2000, "und"
#: Bytes of a run and n-gram occurrences of a hash partition for up to SCALE bytes of text. Both
#: grow with the square root of what is beyond, up to MOST times, so that a run's row for a
#: partition does not get short; texts are hashed CHUNK bytes at a time.
RUN, MASS, SCALE, MOST, CHUNK = 8 << 20, 1 << 23, 4 << 30, 4, 4 << 20
#: Marks that end a piece become the first of them, which no word can hold.
_MARKS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d", b"." * 10)
_END = b"."


def tokens(text: str | None) -> list[bytes]:
    """Words in order, A-Z in lower case, and a full stop wherever a piece ends."""
    data = (text or "").encode("utf-8", "surrogatepass").lower().translate(_MARKS)
    return data.replace(b".", b" . ").split()  # of ASCII white space only blanks and tabs are left


def _hashed(texts: list[str], langs: list[str], known: WordHashes, longest: int) -> Iterator[tuple]:
    """(words, languages' hashes, whether a piece ends, [(hashes, places) for each length]) of
    chunks of the texts."""
    start = 0
    while start < len(texts):
        every: list[bytes] = []
        sizes, held, end = [], 0, start
        while end < len(texts) and held < CHUNK:
            some = tokens(texts[end])
            every += some
            every.append(_END)
            sizes.append(len(some) + 1)
            held += len(texts[end])
            end += 1
        lang_of = np.repeat(known.of([x.encode("utf-8", "surrogatepass") for x in langs[start:end]]), sizes)
        hashes = known.of(every)
        whole = hashes != np.uint64(known[_END])
        ends, value, grams = ~whole, mix(hashes ^ mix(lang_of)), []
        for n in range(1, longest + 1):
            if n > 1:
                value = mix(value[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[n - 1:])
                whole = whole[:-1] & ~ends[n - 1:]
            at = np.flatnonzero(whole)
            grams.append((value[at], at))
        yield every, lang_of, ends, grams
        start = end


def _in_runs(docs: DataFrame, text: str, lang: str, run_bytes: int) -> DataFrame:
    """(run, lang, text) as a written table, so that a run is the same texts whenever it is read.

    A run is a task's next texts of together about run_bytes.
    """

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            size = np.cumsum(pa.compute.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
            run = first + (total + size) // run_bytes
            total += int(size[-1]) if len(size) else 0
            yield pa.RecordBatch.from_arrays([pa.array(run, pa.int64()), *batch.columns], ["run", "lang", "text"])

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.col(text).alias("text")).where("text IS NOT NULL")
    return written(rows.mapInArrow(numbered, "run long, lang string, text string"))


def _of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[str], list[str]]]:
    """(run, texts, languages) of rows that come run after run; a run may come in several."""
    run, texts, langs = None, [], []
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for r, lang, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if r != run and texts:
                    yield run, texts, langs
                    texts, langs = [], []
                run = r
                texts.append(text)
                langs.append(lang)
    if texts:
        yield run, texts, langs


def _partition_of(hashes: np.ndarray, partitions: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(partitions) >> np.uint64(32)).astype(np.int64)


def _summaries(runs: DataFrame, partitions: int, longest: int) -> DataFrame:
    """(part, run, keys, counts): how often each n-gram of a run comes, by hash partition. keys are
    the lower 32 bits of the hashes; n-grams that share them are told apart by the last pass."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for run, texts, langs in _of_runs(batches):
            found = []
            for _, _, _, grams in _hashed(texts, langs, known, longest):
                found.append(np.unique(np.concatenate([x for x, _ in grams]), return_counts=True))
            hashes, of = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)
            if not len(hashes):
                continue
            counts = np.bincount(of, np.concatenate([n for _, n in found])).astype(np.int32)
            part = _partition_of(hashes, partitions)  # ascends with the hash
            starts = np.flatnonzero(np.diff(part, prepend=-1))
            offsets = pa.array(np.append(starts, len(part)), pa.int32())
            keys = pa.array((hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[starts], pa.int32()), pa.array(np.full(len(starts), run)),
                 pa.ListArray.from_arrays(offsets, keys), pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))],
                ["part", "run", "keys", "counts"])

    return runs.mapInArrow(made, "part int, run long, keys array<int>, counts array<int>")


def merge(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray], capacity: int
          ) -> tuple[np.ndarray, np.ndarray]:
    """The Misra-Gries summary of what two summaries (keys, counts) stand for: counts are added,
    and beyond `capacity` keys all fall by the largest count that must go. A key whose true count
    is above mass / (capacity + 1) stays."""
    keys, of = np.unique(np.concatenate((one[0], other[0])), return_inverse=True)
    counts = np.bincount(of, np.concatenate((one[1], other[1])), len(keys)).astype(np.int64)
    if len(keys) > capacity:
        counts = counts - np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1]
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts


def _among(some: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of some are in ordered."""
    if not len(ordered):
        return np.zeros(len(some), bool)
    return ordered[np.minimum(np.searchsorted(ordered, some), len(ordered) - 1)] == some


def survivors(rows: list[tuple[np.ndarray, np.ndarray]], least: int) -> np.ndarray:
    """Keys of a partition that come `least` times or more. Summaries are merged some at a time;
    then the keys that are left are counted exactly over the same rows."""
    mass = sum(int(counts.sum()) for _, counts in rows)
    capacity = mass // least + 1
    summary = (np.zeros(0, np.int32), np.zeros(0, np.int64))
    some: list = []
    for row in [*rows, None]:
        if row is not None:
            some.append(row)
        if some and (row is None or sum(len(k) for k, _ in some) > 4 * capacity):
            summary = merge(summary, tuple(np.concatenate(x) for x in zip(*some, strict=True)), capacity)
            some = []
    keys = summary[0]
    total = np.zeros(len(keys), dtype=np.int64)
    for found, counts in rows:
        held = _among(found, keys)
        total += np.bincount(np.searchsorted(keys, found[held]), counts[held], len(keys)).astype(np.int64)
    return keys[total >= least]


def _frequent(summaries: DataFrame, least: int) -> DataFrame:
    """(run, part, keys): for each run the keys of its n-grams that are frequent in all."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, runs, rows = None, [], []

        def told() -> pa.RecordBatch:
            kept = survivors(rows, least)
            held = [keys[_among(keys, kept)] for keys, _ in rows]
            offsets = np.cumsum([0] + [len(x) for x in held])
            return pa.RecordBatch.from_arrays(
                [pa.array(runs, pa.int64()), pa.array([part] * len(runs), pa.int32()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(held)))],
                ["run", "part", "keys"])

        for batch in batches:
            for p, run, keys, counts in zip(*batch.columns, strict=True):
                if p.as_py() != part and rows:
                    yield told()
                    runs, rows = [], []
                part = p.as_py()
                runs.append(run.as_py())
                rows.append(tuple(x.values.to_numpy(zero_copy_only=False) for x in (keys, counts)))
        if rows:
            yield told()

    return (summaries.repartition("part").sortWithinPartitions("part")
            .mapInArrow(judged, "run long, part int, keys array<int>").where("size(keys) > 0"))


_COUNTED = "lang string, phrase string, words int, n long"


def _counted(runs: DataFrame, frequent: DataFrame, partitions: int, longest: int) -> DataFrame:
    """(lang, phrase, words, n): n-grams of a run whose keys are frequent, with their exact counts
    there; words 0: all words of the language. Inside a chunk of a run's texts n-grams are equal if
    their 64-bit hashes are; beyond it their words are compared."""

    def counts(texts: pa.Table, frequent: pa.Table) -> pa.Table:
        kept = np.zeros(0, np.uint64)
        if frequent.num_rows:
            lists = frequent.column("keys").combine_chunks()
            part = np.repeat(frequent.column("part").to_numpy(), pa.compute.list_value_length(lists).to_numpy())
            kept = np.sort(part.astype(np.uint64) << np.uint64(32) | lists.flatten().to_numpy().view(np.uint32))
        langs, known = texts.column("lang").to_pylist(), WordHashes()
        name = {xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")): x for x in set(langs)}
        out: dict[tuple, int] = {}
        for words, lang_of, ends, grams in _hashed(texts.column("text").to_pylist(), langs, known, longest):
            for h, n in zip(*np.unique(lang_of[~ends], return_counts=True), strict=True):
                key = name[int(h)], None, 0
                out[key] = out.get(key, 0) + int(n)
            for length, (hashes, at) in enumerate(grams, 1):
                part = _partition_of(hashes, partitions).astype(np.uint64)
                wanted = part << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF)
                held = _among(wanted, kept)
                _, first, n = np.unique(hashes[held], return_index=True, return_counts=True)
                at = at[held][first]
                for i, h, k in zip(at.tolist(), lang_of[at].tolist(), n.tolist(), strict=True):
                    key = name[h], b" ".join(words[i:i + length]), length
                    out[key] = out.get(key, 0) + k
        columns = list(zip(*((a, b, c, n) for (a, b, c), n in out.items()), strict=True)) or [[]] * 4
        return pa.table([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary()).cast(pa.string()),
                         pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64())],
                        ["lang", "phrase", "words", "n"])

    return runs.groupBy("run").cogroup(frequent.groupBy("run")).applyInArrow(counts, _COUNTED)


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST,
                     least: int = LEAST, run_bytes: int = RUN, mass: int = MASS) -> DataFrame:
    """(lang, phrase, words, n) of all phrases of 1 to `longest` words that come `least` times in a
    language, and a row with words 0 and a null phrase for all words of each language."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    more = min(MOST, max(1.0, (total / SCALE) ** 0.5))
    runs = _in_runs(docs, text, lang, int(run_bytes * more))
    partitions = max(1, round(total / 5 * longest / (mass * more)) + 1)  # a word in five bytes
    frequent = _frequent(_summaries(runs, partitions, longest), least)
    counted = _counted(runs, frequent, partitions, longest).groupBy("lang", "phrase", "words")
    return counted.agg(F.sum("n").alias("n")).where((F.col("words") == 0) | (F.col("n") >= least))


def _part(first: Column | int, length: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, length), " ")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST,
                 least: int = LEAST, inside: int = INSIDE, top: int | None = TOP, run_bytes: int = RUN,
                 mass: int = MASS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best `top` phrases of two words
    or more; all with top None.

    a, l and r count the phrase and the parts of its worst cut, n all words of the language. A
    score is floor(1000000 * a * a / (l * r)), in decimals, exact for counts up to 14 digits. A
    phrase goes if a longer one around it comes `inside` percent as often. Null texts are empty, a
    null language is `und`. Ties of score and a go by the phrase's bytes; whole texts are read,
    however long; repeated rows count each time; an empty table gives an empty one; other columns
    are not read.
    """
    counted = written(frequent_phrases(docs, text, lang, longest, least, run_bytes, mass))
    phrases = counted.where("words > 0").select("lang", "phrase", "words", F.col("n").alias("a"))
    candidates = phrases.where("words > 1")
    known = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("part_n"))
    cuts = (candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .withColumn("part", _part(1, F.col("k"))).join(known, ["lang", "part"]).withColumnRenamed("part_n", "l")
            .withColumn("part", _part(F.col("k") + 1, F.col("words") - F.col("k"))).join(known, ["lang", "part"])
            .withColumnRenamed("part_n", "r"))
    exact = {x: F.col(x).cast("decimal(14,0)") for x in "alr"}
    cuts = cuts.withColumn("top", exact["a"] * exact["a"] * F.lit(1_000_000).cast("decimal(7,0)")).withColumn(
        "under", exact["l"] * exact["r"]).withColumn("score", F.expr("top div under"))
    scored = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    shorter = F.explode(F.expr(  # all phrases of two words or more inside this one
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), f -> slice(w, f, m))))"))
    longer = (candidates.where("words > 2").withColumn("w", F.split("phrase", " ")).select("lang", "a", shorter.alias("w"))
              .groupBy("lang", F.array_join("w", " ").alias("phrase")).agg(F.max("a").alias("around")))
    left = scored.join(longer, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (100 * F.col("around") < inside * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = left.withColumn("rank", F.row_number().over(best).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    words = counted.where("words = 0").select("lang", "n")
    return ranked.join(words, "lang").select(
        "lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").alias("score"))
