"""Substring dedup by fixed-block anchors.

The reference index holds non-overlapping blocks of 10 words of every document. Every rolling
window of 10 words probes it. A repeated window of 20 words holds a whole block of its earlier
place, so a hit is inside it; hits are extended to all windows of 20 words around them, these are
compared by value, and every one but the first is marked. Marked windows that overlap are a
maximal repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import written
from reviewloom.llm.exchange import (
    _PACKED, answered, bucket_count, gaps, keyed, once, own_id, packed, places_of, runs,
)
from reviewloom.llm.hashing import WordHashes, spaced_words, windows
from reviewloom.operators.dedupe import filter_bits, key_filter, with_seen

WINDOW = 20


def block_words(window: int) -> int:
    """The longest block of which each window holds a whole one, wherever the window starts."""
    return max(1, (window + 1) // 2)


def _all_words(run: pa.RecordBatch, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words of a run, number of words of each document)."""
    parts = [known.of(spaced_words(x)) for x in run.column("text").to_pylist()]
    return np.concatenate(parts), np.array([len(x) for x in parts])


def _probes(docs: DataFrame, window: int, buckets: int) -> DataFrame:
    block = block_words(window)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for run in runs(batches):
            words, sizes = _all_words(run, known)
            hashes = windows(words, block)
            ends = np.repeat(np.cumsum(sizes), sizes)[:len(hashes)]
            at = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            whole = (np.arange(len(hashes)) + block <= ends) & (np.repeat(sizes, sizes)[:len(hashes)] >= window)
            places = np.flatnonzero(whole)
            if len(places):
                hashes, flags = hashes[places], at[places] % block == 0
                first, again = once(hashes >> np.uint64(1))
                value, of = np.unique(hashes[first] >> np.uint64(1), return_inverse=True)
                held = np.searchsorted(value, hashes[again] >> np.uint64(1))
                repeated = np.isin(of, held)
                indexed = np.zeros(len(value), bool)
                indexed[of[flags[first]]] = True
                indexed[held[flags[again]]] = True
                place = np.argsort(first, kind="stable")
                first, of = first[place], of[place]
                sure = np.sort(places[np.concatenate((again, first[repeated[place]]))])
                yield packed(run, sizes, hashes[first], places[first], buckets, 4,
                             flags=indexed[of], sure=sure)

    return docs.mapInArrow(made, _PACKED)


def _hits(hashes: np.ndarray, rows: list[dict]) -> np.ndarray:
    """Hashes found twice or more, one of them as an indexed block."""
    value, of, n = np.unique(hashes >> np.uint32(1), return_inverse=True, return_counts=True)
    indexed = np.zeros(len(value), bool)
    indexed[of[(hashes & np.uint32(1)) == 1]] = True
    return (indexed & (n >= 2))[of]


def _not_first(hashes: np.ndarray, rows: list[dict]) -> np.ndarray:
    """Windows whose value is also at an earlier place. Runs hold documents by ascending id and
    are ranked by their first, so that rank and place order all windows."""
    places = [places_of(r["places"]) for r in rows]
    ranks = np.repeat([r["rank"] for r in rows], [len(x) for x in places])
    order = np.lexsort((np.concatenate(places), ranks, hashes))
    found = np.zeros(len(hashes), bool)
    found[order[1:]] = hashes[order[1:]] == hashes[order[:-1]]
    return found


def _as_gaps(size: int, places: np.ndarray) -> bytes:
    return gaps(places)


def _starts(found: list[bytes], n: int, block: int, window: int) -> np.ndarray:
    """Starts of the windows that hold a hit."""
    marked = np.zeros(n + 1, dtype=np.int32)
    for data in found:
        places = places_of(data)
        places = places[places + block <= n]
        np.add.at(marked, np.maximum(places - (window - block), 0), 1)
        np.add.at(marked, places + 1, -1)
    return np.flatnonzero(np.cumsum(marked)[:max(0, n - window + 1)] > 0)


def _extended(held: DataFrame, window: int, buckets: int) -> DataFrame:
    block = block_words(window)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last = WordHashes(), None
        for run in runs(batches):
            keys = list(zip(run.column("id").to_pylist(), run.column("text_hash").to_pylist(), strict=True))
            fresh = [k != before for k, before in zip(keys, [last, *keys], strict=False)]
            last = keys[-1]
            run = run.filter(pa.array(fresh))  # a repeated row is the same document
            if not len(run):
                continue
            words, sizes = _all_words(run, known)
            hashes = windows(words, window)
            begin = np.cumsum(sizes) - sizes
            places = np.concatenate([np.zeros(0, np.int64)] + [
                begin[i] + _starts(x, int(sizes[i]), block, window)
                for i, x in enumerate(run.column("hits").to_pylist())])
            if len(places):
                first, again = once(hashes[places])
                first = np.sort(first)
                yield packed(run, sizes, hashes[places[first]], places[first], buckets, 8,
                             rank=run.column("id")[0].as_py(), sure=np.sort(places[again]))

    ordered = held.repartitionByRange("id").sortWithinPartitions("id", "text_hash")
    return ordered.mapInArrow(made, _PACKED)


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _split_by_hits(docs: DataFrame, window: int) -> DataFrame:
    """Results of documents without hits and of copies; texts and hits of the others.

    A copy of a whole text with a smaller id repeats all its windows.
    """

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            hits = run.column("hits").to_pylist()
            texts = run.column("text").to_pylist()
            out = []
            for text, found, copied in zip(texts, hits, run.column("copied").to_pylist(), strict=True):
                words = spaced_words(text)
                if copied and len(words) >= window:
                    out.append((len(words), len(words), _sha([]), "", None, None))
                elif copied or found is None:
                    out.append((len(words), 0, _sha(words), None, None, None))
                else:
                    out.append((len(words), 0, None, None, text, found))
            yield pa.RecordBatch.from_arrays(
                [run.column("id"), run.column("text_hash"), *(
                    pa.array(x, t) for x, t in zip(zip(*out, strict=True), (
                        pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
                        pa.list_(pa.binary())), strict=True))],
                ["id", "text_hash", "n_words", "n_removed", "kept_sha256", "kept", "text", "hits"])

    return docs.mapInArrow(judged, "id long, text_hash long, n_words long, n_removed long,"
                                   " kept_sha256 string, kept string, text string, hits array<binary>")


def _cut(rows: DataFrame, window: int) -> DataFrame:
    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            out = []
            for text, found in zip(run.column("text").to_pylist(), run.column("found").to_pylist(), strict=True):
                words = spaced_words(text)
                change = np.zeros(len(words) + 1, dtype=np.int32)
                for data in found or ():
                    starts = places_of(data)
                    np.add.at(change, starts, 1)
                    np.add.at(change, starts + window, -1)
                gone = np.cumsum(change)[:-1] > 0
                kept = [w for w, x in zip(words, gone.tolist(), strict=True) if not x]
                out.append((len(words), int(gone.sum()), _sha(kept), b" ".join(kept).decode("utf-8", "surrogatepass")))
            yield pa.RecordBatch.from_arrays(
                [run.column("id"), pa.array([x[0] for x in out], pa.int64()),
                 pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.string()),
                 pa.array([x[3] for x in out], pa.string())],
                ["id", "n_words", "n_removed", "kept_sha256", "kept"])

    return rows.mapInArrow(judged, "id long, n_words long, n_removed long, kept_sha256 string, kept string")


def _parted(source: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents that are not known for sure, those that may be): by a Bloom filter, so that the
    texts of the first need no shuffle. Where the filter is full, more go with the second."""
    key = F.xxhash64("id", "text_hash").alias("key")
    bits = filter_bits(known.count())
    seen = F.broadcast(written(key_filter(known.select(key), "key", bits)))
    judged = with_seen(source.select("*", key), "key", seen, bits)
    columns = ["id", "text_hash", "text"]
    return judged.where("NOT maybe_seen").select(*columns), judged.where("maybe_seen").select(*columns)


def gathered(found: DataFrame, name: str) -> DataFrame:
    """One row a document: the answers of all runs that hold it."""
    return found.groupBy("id", "text_hash").agg(F.collect_list("found").alias(name))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept) of each row of docs; kept is null where all stays.

    Every word goes that a window covers whose words also start earlier: in a document with a
    smaller id, or earlier in the same one. Ids are integers; a null id is smaller than all. Null
    or empty text has no words. Repeated rows are one document, and each gets its result; rows of
    one id with different texts are documents in the order of their hashes. Windows are equal if
    their 64-bit hashes are. Texts are read whole, however long; an empty table gives an empty one;
    other columns, whatever their names, are not read.
    """
    source = keyed(docs, id_col, text)
    buckets = bucket_count(source, "text", 6)
    rows = source.select("id", "text_hash", F.octet_length("text").alias("size"))
    first = rows.groupBy("text_hash", "size").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    copies = (rows.join(first.where("least < most"), ["text_hash", "size"]).where("id > least")
              .select("id", "text_hash").distinct().withColumn("copied", F.lit(True)))
    probed = answered(_probes(source, window, buckets), _hits, 4, _as_gaps)
    known = written(gathered(probed, "hits").join(copies, ["id", "text_hash"], "full"))
    whole, some = _parted(source, known)
    with_hits = some.join(known, ["id", "text_hash"], "left").withColumn(
        "copied", F.coalesce("copied", F.lit(False)))
    split = written(_split_by_hits(with_hits, window))
    held = split.where("text IS NOT NULL").select("id", "text_hash", "text", "hits")
    repeated = answered(_extended(held, window, buckets), _not_first, 8, _as_gaps)
    rows = held.select("id", "text_hash", "text").join(gathered(repeated, "found"), ["id", "text_hash"], "left")
    whole = whole.select("*", F.lit(None).cast("array<binary>").alias("hits"), F.lit(False).alias("copied"))
    done = _split_by_hits(whole, window).unionByName(split.where("text IS NULL"))
    done = done.select("id", "n_words", "n_removed", "kept_sha256", "kept")
    return done.unionByName(_cut(rows, window)).select(own_id(id_col), "n_words", "n_removed", "kept_sha256", "kept")
