"""Repeats of long byte strings by column-wise construction over many documents at once.

Pieces of texts that may share a string are lined up at an anchor: the smallest hash of 100 bytes
in a window, which equal windows choose alike. A collection of lined-up pieces is then built
column by column from the right. Each round puts one byte before every piece: the order of the
pieces' suffixes is updated by a stable sort on the new byte (the collection's Burrows-Wheeler
step), and the common prefix of neighbours grows by one or falls to nothing. A suffix with a
neighbour of 400 common bytes starts a repeat. Collections are bounded, so that columns are read
one after another from an array where a larger collection would need a file.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import written
from reviewloom.llm.exchange import (
    _PACKED, answered, bucket_count, keyed, once, own_id, packed, runs,
)
from reviewloom.llm.hashing import mix, windows

WINDOW, ANCHOR = 400, 100
#: Bytes of a run and of a tile of a long text.
RUN, TILE = 1 << 20, 1 << 20
#: Different pieces of an anchor that are built together, and about as many of a collection.
MOST, COLLECTION = 4000, 2000
#: Hot anchors up to this many are joined by broadcast.
BROADCAST_ROWS = 100_000
_PAD = 255  # in no UTF-8 text
_LOW = np.uint64(21)
_TABLE = mix(np.arange(1, 257, dtype=np.uint64))
_FACTOR = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse modulo 2**64."""
    size = max(1 << 16, 1 << (n - 1).bit_length())
    if size not in _POWERS:
        inverse = pow(_FACTOR, -1, 1 << 64)
        both = []
        for factor in (_FACTOR, inverse):
            power = np.full(size, factor, dtype=np.uint64)
            power[0] = 1
            both.append(np.cumprod(power))
        _POWERS.clear()
        _POWERS[size] = (both[0], both[1])
    return tuple(x[:n] for x in _POWERS[size])


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every `size` bytes."""
    if len(data) < size:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(len(data))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * up)))
    return mix((total[size:] - total[:-size]) * down[:len(data) - size + 1])


def _sliding_least(x: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while 2 * width <= size:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[:len(x) - (size - width)], x[size - width:]) if size > width else x


def _anchored(data: np.ndarray, ends: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(first, last, at, hash): runs of window starts with one anchor, in texts that end at ends."""
    empty = np.zeros(0, dtype=np.int64)
    if len(data) < window:
        return empty, empty, empty, np.zeros(0, dtype=np.uint64)
    hashes = rolling(data, anchor)
    low = np.uint64((1 << int(_LOW)) - 1)
    keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    at = (_sliding_least(keys, window - anchor + 1) & low).astype(np.int64)
    starts = np.arange(len(at))
    end_of = np.repeat(ends, np.diff(ends, prepend=0))[:len(at)]
    inside = np.flatnonzero(starts + window <= end_of)
    if not len(inside):
        return empty, empty, empty, np.zeros(0, dtype=np.uint64)
    at, end_of = at[inside], end_of[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (at[1:] != at[:-1]) | (inside[1:] != inside[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(inside)) - 1
    return inside[first], inside[last], at[first], hashes[at[first]]


def anchors(texts: list[bytes], window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(first, last, at, hash) of all texts put together; a text's own places don't depend on others."""
    found = []
    base = 0
    some: list[bytes] = []

    def flush() -> None:
        nonlocal base, some
        if some:
            data = np.frombuffer(b"".join(some), dtype=np.uint8)
            first, last, at, value = _anchored(data, np.cumsum([len(x) for x in some]), window, anchor)
            found.append((first + base, last + base, at + base, value))
            base += len(data)
            some = []

    for text in texts:
        if sum(map(len, some)) + len(text) > TILE:
            flush()
        if len(text) <= TILE:
            some.append(text)
            continue
        for start in range(0, len(text), TILE):
            data = np.frombuffer(text[start:start + TILE + window - 1], dtype=np.uint8)
            first, last, at, value = _anchored(data, np.array([len(data)]), window, anchor)
            found.append((first + base + start, last + base + start, at + base + start, value))
        base += len(text)
    flush()
    if not found:
        found = [_anchored(np.zeros(0, np.uint8), np.zeros(0, int), window, anchor)]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _bytes_of(run: pa.RecordBatch) -> tuple[list[bytes], np.ndarray]:
    texts = [x.encode("utf-8", "surrogatepass") for x in run.column("text").to_pylist()]
    return texts, np.array([len(x) for x in texts], dtype=np.int64)


def _probes(docs: DataFrame, window: int, anchor: int, buckets: int) -> DataFrame:
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, RUN):
            texts, sizes = _bytes_of(run)
            first, _, _, value = anchors(texts, window, anchor)
            if len(first):
                one, again = once(value)
                repeated = np.concatenate((again, one[np.isin(value[one], value[again])]))
                one = np.sort(one)
                yield packed(run, sizes, value[one], first[one], buckets, 8, sure=np.sort(first[repeated]))

    return docs.mapInArrow(made, _PACKED)


def _twice(hashes: np.ndarray, rows: list[dict]) -> np.ndarray:
    _, of, n = np.unique(hashes, return_inverse=True, return_counts=True)
    return (n >= 2)[of]


def _as_bytes(size: int, places: np.ndarray) -> bytes:
    return places.astype("<i8").tobytes()


_PIECE = "anchor long, left int, piece binary, ids array<long>, text_hashes array<long>, starts array<long>"


def _pieces(held: DataFrame, window: int, anchor: int) -> DataFrame:
    """Pieces around hit anchors: all windows that chose it; equal ones of a run are one row.

    left: bytes before the anchor. ids, text_hashes, starts: the texts and places that hold it.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, RUN):
            texts, sizes = _bytes_of(run)
            begin = np.cumsum(sizes) - sizes
            first, last, at, value = anchors(texts, window, anchor)
            hits = run.column("hits").to_pylist()
            wanted = np.concatenate([np.zeros(0, np.int64)] + [
                begin[i] + np.frombuffer(data, "<i8") for i, found in enumerate(hits) for data in found])
            ids, hashes = run.column("id").to_pylist(), run.column("text_hash").to_pylist()
            rows: dict[tuple, list] = {}
            chosen = np.flatnonzero(np.isin(first, wanted))
            of = np.searchsorted(begin, first[chosen], side="right") - 1
            for k, doc in zip(chosen.tolist(), of.tolist(), strict=True):
                while sizes[doc] == 0:
                    doc -= 1
                start = int(first[k] - begin[doc])
                piece = texts[doc][start:int(last[k] - begin[doc]) + window]
                row = rows.setdefault((value[k], int(at[k] - first[k]), piece), ([], [], []))
                for out, x in zip(row, (ids[doc], hashes[doc], start), strict=True):
                    out.append(x)
            if rows:
                lists = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array([k[0] for k in rows], np.uint64).view(np.int64)),
                     pa.array([k[1] for k in rows], pa.int32()), pa.array([k[2] for k in rows], pa.binary()),
                     *(pa.array([r[i] for r in rows.values()], lists) for i in range(3))],
                    ["anchor", "left", "piece", "ids", "text_hashes", "starts"])

    return held.mapInArrow(made, _PIECE)


def _range_least(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(x[low..high]) for each pair, both ends included."""
    length = high - low + 1
    level = np.frexp(length)[1] - 1  # of the largest power of two within
    out = np.empty(len(low), dtype=x.dtype)
    table, width = x, 1
    for k in range(int(level.max(initial=-1)) + 1):
        here = level == k
        out[here] = np.minimum(table[low[here]], table[high[here] - width + 1])
        table = np.minimum(table[:-width], table[width:]) if len(table) > width else table
        width *= 2
    return out


def repeated_columns(pieces: list[bytes], lefts: np.ndarray, groups: np.ndarray, window: int) -> np.ndarray:
    """For each piece and column, whether the `window` bytes from there are in another piece.

    Pieces of one group are lined up so that lefts[i] bytes are before column 0; groups ascend.
    Column j of the result is place j - max(lefts) from the anchor.
    """
    n, left = len(pieces), int(lefts.max())
    right = max(len(p) - int(k) for p, k in zip(pieces, lefts, strict=True))
    columns = np.full((left + right, n), _PAD, dtype=np.uint8)
    for i, (p, k) in enumerate(zip(pieces, lefts.tolist(), strict=True)):
        columns[left - k:left - k + len(p), i] = np.frombuffer(p, np.uint8)
    order = np.arange(n)
    common = np.zeros(n, dtype=np.int32)  # of each piece's suffix with that of the one before
    other = np.ones(n, bool)
    other[1:] = groups[1:] != groups[:-1]
    base = groups.astype(np.int64) << 8
    found = np.zeros((left + 1, n), dtype=bool)
    for column in range(left + right - 1, -1, -1):
        byte = columns[column][order]
        keys = base + byte  # order keeps groups together, so base stands
        ordered = bool((keys[1:] >= keys[:-1]).all())
        if ordered:
            same = np.concatenate(([False], (keys[1:] == keys[:-1]) & (byte[1:] != _PAD)))
            common = np.where(same, common + 1, 0)
        else:
            by = np.argsort(keys, kind="stable")
            k, b = keys[by], byte[by]
            same = np.concatenate(([False], (k[1:] == k[:-1]) & (b[1:] != _PAD)))
            grown = np.zeros(n, dtype=np.int32)
            at = np.flatnonzero(same)
            grown[at] = _range_least(common, by[at - 1] + 1, by[at]) + 1
            common, order = grown, order[by]
        if column <= left:
            long = common >= window
            if long.any():
                either = long.copy()
                either[:-1] |= long[1:]
                found[column, order[either]] = True
    return found


_FOUND = "id long, text_hash long, found binary"


def _spans(flags: np.ndarray) -> np.ndarray:
    """(first, after last) of each run of true flags, as rows."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edges.reshape(-1, 2)


def _told(rows: list[dict], spans: list[np.ndarray]) -> pa.RecordBatch | None:
    out = []
    for row, span in zip(rows, spans, strict=True):
        if len(span):
            for one in zip(row["ids"], row["text_hashes"], row["starts"], strict=True):
                out.append((one[0], one[1], (span + one[2]).astype("<i8").tobytes()))
    if not out:
        return None
    return pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)],
        ["id", "text_hash", "found"])


def _built(pieces: DataFrame, window: int) -> DataFrame:
    """Starts of repeated windows, by column-wise construction; an anchor's pieces meet in a task."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []

        def collection() -> pa.RecordBatch | None:
            merged: dict[tuple, dict] = {}
            for r in rows:
                known = merged.setdefault((r["anchor"], r["left"], r["piece"]), r)
                if known is not r:
                    for name in ("ids", "text_hashes", "starts"):
                        known[name] += r[name]
            own = list(merged.values())
            n_of: dict[int, int] = {}
            for r in own:
                n_of[r["anchor"]] = n_of.get(r["anchor"], 0) + 1
            spans: list[np.ndarray] = [np.zeros((0, 2), dtype=np.int64)] * len(own)
            alone = [i for i, r in enumerate(own) if n_of[r["anchor"]] > 1]
            if alone:
                lefts = np.array([own[i]["left"] for i in alone])
                number = {a: k for k, a in enumerate(dict.fromkeys(own[i]["anchor"] for i in alone))}
                groups = np.array([number[own[i]["anchor"]] for i in alone])
                by = np.argsort(groups, kind="stable")
                found = repeated_columns([own[alone[i]]["piece"] for i in by], lefts[by], groups[by], window)
                top = int(lefts.max())
                for k, i in enumerate(by.tolist()):
                    row = own[alone[i]]
                    spans[alone[i]] = _spans(found[top - row["left"]:top + 1, k])
            for i, r in enumerate(own):
                if len(r["ids"]) > 1:
                    spans[i] = np.array([[0, len(r["piece"]) - window + 1]])
            return _told(own, spans)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if len(rows) >= COLLECTION and rows[-1]["anchor"] != row["anchor"]:
                        if (out := collection()) is not None:
                            yield out
                        rows = []
                    rows.append(row)
        if rows and (out := collection()) is not None:
            yield out

    return pieces.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(made, _FOUND)


def _by_value(pieces: DataFrame, window: int) -> DataFrame:
    """Starts of repeated windows of hot anchors: windows are compared by hash, in joins and sums
    that Spark can split, however many pieces an anchor has."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for r in batch.slice(at, 256).to_pylist():
                    values = windows(np.frombuffer(r["piece"], np.uint8).astype(np.uint64), window)
                    for k, x in enumerate(values.view(np.int64).tolist()):
                        yield_rows.append((x, k, len(r["ids"]), r["ids"], r["text_hashes"], r["starts"]))
                if yield_rows:
                    lists = pa.list_(pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*yield_rows, strict=True), (
                            pa.int64(), pa.int64(), pa.int64(), lists, lists, lists), strict=True)],
                        ["value", "at", "n", "ids", "text_hashes", "starts"])
                    yield_rows.clear()

    yield_rows: list[tuple] = []
    rows = pieces.mapInArrow(hashed, "value long, at long, n long, ids array<long>,"
                                     " text_hashes array<long>, starts array<long>")
    often = rows.groupBy("value").agg(F.sum("n").alias("all")).where("all > 1").select("value")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096).to_pylist()
                if (out := _told(some, [np.array([[r["at"], r["at"] + 1]]) for r in some])) is not None:
                    yield out

    return rows.join(often, "value", "left_semi").mapInArrow(told, _FOUND)


def _cut(rows: DataFrame, window: int) -> DataFrame:
    """Results from texts and the starts of their repeated windows, as rows of first and after last."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            out = []
            texts, _ = _bytes_of(run)
            for data, found, copies in zip(texts, run.column("found").to_pylist(),
                                           run.column("copied").to_pylist(), strict=True):
                if copies and len(data) >= window:
                    gone = np.ones(len(data), bool)
                else:
                    change = np.zeros(len(data) + 1, dtype=np.int32)
                    for x in found or ():
                        spans = np.frombuffer(x, "<i8").reshape(-1, 2)
                        np.add.at(change, spans[:, 0], 1)
                        np.add.at(change, spans[:, 1] - 1 + window, -1)
                    gone = np.cumsum(change)[:-1] > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out.append((len(data), int(gone.sum()), len(_spans(gone)), hashlib.sha256(kept).hexdigest(),
                            kept.decode("utf-8", "ignore")))
            yield pa.RecordBatch.from_arrays(
                [run.column("id"), run.column("text_hash"), *(pa.array(x, t) for x, t in zip(zip(*out, strict=True), (
                    pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True))],
                ["id", "text_hash", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return rows.mapInArrow(judged, "id long, text_hash long, n_bytes long, n_removed long, n_spans long,"
                                   " kept_sha256 string, kept string")


def _split(docs: DataFrame, whole: bool) -> DataFrame:
    """Results of texts without hits, and hits of the others; texts of those, or with whole of all."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            texts, sizes = _bytes_of(run)
            keep = pa.compute.or_(run.column("hits").is_valid(), run.column("copied")).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [run.column("id"), run.column("text_hash"), pa.array(sizes),
                 pa.array([None if k else hashlib.sha256(t).hexdigest()
                           for t, k in zip(texts, keep, strict=True)], pa.string()),
                 run.column("text") if whole else pa.array(
                     [t if k else None for t, k in zip(texts, keep, strict=True)], pa.binary()).cast(pa.string()),
                 run.column("hits"), run.column("copied")],
                ["id", "text_hash", "n_bytes", "kept_sha256", "text", "hits", "copied"])

    return docs.mapInArrow(judged, "id long, text_hash long, n_bytes long, kept_sha256 string, text string,"
                                   " hits array<binary>, copied boolean")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
                   anchor: int = ANCHOR, whole: bool = False) -> DataFrame:
    """(id, text_hash, n_bytes, n_removed, n_spans, kept_sha256, kept) of each row of docs.

    Every byte goes that a string of `window` bytes covers which also starts anywhere else, in
    the same text or another. The hash is of the other bytes; kept is their text, without what is
    left of cut characters, and null where all bytes stay, or with whole the text itself. Null counts as empty, and a null id is an id like others. Rows with equal
    texts hold all of each other, whatever their ids: from `window` bytes on, nothing of them
    stays. Ids are integers; other columns, whatever their names, are not read. Long texts are read
    in tiles; an empty table gives an empty one; ties don't arise, as all places of a repeat go.
    """
    source = keyed(docs, id_col, text)
    rows = source.select("id", "text_hash", F.octet_length("text").alias("size"))
    often = rows.where(F.col("size") >= window).groupBy("text_hash", "size").agg(
        F.count("*").alias("n"), F.min("id").alias("least")).where("n > 1")
    copies = rows.join(often, ["text_hash", "size"]).groupBy("id", "text_hash").agg(
        F.lit(True).alias("copied"))
    buckets = bucket_count(source, "text", 50)
    probed = answered(_probes(source, window, anchor, buckets), _twice, 8, _as_bytes)
    hits = probed.groupBy("id", "text_hash").agg(F.collect_list("found").alias("hits"))
    known = hits.join(copies, ["id", "text_hash"], "full")
    with_hits = source.join(known, ["id", "text_hash"], "left").withColumn(
        "copied", F.coalesce("copied", F.lit(False)))
    split = written(_split(with_hits, whole))
    held = split.where("hits IS NOT NULL").select("id", "text_hash", "text", "hits")
    # of equal texts one stands for all
    least = often.select("text_hash", F.col("least").alias("id"), F.lit(True).alias("stands"))
    one = held.join(least, ["id", "text_hash"], "left").join(
        split.where("copied").select("id", "text_hash").distinct().withColumn("copy", F.lit(True)),
        ["id", "text_hash"], "left").where("copy IS NULL OR stands").drop("copy", "stands")
    pieces = written(_pieces(one.dropDuplicates(["id", "text_hash"]), window, anchor))
    hot = written(pieces.groupBy("anchor").count().where(F.col("count") > MOST).select("anchor"))
    few = hot.count() <= BROADCAST_ROWS
    marks = F.broadcast(hot) if few else hot
    found = _built(pieces.join(marks, "anchor", "left_anti"), window)
    if not hot.isEmpty():
        found = found.unionByName(_by_value(pieces.join(marks, "anchor", "left_semi"), window))
    repeated = found.groupBy("id", "text_hash").agg(F.collect_list("found").alias("found"))
    texts = split.where("kept_sha256 IS NULL").select("id", "text_hash", "text", "copied")
    same = split.where("kept_sha256 IS NOT NULL").select(
        "id", "text_hash", "n_bytes", F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), "kept_sha256", F.col("text").alias("kept"))
    cut = _cut(texts.join(repeated, ["id", "text_hash"], "left"), window)
    return same.unionByName(cut).select(
        own_id(id_col), "text_hash", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
