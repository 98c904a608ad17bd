"""Hashes of places in texts, dealt by value and answered by place.

A task packs the hashes of a run of documents into one row a bucket: hash and gap to the place
before. Rows of one bucket meet, whoever made them; a rule marks places; the marks go back to
their run and come out by document. A row carries thousands of hashes, so that the shuffle holds
a few bytes a place. The number of buckets grows with the input, so that a bucket stays small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents and bytes of a run; places of a bucket.
RUN_ROWS, RUN_BYTES, BUCKET = 2000, 6 << 20, 1 << 20
#: Stands for a null id: smaller than all others.
NO_ID = -(1 << 63)

_PACKED = ("bucket int, run long, rank long, ids array<long>, text_hashes array<long>, sizes binary,"
           " sure binary, hashes binary, places binary")
_MARKED = "run long, ids array<long>, text_hashes array<long>, sizes binary, sure binary, places binary"


def gaps(places: np.ndarray) -> bytes:
    """Ascending places as gaps, of a byte or two each; a full unit means that the gap goes on."""
    if not len(places):
        return b""
    gap = np.diff(places, prepend=-1).astype(np.int64)
    kind = np.dtype("u1") if places[-1] < 100 * len(places) else np.dtype("<u2")
    full = 255 if kind.itemsize == 1 else 65535
    times, rest = np.divmod(gap, full)
    units = np.full(int(times.sum()) + len(gap), full, dtype=kind)
    units[np.cumsum(times + 1) - 1] = rest
    return bytes([kind.itemsize]) + units.tobytes()


def places_of(data: bytes | None) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype=np.int64)
    kind, full = (np.dtype("u1"), 255) if data[0] == 1 else (np.dtype("<u2"), 65535)
    units = np.frombuffer(data, kind, offset=1)
    return np.cumsum(units, dtype=np.int64)[units != full] - 1


def keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, text_hash, text) with a stand-in for a null id; empty text for null."""
    held = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
                       F.xxhash64(held).alias("text_hash"), held.alias("text"))


def own_id(id_col: str):
    return F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col)


def runs(batches: Iterator[pa.RecordBatch], most: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of bounded rows and, but for single longer texts, bytes; the text column is `text`."""
    for batch in batches:
        length = pa.compute.binary_length(batch.column(batch.schema.get_field_index("text")))
        total = np.cumsum(length.to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = total[start - 1] if start else 0
            end = int(np.searchsorted(total, done + most)) + 1
            end = min(max(end, start + 1), start + RUN_ROWS, batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def packed(run: pa.RecordBatch, sizes: np.ndarray, hashes: np.ndarray, places: np.ndarray,
           buckets: int, width: int, flags: np.ndarray | None = None, rank: int = 0,
           sure: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows for the buckets of a run. sizes: places of each document in order; hashes at ascending
    places. width: bytes of a hash; with flags, its lowest bit. sure: places marked already, so
    that of a hash with many places in a run one goes to its bucket. The run's documents and sure
    places are in its first row alone, so that a row's cost doesn't grow with the run. rank: by
    which a rule can order runs; it is in every row."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket.astype(np.uint16 if buckets <= 65536 else np.int64), kind="stable")
    kept = hashes if width == 8 else hashes.astype(np.uint32)
    if flags is not None:
        kept = (kept & ~kept.dtype.type(1)) | flags.astype(kept.dtype)
    kept, places, bucket = kept[order], places[order], bucket[order]
    starts = np.flatnonzero(np.diff(bucket, prepend=-1)) if len(bucket) else np.zeros(0, int)
    ends = np.append(starts[1:], len(bucket)) if len(starts) else starts
    ids, texts = run.column("id"), run.column("text_hash")
    about = [ids.to_pylist(), texts.to_pylist(), sizes.astype("<i4").tobytes()]
    key = xxhash.xxh3_64_intdigest(np.array(about[0] + about[1], dtype="<i8").tobytes()) - (1 << 63)
    n = len(starts)
    told = [x if i == 0 else None for x in about for i in range(n)]
    decided = [gaps(sure) if i == 0 and sure is not None else None for i in range(n)]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[starts], pa.int32()), pa.array([key] * n, pa.int64()), pa.array([rank] * n, pa.int64()),
         pa.array(told[:n], pa.list_(pa.int64())), pa.array(told[n:2 * n], pa.list_(pa.int64())),
         pa.array(told[2 * n:], pa.binary()), pa.array(decided, pa.binary()),
         pa.array([kept[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
         pa.array([gaps(places[a:b]) for a, b in zip(starts, ends, strict=True)], pa.binary())],
        ["bucket", "run", "rank", "ids", "text_hashes", "sizes", "sure", "hashes", "places"])


def once(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, again): where a hash comes first, and where it came before."""
    by = np.argsort(hashes, kind="stable")
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[by][1:] == hashes[by][:-1]
    return by[~again], by[again]


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Rows of one key after another; only one key's rows are held."""
    rows: list[dict] = []
    for batch in batches:
        for at in range(0, batch.num_rows, 32):
            for row in batch.slice(at, 32).to_pylist():
                if rows and rows[0][key] != row[key]:
                    yield rows
                    rows = []
                rows.append(row)
    if rows:
        yield rows


def answered(rows: DataFrame, rule: Callable[[np.ndarray, list[dict]], np.ndarray], width: int,
             answer: Callable[[int, np.ndarray], bytes]) -> DataFrame:
    """(id, text_hash, found): answer(size, places) of each document with marked places.

    rule gets all hashes of a bucket and its rows, and returns which hashes are marked.
    """
    kind = np.dtype("<u8") if width == 8 else np.dtype("<u4")

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, "bucket"):
            parts = [np.frombuffer(r["hashes"], kind) for r in group]
            marks = np.split(rule(np.concatenate(parts), group), np.cumsum([len(x) for x in parts])[:-1])
            out = [(r["run"], r["ids"], r["text_hashes"], r["sizes"], r["sure"], gaps(places_of(r["places"])[m]))
                   for r, m in zip(group, marks, strict=True) if m.any() or r["ids"] is not None]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (
                        pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(),
                        pa.binary()), strict=True)], ["run", "ids", "text_hashes", "sizes", "sure", "places"])

    def returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, "run"):
            about = next(r for r in group if r["ids"] is not None)
            ends = np.cumsum(np.frombuffer(about["sizes"], "<i4"), dtype=np.int64)
            places = np.unique(np.concatenate(
                [places_of(r[x]) for r in group for x in ("places", "sure")]))
            of = np.searchsorted(ends, places, side="right")
            out = []
            for doc in np.unique(of).tolist():
                start = int(ends[doc - 1]) if doc else 0
                low, high = np.searchsorted(of, (doc, doc + 1))
                found = answer(int(ends[doc]) - start, places[low:high] - start)
                if found:
                    out.append((about["ids"][doc], about["text_hashes"][doc], found))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (
                        pa.int64(), pa.int64(), pa.binary()), strict=True)], ["id", "text_hash", "found"])

    by_bucket = rows.repartition("bucket").sortWithinPartitions("bucket")
    by_run = by_bucket.mapInArrow(marked, _MARKED).repartition("run").sortWithinPartitions("run")
    return by_run.mapInArrow(returned, "id long, text_hash long, found binary")


def bucket_count(docs: DataFrame, text: str, bytes_a_place: float) -> int:
    """Buckets so that one holds about BUCKET places, if a place comes every so many bytes."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, min(1 << 22, round(total / bytes_a_place / BUCKET) + 1))
