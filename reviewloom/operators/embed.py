"""Text to vectors."""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions import text

# Fixed values.
WIDTH = 384
MODEL_BATCH = 64

# Folders of a vector table that is laid out by id, and the column that names them.
SHARDS, SHARD = 64, "shard"

# Rows split into tokens at a time, and tokens whose dimension a task remembers. New tokens never end
# in a growing text, so the second number is memory of every worker.
_HASH_ROWS = 512
_KNOWN_TOKENS = 1 << 16
_TOKEN_BYTES = bytes(
    byte if chr(byte) in string.ascii_lowercase + string.digits else 0x20 for byte in range(256)
)

# Called once per task; returns a function from a list of texts to as many vectors.
ModelFactory = Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]]


def with_embed_text(reviews: DataFrame, out_col: str = "embed_text") -> DataFrame:
    return reviews.withColumn(
        out_col, text.embed_text(F.col("review_title"), F.col("review_text"))
    )


def vector_rows(embedded: DataFrame) -> DataFrame:
    """The vector table: id, vector, document and metadata, with nulls defaulted."""
    return embedded.select(
        F.col("review_id").cast("string").alias("review_id"),
        "embedding",
        F.coalesce("review_text", F.lit("")).alias("document"),
        "product_id",
        F.coalesce("rating", F.lit(0)).alias("rating"),
        F.coalesce("review_title", F.lit("")).alias("review_title"),
    )


def with_shard(rows: DataFrame, id_col: str = "review_id") -> DataFrame:
    """Add the shard of each id. A table written with ``partition_by=[SHARD]`` lets a reader of a
    few ids leave most folders alone."""
    shard = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(SHARDS)).cast("int")
    return rows.withColumn(SHARD, shard)


def hashed_embeddings(
    df: DataFrame,
    text_col: str = "embed_text",
    out_col: str = "embedding",
    width: int = WIDTH,
    unit: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Token counts hashed into ``width`` dimensions; no model needed.

    A token is a run of ASCII letters and digits of the lower-cased text; its dimension
    is the first 32 bits of its MD5 modulo ``width``. Each row is done where it lies:
    nothing is exploded or shuffled. Arrow splits the texts and numbers the distinct
    tokens of a batch, so that only those are hashed; built-in functions hash every token
    and took several times as long (README, "Measured"). The vectors are lexical: they do
    not stand in for a sentence model. ``unit`` divides by the length, which cosine search
    does anyway; counts are whole numbers and their products exact. ``tasks`` deals the rows
    to so many tasks first.
    """

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        dimensions = _Dimensions(width)
        for texts in batches:
            parts = [
                _count_tokens(texts[at:at + _HASH_ROWS], dimensions)
                for at in range(0, len(texts), _HASH_ROWS)
            ]
            if unit:
                parts = [_unit(part) for part in parts]
            yield list_array(np.concatenate(parts) if parts else np.zeros((0, width), np.float32))

    lowered = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    return _dealt(df, tasks).withColumn(out_col, count(lowered))


def _dealt(df: DataFrame, tasks: int | None) -> DataFrame:
    """Rows in so many tasks, whatever Spark would make of their bytes: a model's time goes by
    rows. A number given this way is not changed at run time."""
    return df if tasks is None else df.repartition(tasks)


class _Dimensions(dict):
    """Token -> dimension, hashing each token once; the empty token is in none."""

    def __init__(self, width: int) -> None:
        self.width = width

    def __missing__(self, token: bytes) -> int:
        if len(self) >= _KNOWN_TOKENS:
            self.clear()
        digest = hashlib.md5(token, usedforsecurity=False).digest()
        self[token] = int.from_bytes(digest[:4], "big") % self.width if token else -1
        return self[token]


def _blank_out(texts: pa.Array) -> pa.Array:
    """The texts with every byte that is in no token made a space, all in one pass."""
    texts = texts.cast(pa.string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    kept = bytes(memoryview(data)[ends[0]:ends[-1]] if data else b"").translate(_TOKEN_BYTES)
    return pa.StringArray.from_buffers(
        len(texts), pa.py_buffer(ends - ends[0]), pa.py_buffer(kept))


def _count_tokens(texts: pa.Array, dimensions: _Dimensions) -> np.ndarray:
    """Token counts, one row per text and one column per dimension."""
    width = dimensions.width
    tokens = pc.ascii_split_whitespace(_blank_out(texts))
    numbered = tokens.flatten().dictionary_encode()
    distinct = numbered.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    dims = np.fromiter(map(dimensions.__getitem__, distinct), np.int64, len(distinct))
    dim = dims[numbered.indices.to_numpy()]
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(tokens).to_numpy())
    cell = (row * width + dim)[dim >= 0]
    counts = np.bincount(cell, minlength=len(texts) * width)
    return counts.reshape(len(texts), width).astype(np.float32)


def _unit(counts: np.ndarray) -> np.ndarray:
    wide = counts.astype(np.float64)
    lengths = np.sqrt((wide * wide).sum(axis=1, keepdims=True))
    return np.divide(wide, lengths, out=wide, where=lengths > 0).astype(np.float32)


def list_array(matrix: np.ndarray) -> pa.Array:
    """A float32 matrix as a column of float lists."""
    rows, width = matrix.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * width
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.array(matrix.ravel(), pa.float32()))


def dimension_rows(embedded: DataFrame, key: str, column: str = "embedding") -> DataFrame:
    """The non-zero elements of each vector as (key, dim, weight).

    The outer form, because for the plain one Spark adds a filter on the array's size and
    with it a second evaluation of the function that makes the array.
    """
    elements = F.posexplode_outer(column).alias("dim", "weight")
    return embedded.select(key, elements).filter("weight <> 0")


def embed_with(
    df: DataFrame,
    factory: ModelFactory,
    text_col: str = "embed_text",
    out_col: str = "embedding",
    batch_size: int = MODEL_BATCH,
    tasks: int | None = None,
) -> DataFrame:
    """Vectors from a caller's model, loaded once per task and fed ``batch_size`` texts.

    ``tasks`` deals the rows to so many tasks first. Vectors of a task have to be equally long.
    Marked as not deterministic, so that no optimizer rule runs the model twice for a row.
    """

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = factory()
        width = None
        for batch in batches:
            rows: list[np.ndarray] = []
            for start in range(0, len(batch), batch_size):
                part = batch.slice(start, batch_size).to_pylist()
                got = [np.asarray(vector, dtype=np.float32) for vector in model(part)]
                if len(got) != len(part):
                    raise ValueError(f"model returned {len(got)} vectors for {len(part)} texts")
                width = width if width is not None or not got else len(got[0])
                if any(len(vector) != width for vector in got):
                    raise ValueError(f"model returned vectors that are not {width} wide")
                rows += got
            yield pa.array(rows, pa.list_(pa.float32()))

    model_text = F.coalesce(F.col(text_col), F.lit(""))
    return _dealt(df, tasks).withColumn(out_col, encode.asNondeterministic()(model_text))
