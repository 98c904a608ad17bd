"""Sum-of-squares packing of documents into sequences of a fixed number of tokens.

Tasks turn texts into tokens and pieces; pieces are dealt to shards of bounded size, and each
shard packs its own. A piece goes where the sum over all gaps of the squared number of open
sequences with that gap becomes smallest, which keeps gaps of every size at hand.
"""

from __future__ import annotations

import json
import pickle
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQUENCE = 2048
END = 0
SHARD_ROWS = 50_000
#: Words whose ids a task remembers; when there are more, all but those of the texts at hand are
#: forgotten. Of these the worker takes the ones it had met before into its next task.
REMEMBERED = 900_000
#: Text is cut at a space before something else than white space: no token spans such a place,
#: as the tokenizer's own pattern takes at most one space before a word, and cuts there too.
_CUT = re.compile(r"(?= (?=\S))")
_OTHER_SPACE = re.compile(r" (?:\s|\Z)")
#: A word of letters, which that pattern takes whole, and one mark, which it takes by itself.
_PLAIN = re.compile("( ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u02AF]+)([.,]?)")


def _ranks(vocabulary: str) -> dict[bytes, int]:
    """The merge ranks of a byte-level vocabulary: a token's id, by the bytes it stands for.

    Such vocabularies write printable bytes as themselves and the others as U+0100 and on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    read = json.loads(vocabulary)
    special = {x["content"] for x in read.get("added_tokens", [])}
    return {bytes(byte_of[c] for c in token): i
            for token, i in read["model"]["vocab"].items() if token not in special}


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit bytes; remembers words.

    Words of plain letters go straight to the merges by rank, all others through the tokenizer.
    """

    def __init__(self, vocabulary: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = True
        ranks = _ranks(vocabulary)
        merged = tiktoken.Encoding("words", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
        self.merge = merged._core_bpe.encode_single_piece
        self.marks = {m: np.array([ranks[m.encode()]] if m else [], "<u4").tobytes() for m in (",", ".", "")}
        self.known: dict[str, bytes] = {}  # words after a space, without it
        self.others: dict[str, bytes] = {}  # parts as they stand
        self.again: set[str] = set()  # words of the last texts that were known before them

    def _plain(self, words: set[str], space: str, known: dict[str, bytes]) -> list[str]:
        """Learns plain words; returns the others."""
        rest = []
        for word in words:
            match = _PLAIN.fullmatch(space + word)
            if match:
                ids = array("I", self.merge(match[1].encode()))
                known[word] = ids.tobytes() + self.marks[match[2]]
            else:
                rest.append(word)
        return rest

    def _learn(self, words: set[str], space: str, known: dict[str, bytes]) -> None:
        missing = words.difference(known)
        if len(known) + len(missing) > REMEMBERED:
            used = {x: known[x] for x in words.difference(missing)}
            known.clear()
            known.update(used)
        rest = self._plain(missing, space, known)
        for at in range(0, len(rest), 20_000):
            some = rest[at:at + 20_000]
            encoded = self.tokenizer.encode_batch([space + x for x in some], add_special_tokens=False)
            known.update(zip(some, (np.array(e.ids, dtype="<u4").tobytes() for e in encoded), strict=True))

    def of(self, texts: list[str]) -> list[bytes]:
        firsts, spaced = [], []
        for text in texts:
            if _OTHER_SPACE.search(text):
                first, *more = _CUT.split(text)
                more = [x[1:] for x in more]
            else:
                first, *more = text.split(" ")
            firsts.append(first)
            spaced.append(more)
        self._learn(set(firsts), "", self.others)
        words = set().union(*spaced)
        self.again = words.intersection(self.known)
        self._learn(words, " ", self.known)
        get = self.known.__getitem__
        return [self.others[a] + b"".join(map(get, more)) for a, more in zip(firsts, spaced, strict=True)]

    def forget(self) -> None:
        """Leaves the words of the last texts that were known before them, as copies, so that the memory
        around them is free for the other stages of a worker."""
        kept = pickle.dumps({x: self.known[x] for x in self.again})
        self.known, self.others, self.again = {}, {}, set()
        self.known = pickle.loads(kept)


def worker_ids(key: str, vocabulary: str) -> Ids:
    """One Ids for all tasks of a Python worker process."""
    made = sys.__dict__.setdefault("_llm_ids", {})
    if key not in made:
        made.clear()
        made[key] = Ids(vocabulary)
    return made[key]


def cut(n_tokens: int, most: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of each piece: all of full length, but the first may be shorter."""
    first = n_tokens % most or most
    return [(0, first)] + [(at, most) for at in range(first, n_tokens, most)]


def tokenized(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text: str = "text",
              most: int = SEQUENCE) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of each piece of each row's text.

    The driver reads the vocabulary file and sends it along, so executors need no copy.
    """
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())
    key = f"{vocabulary_path}:{zlib.crc32(vocabulary.value.encode())}"
    end = END.to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = worker_ids(key, vocabulary.value)
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, 1000):
                    part = batch.slice(at, 1000)
                    rows: list[list] = [[], [], [], [], []]
                    texts = [x or "" for x in part.column(1).to_pylist()]
                    for row, data in enumerate(ids.of(texts)):
                        data = memoryview(data + end)
                        for k, (start, length) in enumerate(cut(len(data) // 4, most)):
                            crc = zlib.crc32(data[4 * start:4 * (start + length)])
                            for out, x in zip(rows, (row, k, start, length, crc), strict=True):
                                out.append(x)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()),
                         *(pa.array(x, pa.int64()) for x in rows[2:])],
                        ["id", "piece", "start", "length", "ids_crc32"])
        finally:
            ids.forget()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        pieces, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def place(lengths: np.ndarray, most: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, longest first; sequences are numbered from 0.

    Of two places as good, the one with the smaller gap. A new sequence is begun only where no
    open one has room, as fewest sequences are wanted.
    """
    sequence = np.zeros(len(lengths), dtype=np.int64)
    offset = np.zeros(len(lengths), dtype=np.int64)
    counts = np.zeros(most + 1, dtype=np.int64)  # open sequences by gap; a gap of 0 counts as none
    open_by_gap: list[list[int]] = [[] for _ in range(most + 1)]
    made = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        # the change of the sum of squares if the piece goes into a gap of `size` or more
        change = 2 * (counts[:most + 1 - size] - counts[size:] + 1)
        change[0] = 1 - 2 * counts[size]  # fills the gap
        change[counts[size:] == 0] = np.iinfo(np.int64).max
        best = int(np.argmin(change))
        if counts[size + best]:
            gap = size + best
            into = open_by_gap[gap].pop()
            counts[gap] -= 1
        else:
            gap, into = most, made
            made += 1
        sequence[i], offset[i] = into, most - gap
        if gap > size:
            open_by_gap[gap - size].append(into)
            counts[gap - size] += 1
    return sequence, offset


def pack(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text: str = "text",
         most: int = SEQUENCE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row.

    A null or empty text is the end token alone. Repeated rows and null ids are packed like
    others; an empty table gives none. Shards hold about shard_rows documents, dealt by hash. Whole
    texts are tokenized, however long, and cut into pieces only beyond `most` tokens. Of gaps that
    are equally good the smallest is filled, so ties don't depend on chance. Other columns,
    whatever their names, are not read.
    """
    shards = max(1, -(-docs.count() // shard_rows))
    pieces = tokenized(docs, vocabulary_path, id_col, text, most).withColumn(
        "shard", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(shards)).cast("int"))

    def packed(table: pa.Table) -> pa.Table:
        sequence, offset = place(table.column("length").to_numpy(), most)
        first = table.column("shard")[0].as_py() << 40
        return table.drop_columns(["shard"]).append_column(
            "sequence_id", pa.array(sequence + first)).append_column("offset", pa.array(offset))

    kind = pieces.schema["id"].dataType.simpleString()
    return pieces.groupBy("shard").applyInArrow(
        packed, f"id {kind}, piece int, start long, length long, ids_crc32 long,"
        " sequence_id long, offset long").withColumnRenamed("id", id_col)
