"""Tokens against the tokenizer, and packing against its bounds."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward, documents, nothing, sentence
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ids():
    with open(PATH, encoding="utf-8") as file:
        return packing.Ids(file.read())


def plain_ids(ids, texts):
    return [e.ids for e in ids.tokenizer.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(
    " \n\t\r\x1c\u00a0\u2028aAzé.,'s9²ǅŀ中ـ😀<|endoftext|>"), max_size=40), max_size=8))
def test_ids_are_the_tokenizers(ids, texts):
    assert [np.frombuffer(x, "<u4").tolist() for x in ids.of(texts)] == plain_ids(ids, texts)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(ids, text):
    assert np.frombuffer(ids.of([text])[0], "<u4").tolist() == plain_ids(ids, [text])[0]


def test_words_are_forgotten_when_there_are_many(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    with open(PATH, encoding="utf-8") as file:
        ids = packing.Ids(file.read())
    texts = ["a b c d e", "f g, h i", "a b"]
    assert [np.frombuffer(x, "<u4").tolist() for x in ids.of(texts)] == plain_ids(ids, texts)


def test_cuts():
    assert packing.cut(1) == [(0, 1)]
    assert packing.cut(2048) == [(0, 2048)]
    assert packing.cut(5000) == [(0, 904), (904, 2048), (2952, 2048)]


def test_few_sequences():
    rng = np.random.default_rng(3)
    lengths = np.minimum(2048, rng.lognormal(5.5, 1.2, 6000).astype(int) + 1)
    sequence, offset = packing.place(lengths)
    filled = np.bincount(sequence, weights=lengths)
    assert filled.max() <= 2048 and len(filled) <= -(-lengths.sum() // 2048) * 1.01
    for s in range(0, len(filled), 97):
        mine = np.flatnonzero(sequence == s)
        mine = mine[np.argsort(offset[mine])]
        assert (offset[mine] == np.cumsum(lengths[mine]) - lengths[mine]).all()


def test_pieces_give_the_documents_back(spark, ids):
    rng = random.Random(8)
    texts = [sentence(rng, n) for n in (0, 1, 30, 900, 2500)] + [None, ""]
    rows = packing.pack(documents(spark, texts), PATH, shard_rows=3).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(texts):
        whole = plain_ids(ids, [text or ""])[0] + [0]
        at = 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == 2048)
            part = np.array(whole[at:at + r.length], dtype="<u4")
            assert zlib.crc32(part.tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(whole)
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    for (s, o, n), (t, p, _) in zip(places, places[1:]):
        assert p == (o + n if s == t else 0)


def test_awkward_rows(spark):
    rows = packing.pack(awkward(spark), PATH).collect()
    assert {r.doc_id for r in rows} == {None, *range(1, 10)}
    assert len([r for r in rows if r.doc_id == 7]) == 2
    assert packing.pack(nothing(spark), PATH).count() == 0


def test_words_in_use_are_not_forgotten(monkeypatch):
    """So that few words need to be held: a worker keeps them while it does other stages."""
    with open(PATH, encoding="utf-8") as file:
        own = packing.Ids(file.read())
    learnt, plain = [], own._plain
    monkeypatch.setattr(own, "_plain", lambda words, *more: learnt.append(sorted(words)) or plain(words, *more))
    monkeypatch.setattr(packing, "REMEMBERED", 4)
    own.of(["x one two three"])
    own.of(["x one two four five"])
    assert learnt[-1] == ["five", "four"] and sorted(own.known) == ["five", "four", "one", "two"]
    own.of(["x " + " ".join(f"w{i}" for i in range(9))])
    assert len(own.known) == 9 and plain_ids(own, ["x one two"])[0] == np.frombuffer(own.of(["x one two"])[0], "<u4").tolist()


def test_a_task_leaves_few_words_in_its_worker(spark):
    """Words that a worker still held while it did other stages took more memory than those stages."""
    texts = [f"the same {i} " + " ".join(f"w{i}x{j}" for j in range(50)) for i in range(3_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.tokenized(docs, path).count() == 3_000

    def held(batches):
        import sys

        import pyarrow as pa
        for _ in batches:
            pass
        made = sys.__dict__.get("_llm_ids", {})
        yield pa.RecordBatch.from_arrays(
            [pa.array([len(x.known) + len(x.others) for x in made.values()], pa.int64())], ["words"])

    left = [x for x, in spark.range(200, numPartitions=20).mapInArrow(held, "words long").collect()]
    assert left and max(left) < 1_000


def test_ids_after_words_were_forgotten(ids):
    own = packing.Ids(open(public_tokenizers.path("byte_bpe_50k.json")).read())
    own.forget()
    assert own.known == {}
    texts = ["a one two", "b  two\nthree ", "", "one"]
    first = own.of(texts)
    own.of(["x two four", "y three"])
    own.forget()
    assert sorted(own.known) == ["two"] and own.others == {}
    assert own.of(texts) == first and plain_ids(ids, texts) == [np.frombuffer(x, "<u4").tolist() for x in first]
