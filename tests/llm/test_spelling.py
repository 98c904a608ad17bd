"""Spelling variants against brute force, and their parts."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import awkward, documents, nothing

from reviewloom.llm import queries, spelling


def counted(rows, letters=5, often=3):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= letters and k >= often}


def edits(w, alphabet):
    cut = [(w[:i], w[i:]) for i in range(len(w) + 1)]
    out = {a + b[1:] for a, b in cut if b} | {a + c + b for a, b in cut for c in alphabet}
    return (out | {a + c + b[1:] for a, b in cut if b for c in alphabet}) - {w}


def expected(rows):
    n = counted(rows)
    alphabet = sorted({c for w in n for c in w})
    form, near = {}, {}
    for w in n:
        near[w] = edits(w, alphabet) & n.keys()
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def texts(rng, n):
    stems = ["receive", "separate", "naïveté", "accommodate", "ÀÉÎtest", "abcde", "aaaaa", "stopping"]
    out = []
    for _ in range(n):
        some = []
        for _ in range(rng.randrange(40)):
            w = rng.choice(stems)
            for _ in range(rng.choice((0, 0, 0, 1, 1, 2, 3))):
                at = rng.randrange(len(w))
                w = rng.choice((w[:at] + w[at + 1:], w[:at] + "e" + w[at:], w[:at] + rng.choice("aeiß") + w[at + 1:])) or "a"
            some.append(w)
        out.append(rng.choice((" ", "-", ", 1")).join(some))
    return out


def test_variants_as_by_brute_force(spark):
    rows = list(enumerate(texts(random.Random(3), 300) + [None, "", "RECEIVE Receive receive"]))
    docs = documents(spark, [x for _, x in rows])
    want = expected(rows)
    assert len(want) > 150 and sum(r[1] is not None for r in want) > 50 and any(r[1] != r[2] for r in want if r[1])
    assert set(map(tuple, spelling.variants(docs).collect())) == want
    assert set(map(tuple, spelling.variants(docs, tile=7).collect())) == want  # blocks in tiles


def test_whole_given_table_as_by_brute_force(spark):
    data = "/root/testdata/sf0.001"
    got = queries.op13_spelling_variants(spark, data)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    assert set(map(tuple, got.collect())) == expected(rows)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert set(map(tuple, spelling.variants(docs).collect())) == expected(rows)
    assert spelling.variants(nothing(spark)).count() == 0


def test_long_texts_are_read_in_parts(spark, monkeypatch):
    text = "alpha beta-gamma Delta " * 50
    whole = spelling.words(documents(spark, [text])).collect()
    pattern = re.compile(spelling.RUN)
    parts = [w for some in spelling._runs_of(text, pattern) for w in some]
    monkeypatch.setattr(spelling, "_PART", 7)
    assert [w for some in spelling._runs_of(text, pattern) for w in some] == parts
    assert {r.word for r in whole} <= set(parts)


def edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    codes = spelling._code_table(pa.array([a, b]))
    good, _ = spelling.one_edit(codes[:1], codes[1:], np.array([len(b) > len(a)]))
    return len(b) - len(a) <= 1 and bool(good[0])


def test_near_words_share_a_block_and_are_close():
    rng = random.Random(5)
    for _ in range(300):
        a = "".join(rng.choice("abcdeßéxyz") for _ in range(rng.randrange(1, 9)))
        b = rng.choice(sorted(edits(a, "aeéq")))
        assert edit(a, b) and edit(b, a) and not edit(a, a)
        both = pa.array([a, b] if len(a) <= len(b) else [b, a])
        keys = spelling.block_keys(both)
        assert (keys[0] == keys[1]).any()
        lengths = np.array([len(x) for x in both.to_pylist()])
        assert spelling.close_pairs(spelling.letter_counts(both), lengths).tolist() == [[0, 1]]
    assert not edit("abcd", "abdc") and not edit("ab", "abcd") and not edit("abc", "bcad")


def test_stacked_blocks_give_the_pairs_of_single_ones():
    rng = random.Random(6)
    sizes = np.array([rng.choice((1, 2, 3, 5, 60)) for _ in range(40)])
    words, lengths = [], []
    for size in sizes.tolist():
        block = sorted(("".join(rng.choice("ab") for _ in range(rng.randrange(1, 6))) for _ in range(size)), key=len)
        words += block
        lengths += map(len, block)
    counts, lengths, starts = spelling.letter_counts(pa.array(words)), np.array(lengths), np.cumsum(sizes) - sizes
    got = {tuple(x) for x in spelling.pairs_of_blocks(counts, lengths, starts, sizes).tolist()}
    want = {(int(s + i), int(s + j)) for s, n in zip(starts, sizes, strict=True)
            for i, j in spelling.close_pairs(counts[s:s + n], lengths[s:s + n]).tolist()}
    assert got == want and len(want) > 100
