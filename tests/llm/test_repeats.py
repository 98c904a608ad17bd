"""Substring and byte-string dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, documents, nothing, sentence

from reviewloom.llm import exchange, substring, suffix
from reviewloom.llm.hashing import spaced_words, windows


def texts_with_repeats(seed: int, passage: int) -> list[str]:
    rng = random.Random(seed)
    shared = [sentence(rng, passage) for _ in range(4)]
    found = []
    for _ in range(60):
        parts = [sentence(rng, rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 4)):
            words = rng.choice(shared).split()
            a, b = sorted(rng.sample(range(len(words) + 1), 2))
            parts += [" ".join(words[a:b]), sentence(rng, rng.randrange(0, 15))]
        found.append(rng.choice([" ", "\n", "\t"]).join(parts))
    return found + [found[3], found[3], found[7], "go " * 90, "", "a\x1fb c\u2028d " * 12]


def words_removed(texts: list[str], size: int) -> dict[int, tuple]:
    seen, found = set(), {}
    for i, text in enumerate(texts):
        words = spaced_words(text)
        gone = [False] * len(words)
        for s in range(len(words) - size + 1):
            window = tuple(words[s:s + size])
            if window in seen:
                gone[s:s + size] = [True] * size
            seen.add(window)
        kept = [w for w, g in zip(words, gone) if not g]
        found[i] = (len(words), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return found


@pytest.mark.parametrize("size", [20, 7])
def test_words_as_by_brute_force(spark, size):
    texts = texts_with_repeats(1, 70)
    docs = documents(spark, texts)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in substring.remove_repeats(docs, window=size).collect()}
    assert got == words_removed(texts, size)


def test_kept_text_of_words(spark):
    repeated = sentence(random.Random(2), 30)
    rows = substring.remove_repeats(documents(spark, [repeated, f"own {repeated} end"])).collect()
    assert {r.doc_id: (r.kept, r.n_removed) for r in rows} == {0: (repeated, 0), 1: ("own end", 30)}


def bytes_removed(texts: list[str], size: int) -> dict[int, tuple]:
    data = [x.encode() for x in texts]
    n = Counter(x[s:s + size] for x in data for s in range(len(x) - size + 1))
    found = {}
    for i, x in enumerate(data):
        gone = bytearray(len(x))
        for s in range(len(x) - size + 1):
            if n[x[s:s + size]] > 1:
                gone[s:s + size] = b"\1" * size
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        found[i] = (len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return found


@pytest.mark.parametrize(("size", "anchor", "most"), [(400, 100, 4000), (60, 16, 4000), (60, 16, 1)])
def test_bytes_as_by_brute_force(spark, monkeypatch, size, anchor, most):
    monkeypatch.setattr(suffix, "MOST", most)
    texts = texts_with_repeats(3, 130)
    docs = documents(spark, texts)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix.remove_repeats(docs, window=size, anchor=anchor).collect()}
    assert got == bytes_removed(texts, size)


def test_anchors_do_not_depend_on_the_tiles(monkeypatch):
    rng = random.Random(4)
    texts = [sentence(rng, n).encode() for n in (5, 400, 0, 900, 60)]
    whole = suffix.anchors([texts[3]], 60, 16)
    monkeypatch.setattr(suffix, "TILE", 1500)
    cut = suffix.anchors([texts[3]], 60, 16)
    starts = lambda found: {(s, a) for f, l, a, _ in zip(*found) for s in range(f, l + 1)}
    assert {(s, whole[3][i]) for i in range(len(whole[0])) for s in range(whole[0][i], whole[1][i] + 1)} == \
        {(s, cut[3][i]) for i in range(len(cut[0])) for s in range(cut[0][i], cut[1][i] + 1)}
    assert starts(whole) == starts(cut)


def test_columns_find_repeats_of_lined_up_pieces():
    found = suffix.repeated_columns(
        [b"xxabcdef", b"yabcdeg", b"zzzabcd"], np.array([2, 1, 3]), np.array([0, 0, 0]), 4)
    # column 3 is the anchor: abcd is in all three, bcde in the first two
    assert found[3].tolist() == [True, True, True]
    assert not found[:3].any()
    apart = suffix.repeated_columns([b"abcd", b"abcd"], np.array([0, 0]), np.array([0, 1]), 4)
    assert not apart.any()


def test_gaps_come_back():
    rng = random.Random(6)
    for top in (10, 5_000, 3_000_000):
        places = np.array(sorted(rng.sample(range(top), min(top, 800))))
        assert (exchange.places_of(exchange.gaps(places)) == places).all()
    assert len(exchange.places_of(exchange.gaps(np.zeros(0, int)))) == 0


def test_window_hashes_are_equal_for_equal_windows():
    values = np.array([1, 2, 3, 4, 5, 1, 2, 3, 4, 5], dtype=np.uint64)
    for size in (1, 2, 3, 5):
        found = windows(values, size)
        assert len(found) == 11 - size and found[0] == found[5]
        assert len(set(found.tolist())) == min(11 - size, 5)
    assert len(windows(values, 11)) == 0


@pytest.mark.parametrize("operator", [substring.remove_repeats, suffix.remove_repeats])
def test_awkward_rows(spark, operator):
    rows = operator(awkward(spark)).collect()
    assert len(rows) == 13
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(by_id[None]) == 2 and len(by_id[7]) == 2 and len(by_id[8]) == 2
    empty = hashlib.sha256(b"").hexdigest()
    assert by_id[1][0].kept_sha256 == by_id[2][0].kept_sha256 == empty
    assert by_id[7][0].kept_sha256 == by_id[7][1].kept_sha256
    assert by_id[6][0].n_removed > 10_000  # the second copy of the long text
    assert operator(nothing(spark)).count() == 0


def test_texts_without_repeats_stay_where_they_are(spark, monkeypatch):
    """Only what may hold a hit is joined with its hits, and written with its text."""
    rng = random.Random(9)
    shared = " ".join(f"common{i}" for i in range(30))
    texts = [" ".join(f"own{i}of{n}" for i in range(rng.randrange(20, 60))) for n in range(300)]
    texts += [f"before {shared}", f"{shared} after", texts[4]]
    sizes, written = [], substring.written

    def counted(df):
        table = written(df)
        if "text" in table.columns:
            sizes.append(table.count())
        return table

    monkeypatch.setattr(substring, "written", counted)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in substring.remove_repeats(documents(spark, texts)).collect()}
    assert got == words_removed(texts, 20)
    assert sizes and sum(sizes) < 40
