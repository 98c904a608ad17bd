"""Near-duplicate groups against all pairs."""

import random

import numpy as np
import pytest
from helpers import awkward, documents, nothing, sentence

from reviewloom.llm import near_dup
from reviewloom.llm.graph import components
from reviewloom.llm.hashing import spaced_words


def family(rng: random.Random, n: int, size: int, edits: int) -> list[str]:
    base = sentence(rng, size).split()
    found = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        found.append(" ".join(words))
    return found


def corpus() -> list[str]:
    rng = random.Random(11)
    texts = []
    for n, size, edits in ((2, 60, 1), (5, 120, 4), (40, 150, 9), (3, 6, 1), (12, 400, 25)):
        texts += family(rng, n, size, edits)
    texts += [sentence(rng, rng.randrange(0, 80)) for _ in range(40)]
    texts += ["Two WORDS", "two words", "two\twords", "", "   ", texts[0], texts[0].upper().lower(), None]
    rng.shuffle(texts)
    return texts


def expected(texts: list[str | None]) -> dict[int, int]:
    sets = []
    for x in texts:
        w = spaced_words(x, lower=True)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: root(i) for i in range(len(sets))}


@pytest.mark.parametrize(("node", "block"), [(64, 256), (4, 8)])
def test_components_as_by_all_pairs(spark, node, block):
    texts = corpus()
    rows = near_dup.near_duplicates(documents(spark, texts), node=node, block=block).collect()
    assert {r.doc_id: r.component_id for r in rows} == expected(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_links_inside_a_large_node(spark):
    """Documents that share a passage, in near pairs: in a node too large for one comparison the pairs
    lie in different parts of it, and none may be lost."""
    rng = random.Random(3)
    shared = sentence(rng, 140).split()
    texts = []
    for _ in range(150):
        own = sentence(rng, 60).split()
        other = own[:52] + sentence(rng, 8).split()
        texts += [" ".join(shared + own), " ".join(shared + other)]
    rng.shuffle(texts)
    rows = near_dup.near_duplicates(documents(spark, texts), recall=0.9, depth=1, node=4).collect()
    assert {r.doc_id: r.component_id for r in rows} == expected(texts)


def test_number_of_trees_follows_the_recall():
    assert near_dup.trees_for(0.999) == 9
    assert near_dup.trees_for(0.99) < near_dup.trees_for(0.9999)


def test_shared_counts_of_sets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (0, 5, 8000, 6000, 700)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = near_dup.shared_counts(sets)
    off = ~np.eye(len(sets), dtype=bool)
    assert (got[off] == np.array(want)[off]).all()
    assert (near_dup.shared_counts(sets[:2], sets[2:]) == np.array(want)[:2, 2:]).all()


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(129, 200), (200, 129)]
    found = {r.node: r.component for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in [*range(100, 130), 200]}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_rows(spark):
    rows = near_dup.near_duplicates(awkward(spark)).collect()
    assert len(rows) == 13
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [r.n_shingles for r in by_id[1] + by_id[2] + by_id[3]] == [0, 0, 0]
    assert all(r.kept for r in by_id[1] + by_id[2] + by_id[3] + by_id[None])
    assert (by_id[6][0].component_id, by_id[6][0].kept) == (5, False)
    assert [r.kept for r in by_id[7]] == [True, True]
    assert near_dup.near_duplicates(nothing(spark)).count() == 0
