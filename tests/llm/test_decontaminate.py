"""Benchmark decontamination against brute force."""

import random
import re

from helpers import awkward, documents, nothing, sentence

from reviewloom.llm import decontaminate


def plain(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(texts, items, size=13):
    found = {}
    for i, text in enumerate(texts):
        words, hit, named = plain(text), set(), set()
        for name, item in items:
            w = plain(item)
            n = min(size, len(w))
            spans = {tuple(w[s:s + n]) for s in range(len(w) - n + 1)} if w else set()
            for s in range(len(words) - n + 1):
                if n and tuple(words[s:s + n]) in spans:
                    hit.update(range(s, s + n))
                    named.add(str(name))
        found[i] = (len(words), len(hit), sorted(named), bool(hit) and 20 * len(hit) >= len(words))
    return found


def cases():
    rng = random.Random(21)
    items = [(k, sentence(rng, n)) for k, n in enumerate((40, 20, 13, 12, 5, 1, 60))]
    items += [(7, None), (8, "..."), (9, items[1][1]), (10, "la " * 30), (9, sentence(rng, 15))]
    texts = [sentence(rng, rng.randrange(0, 120)) for _ in range(30)]
    for _ in range(40):
        w = plain(rng.choice(items)[1])
        a, b = sorted((rng.randrange(len(w) + 1), rng.randrange(len(w) + 1)))
        texts.append(f"{sentence(rng, rng.randrange(60))} {'; '.join(w[a:b]).upper()}. {sentence(rng, 9)}")
    return texts + [items[0][1] * 2, "la " * 14, "La, " * 400, "", None], items


def test_hits_as_by_brute_force(spark):
    texts, items = cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contaminated(documents(spark, texts), benchmark).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows} == brute(texts, items)


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    texts, items = cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contaminated(documents(spark, texts), benchmark).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows} == brute(texts, items)


def test_proximity_finds_reordered_words(spark):
    rng = random.Random(3)
    item = sentence(rng, 13).split()
    other = list(item)
    rng.shuffle(other)
    texts = [" ".join(item), " ".join(other), sentence(rng, 50), " ".join(item[:3])]
    benchmark = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    docs = documents(spark, texts)
    index = decontaminate.build_index(docs, benchmark, "doc_id", "text", "item_id", "text")
    near = {r.id for r in decontaminate.proximity_matches(index).collect()}
    assert {0, 1} <= near and 2 not in near
    exact = {r.doc_id for r in decontaminate.contaminated(docs, benchmark).where("n_hit > 0").collect()}
    assert exact == {0}


def test_awkward_rows(spark):
    benchmark = spark.createDataFrame([("a", "same row again"), (None, "text"), ("c", None)], "item_id string, text string")
    rows = decontaminate.contaminated(awkward(spark), benchmark).collect()
    assert len(rows) == 13
    assert sorted(r.n_hit for r in rows if r.doc_id == 7) == [3, 3]
    assert all(not r.contaminated for r in rows if r.doc_id in (1, 2, 3))
    empty = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.contaminated(awkward(spark), empty).where("contaminated").count() == 0
    assert decontaminate.contaminated(nothing(spark), benchmark).count() == 0
