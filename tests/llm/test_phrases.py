"""Phrase collocations against brute force, and the summaries' guarantee."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
from helpers import awkward, documents, nothing

from reviewloom.llm import oracles, phrases, queries


def expected(rows, least=10, longest=3, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows, inside = [], defaultdict(list)
        for q, b in candidates.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    inside[q[i:i + m]].append(b)
        for p, a in candidates.items():
            if any(100 * b >= 50 * a for b in inside[p]):
                continue
            score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), p, counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, _, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return set(out)


def texts(rng, n):
    words = ["New", "york", "city", "of", "the", "São", "paulo", " x", "a\x1fb", "It's", "x-y"]
    return ["".join(rng.choice(words) + rng.choice(("  ", " ", " ", " ", "\t", ", ", "\n", ".", "; "))
                    for _ in range(rng.randrange(30))) for _ in range(n)]


def test_phrases_as_by_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.choice(("en", "de", None)), x) for x in texts(rng, 400)] + [("en", None), ("en", ""), ("fr", "New york")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    want = expected(rows)
    assert len(want) > 60 and {r[0] for r in want} == {"en", "de", "und"}
    for options in ({}, {"run_bytes": 300, "mass": 200}, {"run_bytes": 1}):
        assert set(map(tuple, phrases.collocations(docs, **options).collect())) == want
    assert set(map(tuple, phrases.collocations(docs, top=7).collect())) == {r for r in want if r[1] <= 7}
    four = phrases.collocations(docs, longest=4, least=3, top=None)
    assert set(map(tuple, four.collect())) == expected(rows, 3, 4, None)


def test_chunks_do_not_change_the_counts(spark, monkeypatch):
    docs = documents(spark, texts(random.Random(3), 60))
    want = set(map(tuple, phrases.collocations(docs, least=3).collect()))
    monkeypatch.setattr(phrases, "CHUNK", 50)
    assert want and set(map(tuple, phrases.collocations(docs, least=3).collect())) == want


def test_whole_given_table_as_by_sql_and_brute_force(spark):
    data = "/root/testdata/sf0.001"
    got = queries.op11_phrase_collocations(spark, data)
    rows = set(map(tuple, got.collect()))
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    assert rows == set(connection.sql(oracles.ORACLES["op11_phrase_collocations"]).select(*got.columns).fetchall())
    given = spark.read.parquet(f"{data}/documents.parquet").select("lang", "text").collect()
    assert rows == expected(list(map(tuple, given)))


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    assert set(map(tuple, phrases.collocations(docs, least=2).collect())) == expected(rows, 2)
    assert phrases.collocations(nothing(spark)).count() == 0


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(1)
    for _ in range(30):
        stream = rng.zipf(1.3, 5000).astype(np.int64) % 3000
        rows = [np.unique(x, return_counts=True) for x in np.array_split(stream, 40)]
        keys, counts = np.unique(stream, return_counts=True)
        capacity = 5000 // 10 + 1
        summary = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for row in rows:
            summary = phrases.merge(summary, row, capacity)
            assert len(summary[0]) <= capacity
        assert set(keys[counts >= 10]) <= set(summary[0])
        assert set(phrases.survivors(rows, 10)) == set(keys[counts >= 10])
