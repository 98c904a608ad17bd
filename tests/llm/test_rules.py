"""URL rules, license scans and quality rules against brute force."""

import random
import re

import pytest
from helpers import awkward, documents, nothing, sentence

from reviewloom.llm import licenses, quality, url_rules

LISTED = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
          ("net", "/es/", "block"), ("net", "/fr/", "block")]


def judged(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [(len(h + p), h + p, v) for h, p, v in LISTED
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return (host, path, *max(fits)[1:])
    bad = set(re.split("[^a-z0-9]+", host)) & set(url_rules.UNWANTED)
    return host, path, None, "block" if bad else "allow"


def test_urls_as_by_brute_force(spark):
    rng = random.Random(1)
    urls = [None, "", "example.com/en/", "http://", "https://com/", "://com", "http://a://b.com/x", "x://WWW.Example.COM/en/1",
            "http://notexample.com/en/", "http://xcom/", "http://a.net/es", "http://a.net/fr/x#y", "http://casino.org/",
            "http://casinos.org/", "http://my-casino7.org", "http://x.org/casino", "http://.com/\n", "http://é.com/en/"]
    for _ in range(200):
        urls.append("".join(rng.choice(["http", "://", "www.", "example", ".com", ".net", "/en/", "/es/", "/fr/", "?q", "#",
                                        "adult", "-", "x", "A"]) for _ in range(rng.randrange(9))))
    rows = [(i, u, "clash", 3) for i, u in enumerate(urls)] + [(0, None, "clash", 3), (5, urls[5], "c", 1), (None, urls[7], "", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, token string, n long")
    got = url_rules.judge(pages).collect()
    key = lambda x: tuple(map(str, x))
    want = sorted(((i, u, *judged(u)) for i, u, *_ in rows), key=key)
    assert sorted((tuple(r) for r in got), key=key) == want
    assert url_rules.judge(pages.limit(0)).count() == 0


def test_rules_are_under_their_rarest_token(spark):
    tokens = spark.createDataFrame([("com", 9), ("example", 2), ("en", 1), ("en", 4)], "token string, n long")
    index = {r.name: r.token for r in url_rules.index_rules(spark, tokens, url_rules.LISTED).collect()}
    assert index["example.com/en/"] == "example" and index["com/"] == "com" and index["net/es/"] in ("es", "net")


def test_many_rules_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "BROADCAST_BYTES", 0)
    pages = spark.createDataFrame([(1, "http://a.example.com/en/1"), (2, "http://p.org/pre/12")], "page_id long, url string")
    rules = [*url_rules.RULES, url_rules.place_rule("block", "p.org", "/pre/1"), url_rules.Rule("any", "block", "zzz", "")]
    got = {r.page_id: (r.rule, r.verdict) for r in url_rules.judge(pages, rules=rules).collect()}
    assert got == {1: ("example.com/en/", "block"), 2: ("p.org/pre/1", "block")}


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def base_places(text):
    words, found = plain(text), []
    for phrase, label in licenses.BASE.items():
        w = phrase.split()
        found += [(i, label) for i in range(len(words) - len(w) + 1) if words[i:i + len(w)] == w]
    return len(words), found


def test_license_phrases_as_by_brute_force(spark):
    rng = random.Random(4)
    bits = ["GNU General Public License", "gnu general", "public-license", "Apache  License,", "CC BY", "cc", "by", "MIT",
            "license", "mit License mit license", "x", "é"]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(150)] + [None, "", "cc"]
    for r in licenses.scan(documents(spark, texts)).collect():
        n, found = base_places(texts[r.doc_id])
        assert (r.n_words, r.n_base) == (n, len(found))
        assert (r.first_word, r.last_word) == (
            (min(found)[0], max(found)[0]) if found else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in found}))
        assert set(r.base_labels.split(",")) <= set(r["labels"].split(",")) or not r.base_labels


def test_longer_wordings_by_merged_diagonals(spark):
    mit = next(k for k, v in licenses.TEMPLATES.items() if v == "mit-text")
    words = mit.split()
    changed = " ".join(words[:8] + ["really"] + words[8:])  # a word more: two neighbouring diagonals
    texts = [mit, changed, " ".join(words[:9]), "Licensed under the Apache License, Version 2.0."]
    rows = sorted(licenses.scan(documents(spark, texts)).collect(), key=lambda r: r.doc_id)
    assert [r["labels"] for r in rows] == ["mit-text", "mit-text", "", "apache,apache-2.0"]
    assert rows[0].score == 1.0 and 0.8 <= rows[1].score < 1.0


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    again = {i + d for i, g in enumerate(grams) if grams.count(g) > 1 for d in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(again))


def test_quality_counts_as_by_brute_force(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["a", "b", "c#", "d\n", "\ne", "|", "ü"]) for _ in range(rng.randrange(40)))
             for _ in range(120)] + [None, "", "a b", "a b c", "a b c a b c", "x\n\nx\nx \n \n", "a\u00a0b \u2028c"]
    rows = quality.counts(documents(spark, texts)).collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(texts[r.doc_id])


def test_rules_agree_on_bad_documents(spark):
    rng = random.Random(9)
    good = [sentence(rng, 120).replace("1", "i").replace("2", "e") for _ in range(200)]
    good = [re.sub("[0-9]", "o", x) for x in good]
    shouts = [" ".join(w.upper() + "!!" for w in x.split()) for x in good[:12]]
    symbols = [" ".join(w + "***" for w in x.split()) for x in good[12:24]]
    rows = quality.judge(documents(spark, good + shouts + symbols)).collect()
    kept = {r.doc_id: r.good for r in rows}
    assert sum(kept[i] for i in range(200)) >= 198
    assert not any(kept[i] for i in range(200, 224))


def test_labelled_documents(spark):
    """Against the labels, which the rules never saw."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").selectExpr("doc_id", "quality AS label")
    rows = quality.judge(docs).join(labels, "doc_id").where("n_words >= 50").collect()
    bad, fine = [r for r in rows if r.label == 0], [r for r in rows if r.label == 1]
    assert sum(not r.good for r in bad) >= 0.95 * len(bad)
    assert sum(r.good for r in fine) >= 0.98 * len(fine)


@pytest.mark.parametrize("operator", [licenses.scan, quality.judge])
def test_awkward_rows(spark, operator):
    rows = operator(awkward(spark)).collect()
    assert len(rows) == 13
    n = {}
    for r in rows:
        n.setdefault(r.doc_id, []).append(int(r.n_words))
    assert n[1] == n[2] == n[3] == [0] and n[7] == [3, 3] and n[5] == n[6] and n[5][0] >= 12_000
    assert operator(nothing(spark)).count() == 0
