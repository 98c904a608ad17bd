"""Personal data: base spans against brute force, what is learnt, and redaction."""

import hashlib
import random
import re

from helpers import awkward, documents, nothing
from pyspark.sql import functions as F

from reviewloom.llm import personal, queries

KINDS = ["email", "ip", "card", "phone"]
PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def good(kind, span):
    digits = [int(x) for x in re.sub("[^0-9]", "", span)]
    if kind == 1:
        return all(int(x) <= 255 for x in span.split("."))
    if kind == 2:
        luhn = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and luhn % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k, p in enumerate(PATTERNS)
            for m in re.finditer(p, text or "") if good(k, m.group())]


def check(rows, texts):
    """Rows and texts in one order: base columns as by brute force, base spans among all spans."""
    for r, text in zip(rows, texts, strict=True):
        want = base(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in want) for k in range(4)]
        told = [f"{KINDS[k]}:{a}:{b}" for k, a, b in want]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        every = [x for x in r.spans.split(",") if x]
        assert set(told) <= set(every) and len(set(every)) == len(every)
        placed = [(KINDS.index(k), int(a), int(b)) for k, a, b in (x.split(":") for x in every)]
        assert placed == sorted(placed) and all(0 <= a < b <= len(text) for _, a, b in placed)
        for k, a, b in set(placed) - set(want):  # what is added lies beside the base spans
            assert all(b <= x or y <= a for _, x, y in want)


def number(rng):
    return rng.choice((
        "4111 1111 1111 1111", "4111111111111112", "42.1.255.9", "300.1.2.3.4", "1.2.3.4.5", "001.2.3.0255", "+1 (911) 555-1477",
        "+1 (911) 555-1477 4111111111111111", "4111111111111111 10.0.0.1", "+12", "12345678", "a.b@c.d", "a@b.c_d@e.f.g",
        "é.x@y.zz", "@", "a@b", "x@y..z", "1-2 3--4", "7992739871300 3", "+49 30 (1234) 567-89.", "😀 5.6.7.8😀"))


def test_base_spans_as_by_brute_force(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice((number(rng), "word", "é", "\n", ",")) + rng.choice((" ", " ", "", "-"))
                     for _ in range(rng.randrange(14))) for _ in range(120)]
    texts += ["1 " * 20_000, "9" * 50_000, "a" * 50_000 + "@", "1.1." * 9_000, None, ""]
    rows = personal.find(documents(spark, texts), rounds=2).orderBy("doc_id").collect()
    check(rows, texts)


def test_swallowed_spans_are_added(spark):
    card, phone = "4111111111111111", "+1 (911) 555-1477"
    texts = [f"call {phone[:-4]}{1000 + i} now" for i in range(120)] + [f"paid by {card} to {'x' * i}" for i in range(120)]
    texts += [f"number {10**15 + 7 * i} here" for i in range(100)] + [f"code {i}-{i} and {i}" for i in range(200)]
    texts += [f"both {phone} {card} end", f"net {card} 10.20.30.40 end", "version 3.0 of 2024"]
    rows = personal.find(documents(spark, texts)).orderBy("doc_id").collect()
    check(rows, texts)
    at = len("both ")
    assert rows[-3].spans == f"card:{at + len(phone) + 1}:{at + len(phone) + 17},phone:{at}:{at + len(phone)}"
    assert rows[-2].spans == "ip:21:32,card:4:20" and rows[-1].spans == ""
    assert sum(r.spans.count(":") // 2 for r in rows[240:540]) == sum(r.n_card for r in rows[240:540])


def test_whole_given_table_as_by_brute_force(spark):
    data = "/root/testdata/sf0.001"
    got = queries.op12_personal_data(spark, data)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = got.orderBy("doc_id").collect()
    check(rows, [texts[r.doc_id] for r in rows])
    assert len(rows) == len(texts)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = personal.find(docs, rounds=1).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in docs.collect())
    assert personal.find(nothing(spark), rounds=1).count() == 0


def test_redaction(spark):
    row = spark.createDataFrame([("a b@c.de, 10.0.0.1 é", "email:2:8,ip:10:18"), ("none", "")], "t string, s string")
    assert [r[0] for r in row.select(personal.redact("t", "s")).collect()] == ["a [email], [ip] é", "none"]


def test_native_plan(spark):
    docs = documents(spark, ["a@b.cc"])
    plan = personal.find(docs, rounds=1)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_splits_and_thresholds(spark):
    assert personal.best_split({"a": [(0, -5.0, 2.0), (1, 5.0, 2.0)], "b": [(3, 0.0, 4.0)]}) == ("a", 0)
    assert personal.best_split({"b": [(3, 1.0, 4.0)]}) is None
    rows = [(k, 1, o, n, g) for k, o, n, g in ((0, 3, 90, 90), (0, 2, 10, 6), (0, 1, 50, 0), (1, 3, 10, 2))]
    table = spark.createDataFrame(rows, "kind int, f int, o int, held_n long, held_good long")
    assert personal.thresholds(table, "o * 1.0D") == {0: 2.0}
    assert personal.thresholds(table.where(F.lit(False)), "o * 1.0D") == {}
