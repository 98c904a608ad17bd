"""Personal data by gradient boosting of candidate spans.

Generators with high recall propose spans, which may overlap. The base rules judge those they match
themselves; boosted trees learn from these verdicts what such a span and its surroundings look
like, and score all candidates, those too that a base match has swallowed. A threshold for each
kind, set on documents held out of the learning, selects what is added to the base spans.

All of it is column expressions and aggregates. The trees learn from counts of candidates by
pattern of binned features; the driver gets sums by feature and bin, whatever the corpus holds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import let, written

KINDS = ["email", "ip", "card", "phone"]
#: The base patterns of the contract, by kind. The possessive forms find the same spans as the
#: plain ones without trying again inside long runs of letters or digits.
_EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
BASE = [
    rf"(?:(?<![A-Za-z0-9._%+-])|\G){_EMAIL}",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
#: Further generators: (kind, pattern).
MORE = [
    (0, r"[^\s@]{1,64}@[^\s@]{1,255}"),
    (1, r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])"),
    (2, r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    (2, r"(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])"),
    (3, r"\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])"),
    (3, r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
]
#: A text without any of these characters holds no candidate.
SIGNS = "[0-9@]"
#: Features as SQL over kind, span, the characters beside it, its digits and the base rule's
#: verdict; each is a small number, so that patterns are few.
_BESIDE = ("CASE WHEN {0} = '' THEN 0 WHEN {0} RLIKE '[\\\\s]' THEN 1 WHEN {0} RLIKE '[0-9]' THEN 2"
           " WHEN {0} RLIKE '\\\\p{{L}}' THEN 3 WHEN {0} RLIKE '[.,;:!?()]' THEN 4 ELSE 5 END")
FEATURES = {
    "kind": "kind",
    "f_digits": "least(length(digits), 24)",
    "f_length": "least(length(span), 60) div 3",
    "f_blanks": "least(length(span) - length(replace(replace(span, ' '), '-')), 6)",
    "f_dots": "least(length(span) - length(replace(span, '.')), 6)",
    "f_sign": "CASE WHEN span LIKE '+%' THEN 2 WHEN span LIKE '(%' THEN 1 ELSE 0 END",
    "f_before": _BESIDE.format("before"),
    "f_after": _BESIDE.format("after"),
    "f_valid": "CAST(valid AS int)",
}
ROUNDS, RATE, SMOOTH, FOLDS, PRECISION = 12, 0.5, 1.0, 5, 0.95


def _proposed(text: Column, generator: int, kind: int, pattern: str) -> Column:
    """Spans of one generator in order, with what lies before and beside each. Gaps between
    matches give their places: matching and splitting see the same matches."""
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("spans"),
                    F.split(text, pattern).alias("gaps"))
    return let(both, lambda x: F.transform(x["spans"], lambda span, i: F.struct(
        F.lit(generator).alias("generator"), F.lit(kind).alias("kind"), i.alias("at"), span.alias("span"),
        F.length(F.get(x["gaps"], i)).alias("gap"),
        F.substring(F.get(x["gaps"], i), -1, 1).alias("before"),
        F.substring(F.get(x["gaps"], i + 1), 1, 1).alias("after"))))


def _valid() -> Column:
    """The base rules' checks of a match."""
    parts = F.expr("forall(split(span, '[.]'), p -> try_cast(regexp_replace(p, '^0+(?=.)', '') AS int) <= 255"
                   " AND length(regexp_replace(p, '^0+(?=.)', '')) <= 3)")
    n = F.length("digits")
    luhn = F.expr("""aggregate(sequence(1, length(digits)), 0, (total, i) -> total + CASE
        WHEN (length(digits) - i) % 2 = 0 THEN CAST(substr(digits, i, 1) AS int)
        WHEN substr(digits, i, 1) < '5' THEN 2 * CAST(substr(digits, i, 1) AS int)
        ELSE 2 * CAST(substr(digits, i, 1) AS int) - 9 END) % 10 = 0""")
    return (F.when(F.col("kind") == 0, F.col("span").rlike(f"^{_EMAIL}$"))
            .when(F.col("kind") == 1, parts)
            .when(F.col("kind") == 2, F.when((n >= 13) & (n <= 19), luhn).otherwise(F.lit(False)))
            .otherwise((n >= 9) & (n <= 15)))


def candidates(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): rows is (row, id) of each row of docs, with a number of its own; spans is (row,
    kind, start, end, base, matched, fold, features) of its candidates, each once. Places are code
    points. matched: a base pattern finds it; base: and its check holds."""
    held = F.coalesce(F.col(text), F.lit(""))
    generators = [*enumerate(BASE), *MORE]
    proposed = F.concat(*[_proposed(held, i, kind, p) for i, (kind, p) in enumerate(generators)])
    found = F.when(held.rlike(SIGNS), proposed)
    table = written(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.pmod(F.xxhash64(held), F.lit(FOLDS)).cast("int").alias("fold"), found.alias("found")))
    along = Window.partitionBy("row", "generator").orderBy("at")
    placed = (
        table.select("row", "fold", F.explode("found").alias("c")).select("row", "fold", "c.*")
        .withColumn("end", F.sum(F.col("gap") + F.length("span")).over(along))
        .withColumn("start", F.col("end") - F.length("span"))
        .withColumn("digits", F.regexp_replace("span", "[^0-9]", ""))
        .withColumn("valid", F.coalesce(_valid(), F.lit(False)))
        .withColumn("matched", F.col("generator") < len(BASE)))
    names = [x for x in FEATURES if x != "kind"]
    spans = (
        placed.withColumns({x: F.expr(FEATURES[x]).cast("int") for x in names})
        .groupBy("row", "fold", "kind", "start", "end")
        .agg(F.max("matched").alias("matched"), F.max(F.col("matched") & F.col("valid")).alias("base"),
             *[F.max(x).alias(x) for x in names]))
    return table.select("row", "id"), written(spans)


def touches(spans: DataFrame, keys: list[str], chosen: Column) -> Column:
    """Whether a span shares a character with another of the same keys for which `chosen` holds, or
    is one itself."""
    by = Window.partitionBy(*keys).orderBy("start")
    reached = F.max(F.when(chosen, F.col("end"))).over(by.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    begins = F.min(F.when(chosen, F.col("start"))).over(by.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    return F.coalesce(reached > F.col("start"), F.lit(False)) | F.coalesce(begins < F.col("end"), F.lit(False))


def patterns(spans: DataFrame) -> DataFrame:
    """Counts of labelled candidates by features: n and good in the folds that are learnt from,
    held_n and held_good in the one held out.

    A candidate that a base pattern finds has the verdict of its check; one away from all matches
    of its kind counts as none. What a match swallows has no label.
    """
    known = spans.withColumn("near", touches(spans, ["row", "kind"], F.col("matched"))).where("matched OR NOT near")
    held = F.col("fold") == 0
    return known.groupBy(*FEATURES).agg(
        F.count(F.when(~held, 1)).alias("n"), F.count(F.when(~held & F.col("base"), 1)).alias("good"),
        F.count(F.when(held, 1)).alias("held_n"), F.count(F.when(held & F.col("base"), 1)).alias("held_good"))


def _sums(table: DataFrame, sides: str, score: str) -> dict[int, dict[str, list[tuple[int, float, float]]]]:
    """(bin, gradient, curvature) by side of a tree and feature; a row for each bin."""
    p = f"(1 / (1 + exp(-({score}))))"
    rows = table.withColumn("side", F.expr(sides)).selectExpr(
        "side", f"good - n * {p} AS g", f"n * {p} * (1 - {p}) AS h",
        f"stack({len(FEATURES)}, {', '.join(f'{k!r}, {k}' for k in FEATURES)}) AS (feature, bin)")
    found: dict[int, dict[str, list]] = {}
    for r in rows.groupBy("side", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).orderBy(
            "side", "feature", "bin").collect():
        found.setdefault(r.side, {}).setdefault(r.feature, []).append((r.bin, r.g, r.h))
    return found


def best_split(sums: dict[str, list[tuple[int, float, float]]]) -> tuple[str, int] | None:
    """(feature, bin): rows up to the bin against those above; None if no split gains."""
    best = (1e-6, None)
    for feature, bins in sorted(sums.items()):
        g, h = sum(x[1] for x in bins), sum(x[2] for x in bins)
        gl = hl = 0.0
        for bin, one_g, one_h in bins[:-1]:
            gl, hl = gl + one_g, hl + one_h
            gain = gl ** 2 / (hl + SMOOTH) + (g - gl) ** 2 / (h - hl + SMOOTH) - g ** 2 / (h + SMOOTH)
            if gain > best[0]:
                best = (gain, (feature, bin))
    return best[1]


def learn(counted: DataFrame, rounds: int = ROUNDS) -> str:
    """SQL of a candidate's log odds: boosted trees of two levels, by gradient and curvature of the
    log loss. Without labelled rows the odds are even."""
    total = counted.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    n, good = total.n or 0, total.good or 0
    score = f"{math.log((good + 1) / (n - good + 1))!r}D"
    for _ in range(rounds):
        root = best_split(_sums(counted, "0", score).get(0, {}))
        if root is None:
            break
        sides = _sums(counted, f"CASE WHEN {root[0]} <= {root[1]} THEN 0 ELSE 1 END", score)
        leaves = []
        for side in (0, 1):
            split = best_split(sides[side])
            where = f"{root[0]} {'<=' if side == 0 else '>'} {root[1]}"
            feature, at = split or ("kind", len(KINDS))
            for low in (True, False):
                g = sum(x[1] for x in sides[side][feature] if (x[0] <= at) == low)
                h = sum(x[2] for x in sides[side][feature] if (x[0] <= at) == low)
                leaves.append(f"WHEN {where} AND {feature} {'<=' if low else '>'} {at} THEN {RATE * g / (h + SMOOTH)!r}D")
        score += f" + CASE {' '.join(leaves)} END"
    return score


def thresholds(counted: DataFrame, score: str, precision: float = PRECISION) -> dict[int, float]:
    """For each kind the least odds (in hundredths) from which on the held-out candidates are base
    spans in `precision` of the cases; a kind without such odds has none. Odds are rounded, so the
    driver gets a bounded number of rows."""
    odds = F.round(F.greatest(F.least(F.expr(score), F.lit(20.0)), F.lit(-20.0)), 2)
    rows = counted.groupBy("kind", odds.alias("odds")).agg(
        F.sum("held_n").alias("n"), F.sum("held_good").alias("good")).where("n > 0").orderBy(
        "kind", F.desc("odds")).collect()
    found: dict[int, float] = {}
    sums: dict[int, list[int]] = {}
    for r in rows:
        n, good = sums.setdefault(r.kind, [0, 0])
        sums[r.kind] = [n + r.n, good + r.good]
        if good + r.good >= precision * (n + r.n):
            found[r.kind] = r.odds
    return found


def chosen(spans: DataFrame, rounds: int = ROUNDS, precision: float = PRECISION) -> DataFrame:
    """(row, kind, start, end, base, odds) of the base spans and of what is added: candidates at
    or above their kind's threshold that share no character with a base span and that no base rule
    has refused. Of added spans that overlap the one with better odds stays; of equally good ones
    the longest, the first, and the first kind."""
    counted = written(patterns(spans).coalesce(1))
    score = learn(counted, rounds)
    least = thresholds(counted, score, precision)
    odds = F.round(F.greatest(F.least(F.expr(score), F.lit(20.0)), F.lit(-20.0)), 2)
    picked = F.lit(False)
    for kind, value in least.items():
        picked = picked | ((F.col("kind") == kind) & (F.col("odds") >= value))
    some = spans.withColumn("odds", odds).withColumn("picked", picked).where("base OR picked AND NOT matched")
    free = some.withColumn("taken", touches(some, ["row"], F.col("base"))).where("NOT taken")
    by = Window.partitionBy("row").orderBy("start", "end", "kind")
    before = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    chained = free.withColumn("new", F.coalesce(before <= F.col("start"), F.lit(True)).cast("int")).withColumn(
        "chain", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = F.array_sort(F.collect_list(F.struct(
        (-F.col("odds")).alias("less"), (F.col("start") - F.col("end")).alias("shorter"), "start", "end", "kind")))
    greedy = F.aggregate(
        ranked, F.expr("cast(array() AS array<struct<less: double, shorter: bigint, start: bigint, end: bigint, kind: int>>)"),
        lambda kept, x: F.when(F.exists(kept, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])), kept)
        .otherwise(F.concat(kept, F.array(x))))
    added = chained.groupBy("row", "chain").agg(greedy.alias("kept")).select("row", F.explode("kept").alias("x")).select(
        "row", "x.kind", "x.start", "x.end", F.lit(False).alias("base"), (-F.col("x.less")).alias("odds"))
    return some.where("base").select("row", "kind", "start", "end", "base", "odds").unionByName(added)


def _named(spans: str) -> str:
    names = ", ".join(f"'{x}'" for x in KINDS)
    return f"array_join(transform({spans}, x -> concat(array({names})[x.kind], ':', x.start, ':', x.end)), ',')"


def find(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rounds: int = ROUNDS,
         precision: float = PRECISION) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of each row of docs.

    The counts and the hash are of the base spans, spans are all, as kind:start:end by kind and
    place. A null text is empty and has none; rows are told apart by a number of their own, so null
    and repeated ids and rows keep their own results. Whole texts are searched, however long;
    other columns are not read; an empty table gives an empty one.
    """
    rows, spans = candidates(docs, id_col, text)
    held = chosen(spans, rounds, precision).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("kind", "start", "end", "base"))).alias("all"))
    told = held.withColumn("own", F.expr("filter(all, x -> x.base)")).select(
        "row", *[F.expr(f"CAST(size(filter(own, x -> x.kind = {k})) AS long)").alias(f"n_{name}")
                 for k, name in enumerate(KINDS)],
        F.expr(_named("own")).alias("base"), F.expr(_named("all")).alias("spans"))
    return rows.join(told, "row", "left").select(
        F.col("id").alias(id_col), *[F.coalesce(f"n_{x}", F.lit(0)).cast("long").alias(f"n_{x}") for x in KINDS],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def redact(text: str, spans: str) -> Column:
    """The text with each span of a `spans` column replaced by its kind in brackets; of spans that
    overlap the first is named and the rest of the others goes with it."""
    places = (f"array_sort(transform(filter(split({spans}, ','), s -> s <> ''), s -> struct("
              "CAST(split(s, ':')[1] AS int) AS start, CAST(split(s, ':')[2] AS int) AS end, split(s, ':')[0] AS kind)))")
    step = (f"(a, x) -> struct(concat(a.done, CASE WHEN x.start >= a.at THEN concat(substr({text}, a.at + 1, x.start - a.at),"
            " '[', x.kind, ']') ELSE '' END) AS done, greatest(a.at, x.end) AS at)")
    return F.expr(f"aggregate({places}, struct('' AS done, 0 AS at), {step},"
                  f" a -> concat(a.done, substr({text}, a.at + 1)))")
