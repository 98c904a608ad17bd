"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

All of it is column expressions and aggregates. The votes of all documents are counted by
pattern (at most 3 to the number of rules); the rounds of expectation-maximisation run over
those counts, and a document is kept by its posterior probability of being good.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import SPACED_WORD, let, words, written

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

#: The rules as SQL over the counts: (name, votes bad if, votes good if); else a rule abstains.
#: A rule that sees no fault mostly abstains, as that alone makes no document good.
RULES = [
    ("length", "n_words < 30", "false"),
    ("symbols", "10 * n_symbols >= n_words", "false"),
    ("letters", "100 * n_letters < 88 * word_chars", "false"),
    ("lines", "10 * n_dup_lines >= 5 * n_lines", "false"),
    ("repeats", "10 * n_repeat_words >= 3 * n_words", "false"),
    ("capitals", "10 * n_capitals >= 4 * n_letters", "false"),
    ("shouts", "10 * n_shouts >= 3 * n_words", "false"),
    ("word_size", "word_chars < 3 * n_words OR word_chars > 12 * n_words", "false"),
    ("plain", "false", "n_words >= 50 AND 50 * n_symbols <= n_words AND 100 * n_letters >= 88 * word_chars"
     " AND 4 * n_repeat_words <= n_words AND 10 * n_capitals <= n_letters"),
]
ROUNDS = 15
#: Before it is learnt: how often a rule votes bad and good on good and on bad documents, which
#: counts as much as PRIOR_SHARE of all documents, and the share of good documents.
FIRST = {"good": (0.02, 0.5), "bad": (0.4, 0.02)}
PRIOR_SHARE, FIRST_GOOD = 0.02, 0.9


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(SPACED_WORD))
    return let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))


def _repeat_words(found: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more."""

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(
                F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("hash"),
                i.alias("at")))

    def repeated(s: Column) -> Column:
        same = lambda i, j: F.coalesce(
            F.get(s, i)["hash"] == F.get(s, j)["hash"], F.lit(False))
        places = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1), lambda i: same(i, i - 1) | same(i, i + 1))
        return F.sort_array(F.transform(places, lambda i: F.get(s, i)["at"]))

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.size(p) - 1), F.lit(0),
            lambda n, i: n + F.coalesce(F.least(F.get(p, i + 1) - F.get(p, i), F.lit(3)), F.lit(3)))

    counted = let(
        F.sort_array(windows(found)),
        lambda s: let(repeated(s), lambda p: F.when(F.size(p) > 0, covered(p)).otherwise(0)))
    return F.when(F.size(found) >= 3, counted).otherwise(0).cast("long")


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with what the rules count; a null text counts as empty.

    Columns of these names that docs already has are replaced.
    """
    kept = F.coalesce(F.col(text), F.lit(""))
    long = lambda c: c.cast("long")
    size = lambda pattern: long(F.length(F.regexp_replace(kept, pattern, "")))
    return (
        docs.withColumn("_words", words(kept, SPACED_WORD))
        .withColumn("_repeats", let(F.col("_words"), lambda w: F.struct(
            long(F.size(w)).alias("n_words"), _repeat_words(w).alias("n_repeat_words"))))
        .withColumn("_lines", _dup_lines(kept))
        .withColumns({
            "n_words": F.col("_repeats.n_words"),
            "word_chars": size(SPACES),
            "n_symbols": size(f"[^{SYMBOLS[1:]}+"),
            "n_dup_lines": F.col("_lines.n_dup_lines"),
            "n_lines": F.col("_lines.n_lines"),
            "n_repeat_words": F.col("_repeats.n_repeat_words"),
            "n_capitals": size(r"[^\p{Lu}]+"),
            "n_letters": size(r"[^\p{L}]+"),
            "n_shouts": size("[^!]+"),
        })
        .drop("_words", "_repeats", "_lines")
    )


def vote(good: str, bad: str) -> str:
    """SQL of a vote: -1 bad, 1 good, 0 none; bad goes first where both hold."""
    return f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END"


def votes(counted: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """counted with a column vote_<name> for each rule."""
    return counted.withColumns(
        {f"vote_{name}": F.expr(vote(good, bad)) for name, bad, good in rules})


def first_parameters(names: list[str]) -> dict[str, float]:
    """down_<class>_<rule> and up_<class>_<rule>: how often the rule votes bad and good on it."""
    found = {"prior": FIRST_GOOD}
    for name in names:
        for kind, (down, up) in FIRST.items():
            found |= {f"down_{kind}_{name}": down, f"up_{kind}_{name}": up}
    return found


def posterior_sql(names: list[str], value: dict[str, object]) -> str:
    """SQL of the probability of being good, given the votes. value: parameters as SQL."""
    odds = [f"ln({value['prior']} / (1 - {value['prior']}))"]
    for name in names:
        down, up = ([value[f"{way}_{kind}_{name}"] for kind in ("good", "bad")] for way in ("down", "up"))
        odds.append(
            f"CASE vote_{name} WHEN -1 THEN ln({down[0]} / {down[1]}) WHEN 1 THEN ln({up[0]} / {up[1]})"
            f" ELSE ln((1 - {down[0]} - {up[0]}) / (1 - {down[1]} - {up[1]})) END")
    return f"1 / (1 + exp(-({' + '.join(odds)})))"


def maximised_sql(names: list[str]) -> dict[str, str]:
    """SQL of each parameter as an aggregate over pattern counts n with posterior p."""
    prior = f"({PRIOR_SHARE} * sum(n) + 1)"
    found = {"prior": f"(coalesce(sum(n * p), 0) + {FIRST_GOOD} * coalesce({prior}, 1))"
                      f" / (coalesce(sum(n), 0) + coalesce({prior}, 1))"}
    for name in names:
        for kind, first in FIRST.items():
            weight = "p" if kind == "good" else "(1 - p)"
            for way, cast, before in (("down", -1, first[0]), ("up", 1, first[1])):
                found[f"{way}_{kind}_{name}"] = (
                    f"(coalesce(sum(CASE WHEN vote_{name} = {cast} THEN n * {weight} ELSE 0 END), 0)"
                    f" + {before} * coalesce({prior}, 1))"
                    f" / (coalesce(sum(n * {weight}), 0) + coalesce({prior}, 1))")
    return found


def accuracies(names: list[str], value: dict[str, float]) -> dict[str, float]:
    """How often each rule is right when it votes, by what was learnt."""
    good, found = value["prior"], {}
    for name in names:
        right = good * value[f"up_good_{name}"] + (1 - good) * value[f"down_bad_{name}"]
        wrong = good * value[f"down_good_{name}"] + (1 - good) * value[f"up_bad_{name}"]
        found[name] = right / (right + wrong)
    return found


def learn(voted: DataFrame, names: list[str], rounds: int = ROUNDS) -> dict[str, float]:
    """The rules' votes by class and the share of good documents, by expectation-maximisation.

    The driver gets one row of 4 * rules + 1 numbers a round. The pattern table is at most 3
    to the number of rules long, so one file holds it. Without rows the first guess stays.
    """
    patterns = written(
        voted.groupBy(*[f"vote_{x}" for x in names]).agg(F.count("*").alias("n")).coalesce(1))
    value = first_parameters(names)
    steps = [F.expr(sql).alias(k) for k, sql in maximised_sql(names).items()]
    for _ in range(rounds):
        p = posterior_sql(names, {k: f"{v!r}D" for k, v in value.items()})
        value = patterns.withColumn("p", F.expr(p)).agg(*steps).first().asDict()
    return value


def judge(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, least: float = 0.5) -> DataFrame:
    """docs with the counts, the votes and `quality`, the probability of being good.

    Every row gets a result: a null or empty text counts as no words; equal rows get equal
    results; an empty table gives an empty one. Columns of docs named like the results are
    replaced, all others stay. Whole texts are counted, however long; a document whose probability
    is exactly `least` is good. The counts are written once, as both the learning and the verdict
    read them.
    """
    names = [name for name, _, _ in RULES]
    voted = written(votes(counts(docs, text)))
    value = learn(voted, names, rounds)
    p = posterior_sql(names, {k: f"{v!r}D" for k, v in value.items()})
    return voted.withColumn("quality", F.expr(p)).withColumn("good", F.col("quality") >= least)
