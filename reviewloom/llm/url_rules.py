"""URL filters: pattern rules under their rarest literal token.

A rule's literal text gives tokens that every url it fits must hold whole. The rule is indexed
under the one of them that the fewest urls hold. A url fetches rules by its own tokens, and only
fetched rules run their regular expression. All of it is joins and column functions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.common import lower_ascii

#: Rules below this many bytes of text are joined by broadcast; more by a shuffle.
BROADCAST_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """name: as reported; regex: over host and path put together; literal: text that a fitting
    url holds, cut at characters other than a-z and 0-9 on both sides; listed rules go first."""

    name: str
    verdict: str
    regex: str
    literal: str
    listed: bool = True

    @property
    def tokens(self) -> list[str]:
        return sorted(set(re.findall("[a-z0-9]+", self.literal))) or [""]


def place_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host, its subdomains and the paths that start with path.

    A token at the end of the path may go on in a url, so it isn't a literal.
    """
    literal = f"{host} {re.sub('[a-z0-9]+$', '', path.lower())}"
    return Rule(f"{host}{path}", verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", literal)


def host_word_rule(word: str) -> Rule:
    """Blocks hosts with this word between other characters than a-z and 0-9."""
    return Rule(f"*{word}*", "block", rf"^(?:[^/]*[^a-z0-9/])?{word}(?![a-z0-9])", word, False)


#: Fixed values of the contract.
LISTED = [
    place_rule("allow", "com", "/"),
    place_rule("block", "example.com", "/en/"),
    place_rule("allow", "www.example.com", "/en/"),
    place_rule("block", "net", "/es/"),
    place_rule("block", "net", "/fr/"),
]
#: Host words of the method's own rules.
UNWANTED = ["adult", "bet", "casino", "escort", "pills", "poker", "porn", "sex", "torrent",
            "viagra", "warez", "xxx"]
RULES = LISTED + [host_word_rule(word) for word in UNWANTED]


def host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """After the first `://`: up to `/`, `?`, `#` or the end in lower case, then up to `?` or `#`.

    Both are empty for null and for a url without `://`.
    """
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return (lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)),
            F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1))


def _url_tokens(host: F.Column, path: F.Column) -> F.Column:
    """The distinct tokens of a url, and the empty one, which rules without a literal go by."""
    found = F.regexp_extract_all(lower_ascii(F.concat_ws("/", host, path)), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.array_union(F.array_distinct(found), F.array(F.lit("")))


def _hinted(rules: list[Rule], df: DataFrame) -> DataFrame:
    size = sum(len(r.name) + len(r.regex) + 8 * len(r.literal) for r in rules)
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def index_rules(spark: SparkSession, tokens: DataFrame, rules: list[Rule]) -> DataFrame:
    """(token, name, verdict, regex, listed, size): each rule under its rarest token.

    tokens: (token, n), a row for each url and token; n is how many pages have the url.
    """
    rows = [(i, r.name, r.verdict, r.regex, r.listed, len(r.name), t)
            for i, r in enumerate(rules) for t in r.tokens]
    table = spark.createDataFrame(
        rows, "id int, name string, verdict string, regex string, listed boolean, size int, token string")
    wanted = table.select("token").distinct()
    held = (tokens.join(_hinted(rules, wanted), "token", "left_semi")
            .groupBy("token").agg(F.sum("n").alias("held")))
    found = table.join(held, "token", "left").withColumn("held", F.coalesce("held", F.lit(0)))
    rarest = found.groupBy("id").agg(F.min(F.struct("held", "token")).alias("rarest"))
    return (found.join(rarest, "id").where("token = rarest.token")
            .select("token", "name", "verdict", "regex", "listed", "size"))


def judge(pages: DataFrame, id_col: str = "page_id", url: str = "url",
          rules: list[Rule] = RULES) -> DataFrame:
    """(id, url, host, path, rule, verdict) for each row of pages.

    rule is the longest listed rule that fits (ties: the larger name), else null. verdict is that
    rule's; else block where an unlisted rule blocks, and allow otherwise. Equal rows give equal
    rows, as many as came; a null id is an id like others; an empty table gives an empty one.
    No other column is read, so clashing names do no harm.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    places = (
        pages.select(F.col(id_col).alias("id"), F.col(url).alias("url"))
        .groupBy("id", "url").agg(F.count("*").alias("n"))
        .withColumns({"host": host, "path": path})
        .withColumn("token", F.explode(_url_tokens(F.col("host"), F.col("path"))))
    )
    index = _hinted(rules, index_rules(spark, places, rules))
    fits = F.rlike(F.concat("host", "path"), F.col("regex"))
    rank = F.struct("size", "name", "verdict")
    return (
        places.join(index.withColumnRenamed("token", "by"), (F.col("token") == F.col("by")) & fits, "left")
        .groupBy("id", "url")
        .agg(F.first("n").alias("n"), F.first("host").alias("host"), F.first("path").alias("path"),
             F.max(F.when(F.col("listed"), rank)).alias("best"),
             F.coalesce(F.bool_or(~F.col("listed") & (F.col("verdict") == "block")), F.lit(False))
             .alias("unwanted"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .select(
            F.col("id").alias(id_col), F.col("url").alias(url), "host", "path",
            F.col("best.name").alias("rule"),
            F.coalesce("best.verdict", F.when(F.col("unwanted"), "block").otherwise("allow"))
            .alias("verdict"))
    )
