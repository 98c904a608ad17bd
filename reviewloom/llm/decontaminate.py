"""Benchmark decontamination by a distributed positional inverted index.

For every window of a benchmark item the two terms are chosen that the corpus holds least. Their
postings (term, document, position) are stored. Moved by the terms' offsets in the item, postings
that belong together fall on one diagonal of document and item; where both rarest terms of a
window are on it, the window is a candidate, and its words are compared with the document's. All
of it is column expressions, joins and aggregates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import PLAIN_WORD, let, lower_ascii, words, written

WINDOW, RAREST = 13, 2
#: Benchmarks up to this many bytes of text are joined by broadcast, larger ones by a shuffle.
BROADCAST_BYTES = 32 << 20
#: A document is contaminated from this share of hit words on, as 1 to so many.
LEAST_SHARE = 20


def plain_words(text: Column) -> Column:
    return words(lower_ascii(F.coalesce(text, F.lit(""))), PLAIN_WORD)


@dataclass
class Index:
    """postings: (term, id, text_hash, pos); items: (item, item_id, item_words, length, windows),
    windows being (start, one, two), the offsets of a window's rarest terms; anchors: (term, item,
    offset). small: whether the benchmark may be broadcast."""

    postings: DataFrame
    items: DataFrame
    anchors: DataFrame
    small: bool

    def hint(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.small else df


def _items(benchmark: DataFrame, id_col: str, text: str, window: int) -> DataFrame:
    rows = benchmark.select(F.col(id_col).cast("string").alias("item_id"), plain_words(F.col(text)).alias("item_words"))
    return (rows.where(F.size("item_words") > 0).distinct()
            .withColumn("item", F.xxhash64("item_id", "item_words"))
            .withColumn("length", F.least(F.lit(window), F.size("item_words"))))


def _rarest(terms: Column, length: Column) -> Column:
    """(start, one, two) of each window, from (held, offset) of each term; two is null in a window
    of one word. Windows with a term that the corpus lacks are left out."""
    return F.filter(
        F.transform(
            F.sequence(F.lit(0), F.size(terms) - length),
            lambda s: let(F.sort_array(F.slice(terms, s + 1, length)), lambda w: F.struct(
                s.alias("start"), F.get(w, F.lit(0))["offset"].alias("one"),
                F.get(w, F.lit(1))["offset"].alias("two"), F.get(w, F.lit(0))["held"].alias("held")))),
        lambda x: x["held"] > 0)


def build_index(docs: DataFrame, benchmark: DataFrame, id_col: str, text: str, item_id: str,
                item_text: str, window: int = WINDOW) -> Index:
    """The index of all documents for the rarest terms of all windows of the benchmark."""
    tokens = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"),
                         F.posexplode(plain_words(F.col(text))).alias("pos", "term"))
    items = written(_items(benchmark, item_id, item_text, window))
    size = items.agg(F.sum(F.octet_length(F.concat_ws(" ", "item_words")))).first()[0] or 0
    hint = (lambda df: F.broadcast(df)) if size <= BROADCAST_BYTES else (lambda df: df)
    placed = items.select("item", F.posexplode("item_words").alias("offset", "term"))
    held = (tokens.select("term").join(hint(placed.select("term").distinct()), "term", "left_semi")
            .groupBy("term").agg(F.count("*").alias("held")))
    terms = (placed.join(held, "term", "left").groupBy("item").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("offset", F.coalesce("held", F.lit(0)).alias("held")))),
        lambda x: F.struct(x["held"].alias("held"), x["offset"].alias("offset"))).alias("terms")))
    items = written(items.join(terms, "item").withColumn("windows", _rarest(F.col("terms"), F.col("length")))
                    .drop("terms"))
    anchors = (items.select("item", F.explode("windows").alias("w"))
               .select("item", F.explode(F.array("w.one", "w.two")).alias("offset")).distinct()
               .join(placed, ["item", "offset"]).select("term", "item", "offset"))
    postings = written(tokens.join(hint(anchors.select("term").distinct()), "term", "left_semi"))
    return Index(postings, items, written(anchors), size <= BROADCAST_BYTES)


def candidates(index: Index) -> DataFrame:
    """(id, text_hash, item, diagonal, starts): windows with both rarest terms on a diagonal."""
    moved = (index.postings.join(index.hint(index.anchors), "term")
             .groupBy("id", "text_hash", "item", (F.col("pos") - F.col("offset")).alias("diagonal"))
             .agg(F.collect_set("offset").alias("offsets")))
    both = moved.where("size(offsets) > 1").unionByName(
        moved.where("size(offsets) = 1").join(
            index.hint(index.items.where("length = 1").select("item")), "item", "left_semi"))
    held = F.filter("windows", lambda w: F.array_contains("offsets", w["one"])
                    & (w["two"].isNull() | F.array_contains("offsets", w["two"])))
    return (both.join(index.hint(index.items.select("item", "windows")), "item")
            .select("id", "text_hash", "item", "diagonal",
                    F.transform(held, lambda w: w["start"]).alias("starts"))
            .where("size(starts) > 0"))


def proximity_matches(index: Index, reach: int = 2 * WINDOW) -> DataFrame:
    """(id, text_hash, item_id, windows): in how many windows of the item both rarest terms come at
    most `reach` words apart in the document, in any order; windows of one word don't count."""
    pairs = (index.items.select("item", "item_id", F.explode("windows").alias("w")).where("w.two IS NOT NULL")
             .select("item", "item_id", "w.start", "w.one", "w.two"))
    term = index.anchors.withColumnsRenamed({"offset": "at"})
    pairs = (pairs.join(term.select("item", F.col("at").alias("one"), F.col("term").alias("first")), ["item", "one"])
             .join(term.select("item", F.col("at").alias("two"), F.col("term").alias("second")), ["item", "two"]))
    left = index.postings.withColumnsRenamed({"term": "first", "pos": "p"})
    right = index.postings.withColumnsRenamed({"term": "second", "pos": "q"})
    near = (left.join(index.hint(pairs), "first").withColumn("cell", F.explode(F.array(
        *[F.floor(F.col("p") / reach) + d for d in (-1, 0, 1)])))
        .join(right.withColumn("cell", F.floor(F.col("q") / reach)), ["id", "text_hash", "second", "cell"])
        .where((F.abs(F.col("p") - F.col("q")) <= reach) & (F.col("p") != F.col("q"))))
    return (near.groupBy("id", "text_hash", "item", "item_id", "start").agg(F.lit(1).alias("one"))
            .groupBy("id", "text_hash", "item_id").agg(F.count("*").alias("windows")))


def _verified(found: Column, held: Column) -> Column:
    """(item_id, places): the words inside occurrences of a candidate's windows, by comparison."""

    def places(c: Column) -> Column:
        starts = F.filter(c["starts"], lambda s: F.slice(held, c["diagonal"] + s + 1, c["length"])
                          == F.slice(c["item_words"], s + 1, c["length"]))
        return F.flatten(F.transform(starts, lambda s: F.sequence(
            c["diagonal"] + s, c["diagonal"] + s + c["length"] - 1)))

    return F.filter(F.transform(found, lambda c: F.struct(
        c["item_id"].alias("item_id"), F.array_distinct(places(c)).alias("places"))), lambda x: F.size(x["places"]) > 0)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, text_hash, n_words, n_hit, items, contaminated) of each row of docs.

    n_hit counts the words inside any occurrence of `window` successive words of an item (of all
    its words, if it has fewer); items are the ids of items that occur, as sorted strings.
    Nulls and texts without words have no words; an item without words is none; repeated items
    count once, and items of one id together. Repeated rows of docs get equal results, and an
    empty table on either side gives no hits. Whole texts are read, however long; of terms that are
    equally rare the one further to the left counts as rarer; other columns, whatever their names,
    are not read.
    """
    index = build_index(docs, benchmark, id_col, text, item_id, item_text, window)
    told = index.hint(index.items.select("item", "item_id", "item_words", "length"))
    found = (candidates(index).distinct().join(told, "item")
             .where(F.expr("exists(starts, s -> diagonal + s >= 0)"))
             .withColumn("starts", F.filter("starts", lambda s: F.col("diagonal") + s >= 0))
             .groupBy(F.col("id").alias("found_id"), F.col("text_hash").alias("found_hash"))
             .agg(F.collect_list(F.struct("item_id", "diagonal", "starts", "item_words", "length")).alias("found")))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash"))
    judged = rows.join(found, same, "left").select("id", rows["text_hash"], let(plain_words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.when(F.col("found").isNotNull(), _verified(F.col("found"), w)).alias("hits"))).alias("j"))
    hit = F.size(F.array_distinct(F.flatten(F.transform("hits", lambda x: x["places"]))))
    return judged.select(F.col("id").alias(id_col), "text_hash", "j.n_words", "j.hits").select(
        id_col, "text_hash", "n_words", F.when(F.col("hits").isNotNull(), hit).otherwise(0).cast("long").alias("n_hit"),
        F.coalesce(F.array_sort(F.array_distinct(F.transform("hits", lambda x: x["item_id"]))),
                   F.array().cast("array<string>")).alias("items"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (LEAST_SHARE * F.col("n_hit") >= F.col("n_words")))
