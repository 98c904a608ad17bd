"""License scans by diagonal voting.

Every rolling pair of words of every text is joined to the places of the same pair in the
templates. A hit at text word p and template word t votes for the diagonal p - t. Votes on one
diagonal are counted, neighbouring diagonals (a word more or less in the text) are merged, and a
span counts where its votes hold, word for word, enough of the template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import PLAIN_WORD, let, lower_ascii, words, written

GRAM = 2
#: Fixed values of the contract: phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Longer wordings, by which the method finds labels of its own.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "this work is licensed under the cc by 4 0": "cc-by-4.0",
    "this work is licensed under the cc by sa 4 0": "cc-by-sa-4.0",
    "permission is hereby granted free of charge to any person obtaining a copy of this software"
    " and associated documentation files": "mit-text",
    "redistribution and use in source and binary forms with or without modification are permitted"
    " provided that the following conditions are met": "bsd-text",
    "all rights reserved": "all-rights-reserved",
}
#: A merged span counts from this share of a template's pairs on; diagonals this close are merged.
LEAST_SHARE, NEAR = 0.8, 2


def template_grams(spark: SparkSession, base: dict[str, str], more: dict[str, str]) -> DataFrame:
    """(gram, hash, template, label, exact, at, grams) of all templates; a fixed parameter's size."""
    rows = []
    for exact, group in ((True, base), (False, more)):
        for phrase, label in group.items():
            w = phrase.split(" ")
            if len(w) < GRAM:
                raise ValueError(f"a template needs {GRAM} words: {phrase!r}")
            rows += [(" ".join(w[i:i + GRAM]), phrase, label, exact, i, len(w) - GRAM + 1)
                     for i in range(len(w) - GRAM + 1)]
    table = spark.createDataFrame(
        rows, "gram string, template string, label string, exact boolean, at int, grams int")
    return table.withColumn("hash", F.xxhash64("gram"))


def _grams(text: Column) -> Column:
    return let(words(lower_ascii(text), PLAIN_WORD), lambda w: F.when(
        F.size(w) >= GRAM, F.transform(
            F.sequence(F.lit(0), F.size(w) - GRAM),
            lambda i: let(F.concat_ws(" ", *[F.get(w, i + k) for k in range(GRAM)]), lambda g: F.struct(
                i.alias("p"), F.xxhash64(g).alias("hash"), g.alias("gram"))))))


def spans(docs: DataFrame, keys: list[str], text: str, base: dict[str, str] = BASE,
          more: dict[str, str] = TEMPLATES) -> DataFrame:
    """(keys, template, label, exact, first, share) of every verified span.

    Equal rows of docs give their spans once; a text that is null, or has fewer words than a
    pair, gives none. The votes are written once, as exact and merged spans both read them.
    """
    table = F.broadcast(template_grams(docs.sparkSession, base, more).withColumnRenamed("gram", "same"))
    votes = written(
        docs.select(*keys, F.explode(_grams(F.col(text))).alias("g"))
        .select(*keys, "g.*")
        .join(table, "hash").where("gram = same")
        .groupBy(*keys, "template", "label", "exact", "grams", (F.col("p") - F.col("at")).alias("diagonal"))
        .agg(F.collect_set("at").alias("ats"))
    )
    by = Window.partitionBy(*keys, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by)
    started = F.sum(F.when(F.col("exact") | (apart <= NEAR), 0).otherwise(1)).over(by)
    exact = votes.where("exact AND size(ats) = grams").select(
        *keys, "template", "label", "exact", F.col("diagonal").alias("first"), F.lit(1.0).alias("share"))
    merged = (
        votes.where("NOT exact").withColumn("span", started)
        .groupBy(*keys, "template", "label", "exact", "grams", "span")
        .agg(F.min("diagonal").alias("first"),
             F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("held"))
        .withColumn("share", F.col("held") / F.col("grams"))
        .where(F.col("share") >= LEAST_SHARE)
        .select(*keys, "template", "label", "exact", "first", "share")
    )
    return exact.unionByName(merged)


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row.

    Labels are distinct, sorted and joined by commas, empty if there are none; score is the
    largest share of a template found. Null ids and texts, repeated rows and ids with several
    texts are rows like others: spans are kept by id and text hash. Whole texts are scanned, however
    long; templates that fit equally well all give their labels; an empty table gives an empty one;
    other columns, whatever their names, are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).withColumn(
        "hash_of", F.xxhash64("text"))
    found = spans(rows, ["id", "hash_of"], "text").groupBy("id", "hash_of").agg(
        F.count(F.when(F.col("exact"), 1)).alias("n_base"),
        F.min(F.when(F.col("exact"), F.col("first").cast("long"))).alias("first_word"),
        F.max(F.when(F.col("exact"), F.col("first").cast("long"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"))
    found = found.withColumnsRenamed({"id": "found_id", "hash_of": "found_hash"})
    sized = rows.select("id", "hash_of", F.size(words(lower_ascii(F.col("text")), PLAIN_WORD))
                        .cast("long").alias("n_words"))
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("hash_of") == F.col("found_hash"))
    return sized.join(found, same, "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
