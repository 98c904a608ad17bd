"""Language ID by nearest centroid.

A text is a vector of hashed character n-grams (1 to 3), weighed by logarithm of the count and
inverse document frequency and normalised. Every language has several centroids, clustered from
a bounded sample of its texts; a text takes the language of the centroid with the largest cosine.
A text that is much further away than texts of that language with as many distinct n-grams, which
were held out of the clustering, is rejected.
"""

from __future__ import annotations

import dataclasses
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 12
DIMS = 1 << BITS
#: Bounds of the fit: texts by language, texts of all languages, centroids a language.
SAMPLE_EACH, SAMPLE_ALL, CENTROIDS = 250, 4000, 3
#: A text is rejected below this share of the cosine that nearly all held-out texts of its language
#: and of as many distinct n-grams reach (all but REJECT_TAIL of them).
REJECT_SHARE, REJECT_TAIL = 0.7, 0.01
#: Held-out texts: folds, code points of the beginnings that are judged as texts of their own
#: besides the whole text, and how many cosines a number of n-grams needs to be judged by its own.
FOLDS, BEGINNINGS, ENOUGH = 5, (12, 25, 50, 100, 200, 400, 800, 1600), 20
#: The share for a language of too few texts to hold any out, of the cosine its learnt texts reach.
UNTESTED_SHARE = 0.2
#: Logarithms (base 2) of the numbers of distinct n-grams for which a least cosine is learnt.
STEPS = np.arange(2, BITS + 0.5, 0.5)
UNKNOWN = "und"
_CHUNK = 1 << 20


def _letters() -> np.ndarray:
    """For each code point 1 if it is a letter; made once a Python worker."""
    if "_llm_letters" not in sys.__dict__:
        sys.__dict__["_llm_letters"] = np.fromiter(
            (chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return sys.__dict__["_llm_letters"]


def gram_counts(text: str) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text, or None if it has no letter.

    Letters are lower-cased, each run of other characters is one space, and n-grams of spaces
    alone don't count. Long texts are counted in chunks that overlap by two characters.
    """
    is_letter = _letters()
    total, before = np.zeros(DIMS, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    any_letter = False
    for at in range(0, len(text), _CHUNK):
        codes = np.frombuffer(text[at:at + _CHUNK].lower().encode("utf-32-le", "surrogatepass"), "<u4")
        known = is_letter[codes]
        any_letter |= bool(known.any())
        codes = np.where(known, codes, 0).astype(np.uint64)
        codes = np.concatenate((before, codes if len(before) or at else np.concatenate(([np.uint64(0)], codes))))
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
        codes = codes[keep]
        fresh = min(len(before), 2)
        one = codes * np.uint64(0x9E3779B97F4A7C15)
        two = one[:-1] * np.uint64(31) + codes[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        three = two[:-1] * np.uint64(31) + codes[2:] * np.uint64(0x165667B19E3779F9)
        for n, gram in ((1, one), (2, two), (3, three)):
            if len(gram) == 0 or n == 1:
                gram = gram[codes[:len(gram)] != 0]
            gram = gram[max(0, fresh + 1 - n):] if n > 1 else gram[int((codes[:fresh] != 0).sum()):]
            mixed = (gram + np.uint64(n)) * np.uint64(0xFF51AFD7ED558CCD)
            total += np.bincount((mixed >> np.uint64(64 - BITS)).astype(np.int64), minlength=DIMS)
        before = codes[-2:]
    return total if any_letter else None


def _weighed(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vector = np.log1p(counts) * idf
    norm = np.sqrt(vector @ vector)
    return vector / norm if norm else vector


def held_out(id_col: str | Column) -> Column:
    """True for a fifth of the ids, which the fit must not see; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    """centroids: a row each, with its language's place in langs and the least cosine for each of
    STEPS, between which it is interpolated."""

    langs: list[str]
    lang_of: np.ndarray
    centroids: np.ndarray
    least: np.ndarray
    idf: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, rejected); a text without letters is unknown and rejected."""
        counts = gram_counts(text) if text else None
        if counts is None or not len(self.centroids):
            return UNKNOWN, 0.0, True
        held = np.flatnonzero(counts)
        vector = np.log1p(counts[held]) * self.idf[held]
        cosine = self.centroids[:, held] @ vector / (np.sqrt(vector @ vector) or 1.0)
        best = int(np.argmax(cosine))
        score = float(min(1.0, max(0.0, cosine[best])))
        least = np.interp(np.log2(len(held)), STEPS, self.least[best])
        return self.langs[self.lang_of[best]], score, bool(score < least)


def cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(unit centroids, place of each vector) by cosine k-means, begun with the first k vectors."""
    centroids = vectors[:k]
    for _ in range(rounds):
        of = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([vectors[of == i].sum(axis=0) if (of == i).any() else centroids[i]
                         for i in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids, np.argmax(vectors @ centroids.T, axis=1)


def _document_frequencies(rows: DataFrame) -> np.ndarray:
    """How many of the texts hold each hashed n-gram; at the end, how many there are with letters."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(DIMS + 1, dtype=np.int64)
        for batch in batches:
            for x in batch.column(0):
                counts = gram_counts(x.as_py() or "")
                if counts is not None:
                    held[:-1] += counts > 0
                    held[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1)), pa.array(held)], ["dim", "held"])

    found = np.zeros(DIMS + 1)
    summed = rows.select("text").mapInArrow(counted, "dim long, held long").groupBy("dim").agg(F.sum("held"))
    for dim, held in summed.collect():  # one row a dimension
        found[dim] = held
    return found


def _sample(rows: DataFrame, langs: dict[str, int], each: int, seed: int) -> list[tuple[str, np.ndarray, str]]:
    """(language, counts, beginning) of at most `each` texts of each language, those with the
    smallest hashes of id and text."""
    space = 1 << 40
    share = F.create_map(*[x for lang, n in langs.items() for x in (
        F.lit(lang), F.lit(int(space * min(1.0, 2.0 * each / n))))])
    rank = F.pmod(F.xxhash64("id", "text", F.lit(seed)), F.lit(space))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for lang, rank, text in batch.to_pylist() and zip(*batch.to_pydict().values(), strict=True):
                counts = gram_counts(text or "")
                if counts is not None:
                    kept.append((lang, rank, counts.astype("<i4").tobytes(), text[:BEGINNINGS[-1]].encode(
                        "utf-8", "surrogatepass")))
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*kept, strict=True), (
                        pa.string(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                    ["lang", "rank", "counts", "beginning"])

    chosen = rows.withColumn("rank", rank).where(F.col("rank") < F.element_at(share, F.col("lang")))
    got = sorted(map(tuple, chosen.select("lang", "rank", "text").mapInArrow(
        counted, "lang string, rank long, counts binary, beginning binary").collect()))
    found, taken = [], {}
    for lang, _, counts, beginning in got:
        taken[lang] = taken.get(lang, 0) + 1
        if taken[lang] <= each:
            found.append((lang, np.frombuffer(counts, "<i4"), bytes(beginning).decode("utf-8", "surrogatepass")))
    return found


def _held_out_cosines(vectors: np.ndarray, texts: list[tuple[np.ndarray, str]], idf: np.ndarray,
                      centroids: int) -> list[tuple[int, float]]:
    """(distinct n-grams, cosine with the language) of each text and its beginnings, with a fold of
    the texts held out at a time; copies of a text are in one fold."""
    found = []
    fold = np.array([zlib.crc32(x.encode("utf-8", "surrogatepass")) % FOLDS for _, x in texts])
    for out in range(FOLDS):
        seen = vectors[fold != out]
        if len(seen) < FOLDS:
            continue
        centres, _ = cluster(seen, centroids)
        for place in np.flatnonzero(fold == out).tolist():
            counts, text = texts[place]
            parts = [counts] + [gram_counts(text[:n]) for n in BEGINNINGS if n < len(text)]
            for part in parts:
                if part is not None:
                    found.append((int((part > 0).sum()), float((centres @ _weighed(part, idf)).max())))
    return found


def _least_cosines(found: list[tuple[int, float]]) -> np.ndarray | None:
    """The least cosine for each of STEPS, or None if too few are known. It never falls as a text
    grows; steps of too few cosines take theirs from those beside them."""
    step = np.rint(2 * (np.log2([n for n, _ in found] or [1]) - STEPS[0])).clip(0, len(STEPS) - 1)
    cosines = np.array([x for _, x in found] or [0.0])
    known = [i for i in range(len(STEPS)) if (step == i).sum() >= ENOUGH]
    if not known:
        return None
    least = [REJECT_SHARE * np.quantile(cosines[step == i], REJECT_TAIL) for i in known]
    least = np.minimum.accumulate(least[::-1])[::-1]
    return np.interp(STEPS, STEPS[known], least)


def fit(labelled: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
        sample_each: int = SAMPLE_EACH, sample_all: int = SAMPLE_ALL, centroids: int = CENTROIDS,
        seed: int = 0) -> Model:
    """A model of all labelled rows: frequencies over all of them, centroids of a sample.

    The sample has at most sample_each texts a language and sample_all in all; languages are
    therefore at most sample_all, more raise an error. Null texts and languages are left out;
    without rows the model knows no language and rejects everything.
    """
    rows = labelled.select(
        F.col(id_col).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    langs = dict(rows.groupBy("lang").count().limit(sample_all + 1).collect())
    if len(langs) > sample_all:
        raise ValueError(f"over {sample_all} languages")
    if not langs:
        return Model([], np.zeros(0, int), np.zeros((0, DIMS)), np.zeros((0, len(STEPS))), np.ones(DIMS))
    held = _document_frequencies(rows)
    idf = np.log((1 + held[-1]) / (1 + held[:-1])) + 1
    by_lang: dict[str, list[tuple[np.ndarray, str]]] = {}
    for name, counts, beginning in _sample(rows, langs, min(sample_each, sample_all // len(langs)), seed):
        by_lang.setdefault(name, []).append((counts, beginning))
    names, of, found, least = sorted(by_lang), [], [], []
    for place, name in enumerate(names):
        vectors = np.stack([_weighed(x, idf) for x, _ in by_lang[name]])
        centres, near = cluster(vectors, centroids)
        cosines = (vectors * centres[near]).sum(axis=1)
        found += list(centres)
        of += [place] * len(centres)
        tested = _least_cosines(_held_out_cosines(vectors, by_lang[name], idf, centroids))
        if tested is None:
            tested = np.full(len(STEPS), UNTESTED_SHARE * np.quantile(cosines, REJECT_TAIL))
        least += [tested] * len(centres)
    return Model(names, np.array(of, int), np.array(found), np.array(least), idf)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred, score and rejected; columns of these names are replaced.

    A text that is null or has no letter is `und` with score 0, and rejected; of equally near
    centroids the first is taken. Nothing but the text is read, whole. Repeated rows get equal
    results, an empty table gives an empty one. The model is sent along as plain arrays, so that a
    task needs no copy of this package; its size is bounded by the bounds of the fit.
    """
    sent = docs.sparkSession.sparkContext.broadcast(dataclasses.astuple(model))

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Model(*sent.value)
        for texts in batches:
            found = [known.predict(x.as_py()) for x in texts]
            yield pa.StructArray.from_arrays(
                [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()),
                 pa.array([x[2] for x in found], pa.bool_())], ["lang_pred", "score", "rejected"])

    found = docs.withColumn("_found", predicted(text)).drop("lang_pred", "score", "rejected")
    return found.select(*[F.col(f"`{x}`") for x in found.columns if x != "_found"], "_found.*")
