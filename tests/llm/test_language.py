"""Language identification: held-out accuracy, rejection and awkward rows."""

import base64
import os
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
from helpers import awkward, documents, nothing
from pyspark.sql import functions as F

from reviewloom.llm import language

DATA = "/root/testdata/sf0.01/documents.parquet"
ITALIAN = ("Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita. Ahi"
           " quanto a dir qual era è cosa dura questa selva selvaggia e aspra e forte che nel pensier rinova la paura.")
POLISH = ("Litwo, ojczyzno moja, ty jesteś jak zdrowie, ile cię trzeba cenić, ten tylko się dowie, kto cię stracił."
          " Dziś piękność twą w całej ozdobie widzę i opisuję, bo tęsknię po tobie.")
FINNISH = ("Mieleni minun tekevi, aivoni ajattelevi lähteäni laulamahan, saa'ani sanelemahan, sukuvirttä suoltamahan,"
           " lajivirttä laulamahan. Sanat suussani sulavat, puhe'et putoelevat.")


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DATA).select("doc_id", "text", "lang", language.held_out("doc_id").alias("out"))
    model = language.fit(docs.where("NOT out"))
    found = language.identify(docs, model).where("out AND length(text) >= 200")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.97
    assert len(model.centroids) <= 4 * language.CENTROIDS
    assert found.where("score < 0 OR score > 1").isEmpty()


def test_far_texts_are_rejected(spark):
    docs = spark.read.parquet(DATA).select("doc_id", "text", "lang")
    model = language.fit(docs)
    texts = ["Ж" * 400, "漢字仮名" * 50, "the thing is in the other and for that of this", "12 34 !!", "", None]
    rows = sorted(language.identify(documents(spark, texts), model).collect(), key=lambda r: r.doc_id)
    assert [r.rejected for r in rows] == [True, True, False, True, True, True]
    assert [r.lang_pred for r in rows[3:]] == ["und"] * 3


def test_gibberish_and_unlearned_languages_are_rejected(spark):
    rng = random.Random(1)
    docs = spark.read.parquet(DATA).select("doc_id", "text", "lang", language.held_out("doc_id").alias("out"))
    model = language.fit(docs.where("NOT out"))
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(4000))
    far = [letters, letters[:600], base64.b64encode(rng.randbytes(900)).decode(), ITALIAN, POLISH, FINNISH]
    assert [model.predict(x)[2] for x in far] == [True] * len(far)
    assert model.predict("That it.")[2] is False
    kept = language.identify(docs.where("out AND text RLIKE '[A-Za-z]'"), model)
    assert kept.where("rejected").isEmpty()


def test_learns_from_nothing_but_labelled_texts(spark):
    rows = [(i, "aaa bbb ccc", "x") for i in range(5)] + [(9, "ddd eee fff", None), (10, None, "y")]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["x"]
    none = language.fit(nothing(spark))
    assert none.predict("any text") == ("und", 0.0, True)


def test_counts_do_not_depend_on_the_chunks(monkeypatch):
    text = "Ein Wort, zwei Wörter!  Ça va? 123 ok " * 20
    whole = language.gram_counts(text)
    for chunk in (7, 50, 64):
        monkeypatch.setattr(language, "_CHUNK", chunk)
        assert (language.gram_counts(text) == whole).all()


def test_ids_are_told_apart_by_their_checksum(spark):
    import zlib

    rows = spark.range(200).select("id", language.held_out("id").alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_clusters_are_unit_vectors():
    vectors = np.abs(np.random.default_rng(0).normal(size=(50, 8)))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    centres, of = language.cluster(vectors, 3)
    assert np.allclose(np.linalg.norm(centres, axis=1), 1) and len(of) == 50


def test_awkward_rows(spark):
    model = language.fit(spark.read.parquet(DATA).limit(200))
    rows = language.identify(awkward(spark), model).collect()
    assert len(rows) == 13 and all(r.id == "a" for r in rows)
    assert language.identify(nothing(spark), model).count() == 0


def test_runs_where_tasks_lack_the_package(tmp_path):
    """Executors get no copy of the package: a cluster of one worker process, started elsewhere."""
    code = f"""
import sys
sys.path.insert(0, {str(Path(language.__file__).parents[2])!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local-cluster[1,1,1024]").config("spark.ui.enabled", "false")
         .config("spark.executorEnv.PYTHONPATH", "").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
from reviewloom.llm import language
rows = [(i, x, y) for i, (x, y) in enumerate([("the thing and that", "en"), ("der die und das", "de")] * 9)]
docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
print([r.lang_pred for r in language.identify(docs, language.fit(docs)).limit(2).collect()])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True,
                          timeout=240)
    assert "['en', 'de']" in done.stdout, done.stderr[-2000:]
