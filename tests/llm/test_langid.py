import zlib

import numpy as np
import pytest
from tracewright.llm import langid


def test_query_held_out_accuracy(spark):
    rows = langid.op4_language(spark, "/root/testdata/sf0.01").collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    assert right / len(held) > 0.97


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    words = {"xx": ["thori", "mag", "unde", "sal"], "yy": ["quelle", "noir", "beau", "tre"], "zz": ["ungen", "schaft", "keit", "der"]}
    texts = {lang: " ".join(rng.choice(w, 4000)) for lang, w in words.items()}
    counts = np.array([langid.trigrams(texts[lang]) for lang in words]).T
    return texts, np.log((counts + 0.5) / (counts + 0.5).sum(axis=0))


def test_mixtures(model):
    texts, log_p = model
    xx, yy, zz = texts.values()
    assert [i for i, _ in langid.languages(xx[:500], log_p)] == [0]
    both = dict(langid.languages(xx[:6000] + " " + yy[:2000], log_p))
    assert set(both) == {0, 1} and both[0] == pytest.approx(0.75, abs=0.05)
    assert set(dict(langid.languages(" ".join((xx, yy, zz)), log_p))) == {0, 1, 2}


def test_likelihood_rises(model):
    texts, log_p = model
    counts = langid.trigrams(texts["xx"][:3000] + texts["zz"][:1000]).astype(float)
    p = np.exp(log_p)
    value = lambda s: counts @ np.log(p @ s)
    share, best = langid.proportions(p, counts)
    assert best == pytest.approx(value(share)) and share.sum() == pytest.approx(1)
    grid = [np.array([a, b, 1 - a - b]) for a in np.linspace(0.01, 0.98, 30) for b in np.linspace(0.01, 0.98, 30) if a + b < 0.995]
    assert best >= max(map(value, grid)) - 0.5


def test_odd_rows(spark):
    rows = [(1, "the of the and to the", "en", 1.0), (2, None, "en", 1.0), (3, "", None, 1.0), (4, "123 ... ", "en", 1.0), (5, "der die das und", "de", 1.0), (None, "und der die", "de", 1.0), (6, "é" * 100_000, None, 1.0), (6, "é" * 100_000, None, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = langid.language_id(df).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in (2, 3, 4)] == ["und"] * 3 and by[2]["score"] == 0
    assert by[6]["lang_pred"] in ("en", "de")
    nothing = langid.language_id(df.withColumn("lang", df["text"].substr(1, 0).cast("string")).filter("doc_id = 2")).collect()
    assert [r["lang_pred"] for r in nothing] == ["und"]
    assert langid.language_id(df.limit(0)).count() == 0


def test_recognised(spark):
    rows = [(1, "the of the and to the", "en", 1), (5, "der die das und", "de", 2), (7, "42", "en", 3), (8, None, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, mixture int")
    kept = langid.recognised(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 5]
