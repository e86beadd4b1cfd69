"""Held-out accuracy, mixed texts, and Viterbi against every labelling."""

import itertools
import zlib

import numpy as np
import pytest

from lexmill.llm import language

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return language.learn(spark.read.parquet(f"{SF}/documents.parquet"))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.identify(docs.select("doc_id", "lang", "text", language.held_out("doc_id").alias("held_out")), model, spans=False).collect()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.language.lang_pred in model.langs and 0 <= r.language.score <= 1
    own = [r.language.lang_pred == r.lang for r in found if r.held_out and r.lang]
    assert len(own) > 100 and sum(own) / len(own) > 0.97


def test_mixed_text_falls_into_spans(spark, model):
    docs = {r.lang: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) between 1000 and 2000").collect()}
    text = docs["en"][:700] + " " + docs["es"][:400]
    [got] = language.predict(model, [text], True)
    assert got["lang_pred"] == "en" and 0.5 < got["score"] < 0.8
    assert [s["lang"] for s in got["spans"]] == ["en", "es"]
    assert abs(got["spans"][1]["start"] - 700) < 40 and got["spans"][0]["start"] == next(i for i, c in enumerate(text) if c.isalpha())


def test_no_letters_ties_and_long_texts(model):
    got = language.predict(model, [None, "", " 12 !!", "12٣", "a " * 30_000, "日本語のテキスト", "the " * 5], False)
    assert [x["lang_pred"] == "und" for x in got] == [True] * 4 + [False] * 3
    assert all(x["score"] == 0 for x in got[:4])


def test_labels_are_the_best_path():
    draw = np.random.default_rng(1)
    class Some:
        langs = ["a", "b", "c"]
    bounds = np.array([0, 5, 5, 6, 11])
    scores = (draw.random((11, 3)) * 20).astype(np.float32)
    got = language.labels(Some, scores, bounds)
    for a, b in itertools.pairwise(bounds):
        def value(path, a=a):
            return sum(float(scores[a + i, s]) for i, s in enumerate(path)) - language.SWITCH * sum(x != y for x, y in itertools.pairwise(path))
        best = max(itertools.product(range(3), repeat=b - a), key=value)
        assert abs(value(got[a:b]) - value(best)) < 1e-3


def test_scripts_narrow(spark):
    rows = [(i, t, g) for i, (t, g) in enumerate([("мир и дружба", "ru"), ("peace and war", "en"), ("peace again", None), (None, "xx")] * 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    learned = language.learn(docs)
    assert learned.langs == ["en", "ru"]
    assert [x["lang_pred"] for x in language.predict(learned, ["qqq zzz", "щщщ", "ελληνικά"], False)][:2] == ["en", "ru"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, language string")
    model = language.learn(docs)
    assert model.langs == [] and language.identify(docs, model).count() == 0
    some = spark.createDataFrame([(1, "text", None, "x")], docs.schema)
    assert language.identify(some, model).first().language.lang_pred == "und"
