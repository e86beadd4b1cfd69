"""Counts against plain loops; the model against labels of the corpus."""

import re
from collections import Counter

from lexmill.llm import quality

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = [w for w in SPACE.split(text) if w]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if SPACE.sub("", x)]
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed


def test_counts(spark, rows, rng):
    pool = ["a", "b", "été", "日本", "x#", "<b>", "\n", "\n", "\x0b", "\x1c", "\xa0"]
    texts = ["".join(rng.choice([" ", "", "\t"]) + rng.choice(pool) for _ in range(rng.randrange(300))) for _ in range(60)]
    texts += [None, "", "   \n \n", "w " * 20_000, "a b c d e f g h " * 2, "a b c d e f g h", "x\n x\nx\n\n\nx "]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    pairs = [*enumerate(texts), (None, "a"), (0, texts[0])]
    got = quality.rated(rows(pairs)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert sorted([tuple(r)[:7] for r in got], key=repr) == sorted([(i, *brute(t)) for i, t in pairs], key=repr)
    assert not any(r.kept for r in got if r.base_failed)


def test_verdicts_follow_labels(spark):
    sf = "/root/testdata/sf0.01"
    rated = quality.rated(spark.read.parquet(f"{sf}/documents.parquet"))
    seen = rated.where("NOT base_failed").join(spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("quality", "label"), "doc_id").select("label", "kept").collect()
    good, bad = [r.kept for r in seen if r.label == 1], [r.kept for r in seen if r.label == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.15


def test_model_finds_accuracies(rng):
    counts = Counter()
    truth = [0.95, 0.9, 0.85, 0.9, 0.8, 0.9, 0.9, 0.9]
    for _ in range(20_000):
        good = rng.random() < 0.7
        counts[tuple(1 if rng.random() < 0.4 else 2 * (good == (rng.random() < a)) for a in truth)] += 1
    model = quality.LabelModel(list(counts.items()))
    assert abs(model.share - 0.7) < 0.05  # what is assumed of a vote draws it a little
    assert model.accuracy.min() > 0.7
    assert model.posterior(quality.np.array([[0] * 8, [2] * 8])).round(2).tolist() == [0.0, 1.0]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, votes string")
    assert quality.rated(docs).count() == 0
