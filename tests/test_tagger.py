"""Learned taggers against all paths tried one by one, and against the labels they were learned from."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from lexmill import annotate
from lexmill.operators import documents, tagger

TRAINING = [
    "the/D dog/N runs/V ./.", "the/D cat/N sees/V the/D dog/N ./.", "dogs/N run/V ./.", "a/D run/N ends/V ./.", "the/D old/A dog/N barks/V ./.",
    "Ann/P sees/V Bob/P ./.", "the/D 3/C cats/N walked/V ./.", "an/D old/A man/N walked/V slowly/R ./.",
]


def rows(spark, sentences):
    split = [[x.rsplit("/", 1) for x in s.split()] for s in sentences]
    tokens = [(0, i, k, w, t) for i, s in enumerate(split) for k, (w, t) in enumerate(s)]
    return tagger.labelled(spark.createDataFrame(tokens, "doc_id bigint, sent_idx bigint, tok_in_sent bigint, token string, tag string"), ["doc_id"])


@pytest.fixture(scope="module")
def counts(spark):
    return tagger.train(rows(spark, TRAINING), "tag").cache()


def test_counts(counts):
    got = {(r.kind, r.context, r.tag): r.n for r in counts.collect()}
    assert got["move", "", "D"] == 6 and got["move", "D", "N"] == 4 and got["move", ".", ""] == 8
    assert got["word", "dog", "N"] == 3 and got["word", "run", "V"] == got["word", "run", "N"] == 1
    assert got["word", "ann", "P"] == 1 and ("word", "Ann", "P") not in got  # its capital is no sign, being first
    assert got["end", "ls", "V"] == 5 and got["end", "Cbob", "P"] == 1 and got["end", "d3", "C"] == 1
    assert sum(n for (kind, *_), n in got.items() if kind == "word") == sum(len(s.split()) for s in TRAINING)


def score(model, words, path):
    at = [model.tags.index(t) for t in path]
    total = model.begin[at[0]]
    for i, (w, t) in enumerate(zip(words, at, strict=True)):
        total = total + model.scores(w, i == 0, model.words)[t]
        if i:
            total = total + model.moves[t, at[i - 1]]
    return total + model.end[at[-1]]


def test_best_path_of_all(counts):
    model = tagger.tagger(counts).model
    rng = random.Random(3)
    words = sorted({x.rsplit("/", 1)[0] for s in TRAINING for x in s.split()}) + ["walking", "Zed", "7", "?", "zzz", "The"]
    sentences = [rng.choices(words, k=rng.randrange(1, 5)) for _ in range(40)]
    for sentence, path in zip(sentences, model.paths(sentences), strict=True):
        every = [score(model, sentence, p) for p in itertools.product(model.tags, repeat=len(sentence))]
        assert score(model, sentence, path) == pytest.approx(max(every), abs=1e-9)


def test_probabilities(counts):
    model = tagger.tagger(counts).model
    for scores in (model.begin, *[model.moves[:, i] for i in range(len(model.tags))]):
        assert 0 < sum(map(math.exp, scores)) <= 1 + 1e-9
    seen = model.scores("run", False, model.words)
    assert math.exp(seen[model.tags.index("N")]) == pytest.approx(1 / 8) and seen[model.tags.index("A")] == -math.inf


def test_unknown_words_by_their_endings(counts):
    [path] = tagger.tagger(counts).model.paths(["the old zogs jumped 55 Tims .".split()])
    assert path[0] == "D" and path[3] == "V" and path[4] == "C" and path[5] == "P" and path[6] == "."


def test_both_ways_to_hold_the_words(spark, docs, counts):
    frame = documents.marked(docs("The dog runs. Ann sees a zog.", None, "", "Bob walked. The the", "dogs " * 3000), ["doc_id"])
    held = [sorted(tagger.with_tags(frame, ["doc_id"], tagger.tagger(counts, size), "tags").select("doc_id", "tags").collect()) for size in (0, 1 << 20)]
    assert held[0] == held[1]
    assert [[len(s) for s in r.tags] for r in held[0]] == [[4, 5], [], [], [3, 2], [3000]]
    assert held[0][0].tags[0] == ["D", "N", "V", "."]


def test_odd_labels(spark):
    odd = spark.createDataFrame([([["a", "b"], ["c"]], [["X", None], ["Y"]]), (None, None), ([], []), ([["d"]], [["Z"]]), ([[]], [[]])],
                                "toks array<array<string>>, tag array<array<string>>")
    got = {(r.kind, r.context, r.tag) for r in tagger.train(odd, "tag").collect() if r.kind != "end"}
    assert got == {("word", "c", "Y"), ("word", "d", "Z"), ("move", "", "Y"), ("move", "Y", ""), ("move", "", "Z"), ("move", "Z", "")}
    with pytest.raises(ValueError, match="no labelled sentence"):
        tagger.tagger(tagger.train(odd.limit(0), "tag"))


def test_lemmas(spark):
    forms = [("dogs", "NNS", "dog"), ("cats", "NNS", "cat"), ("flies", "NNS", "fly"), ("cries", "NNS", "cry"), ("mice", "NNS", "mouse"), ("went", "VBD", "go"),
             ("walked", "VBD", "walk"), ("Bob", "NNP", "Bob"), ("the", "DT", "the")]
    frame = spark.createDataFrame([([[f[0]]], [[f[1]]], [[f[2]]]) for f in forms], "toks array<array<string>>, pos array<array<string>>, lems array<array<string>>")
    learned = tagger.lemmatizer(tagger.train_lemmas(frame))
    assert [learned.lemma(w, t) for w, t, _ in forms] == [lemma for *_, lemma in forms]
    assert [learned.lemma(*x) for x in (("birds", "NNS"), ("skies", "NNS"), ("Tim", "NNP"), ("talked", "VBD"), ("x", "ZZ"), ("dormice", "NNS"))] == [
        "bird", "sky", "Tim", "talk", "x", "dormouse"]
    with pytest.raises(ValueError, match="too many"):
        tagger.lemmatizer(tagger.train_lemmas(frame), 10)


def test_shorter_endings_give_the_same_edits(spark):
    """What is left out, since the next shorter ending says the same, changes nothing."""
    rng = random.Random(5)
    forms = [("".join(rng.choices("ab", k=rng.randrange(1, 8))), rng.choice(["N", "V"])) for _ in range(150)]
    data = [([[w]], [[t]], [[w[:len(w) - rng.randrange(min(3, len(w)))] + rng.choice(["", "", "a"])]]) for w, t in forms]
    counts = tagger.train_lemmas(spark.createDataFrame(data, "toks array<array<string>>, pos array<array<string>>, lems array<array<string>>"))
    best = {}
    for r in sorted(counts.collect(), key=lambda r: (-r.n, r.tag)):
        best.setdefault(r.context, r.tag)
    full, lean = tagger.Lemmatizer(best), tagger.lemmatizer(counts)
    assert len(lean.edits) < len(full.edits)
    for n in range(1, 9):
        for word in map("".join, itertools.product("ab", repeat=n)):
            assert [lean.lemma(word, t) for t in "NV"] == [full.lemma(word, t) for t in "NV"]


def test_learned_from_the_rules(docs, spark):
    """Tags learned from what the rules say come close to it, and every annotator reads them."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").repartition(8)
    own = documents.analysed(table, ["doc_id"], ["pos", "lems", "ner"]).cache()
    labels = own.where("doc_id % 2 = 0")
    learned = {name: tagger.tagger(tagger.train(labels, name).cache()) for name in ("pos", "ner")} | {"lemma": tagger.lemmatizer(tagger.train_lemmas(labels).cache())}
    new = documents.analysed(table, ["doc_id"], ["pos", "lems", "ner"], taggers=learned, gazetteer=[])
    for layer, least in (("pos", 0.9), ("lems", 0.95), ("ner", 0.95)):
        both = new.where("doc_id % 2 = 1").select("doc_id", F.flatten(layer).alias("a")).join(own.select("doc_id", F.flatten(layer).alias("b")), "doc_id")
        got = both.select(F.sum(F.size("a")).alias("n"), F.sum(F.size(F.filter(F.zip_with("a", "b", lambda x, y: x == y), lambda x: x))).alias("same")).first()
        assert got.same > least * got.n, (layer, got)
    assert annotate(docs("They ran fast."), "lemma", taggers={"lemma": learned["lemma"]}).first().result.split()[::3] == ["they", "."]
    results = {r.functionality: r.result for r in annotate(docs("They ran fast."), "pos,lemma,ner,parse,coref", taggers=learned).collect()}
    assert results["parse"].startswith("(S ") and len(results["pos"].split()) == 4
