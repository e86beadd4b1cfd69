"""How often and where a plan works things out."""

import gc
import pickle
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.operators import dictionary, documents, phrases, tagger


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_labels_are_read_once(spark, docs):
    own = documents.analysed(docs("The dog runs. Ann sees a zog."), ["doc_id"], ["pos", "lems"])
    for counts in (tagger.train(own, "pos"), tagger.train_lemmas(own)):
        assert plan(counts).count("Scan") == 1


def test_words_and_moves_are_shuffled_apart(docs):
    """Not together first, of which there are far more."""
    own = documents.analysed(docs("The dog runs. Ann sees a zog."), ["doc_id"], ["pos", "lems"])
    text = plan(tagger.train(own, "pos"))
    assert text.count("Exchange") == 3 and "before" not in "".join(line for line in text.split("\n") if "Exchange" in line)


def test_a_large_lexicon_goes_to_blocks_of_documents(spark, docs):
    """Not to every document on its own; for all taggers at once, and with the same tags."""
    frame = docs("The dog runs. Ann sees a zog.", None, "", "Bob walked. The the", "\u0130s dogs " * 3000, *(f"Ann sees dog {i}." for i in range(300)))
    frame = frame.union(frame.limit(1)).union(spark.createDataFrame([(None, "A dog runs. Bob"), (None, "A cat")], frame.schema))
    own = documents.analysed(frame, ["doc_id"], ["pos", "ner"]).where("doc_id % 3 != 1").cache()
    counts = {name: tagger.train(own, name).cache() for name in ("pos", "ner")}

    def tagged(sizes):
        return documents.analysed(frame, ["doc_id"], ["pos", "ner"], gazetteer=[], taggers={n: tagger.tagger(c, sizes[n]) for n, c in counts.items()})
    by_sent = tagged({"pos": 1 << 20, "ner": 1 << 20})
    want = sorted(by_sent.collect(), key=repr)
    for sizes in ({"pos": 0, "ner": 0}, {"pos": 0, "ner": 1 << 20}):
        by_block = tagged(sizes)
        assert sorted(by_block.collect(), key=repr) == want
        text = plan(by_block)
        assert "Join" not in text and "FlatMapCoGroupsInArrow" in text


@pytest.mark.parametrize("lengths", [[1], [3, 3, 2, 1], [1] * 50 + [40]])
def test_tags_of_a_batch_are_those_of_its_sentences(spark, lengths):
    rows = spark.createDataFrame([([["a", "b", "a", "c"]], [["X", "Y", "X", "Z"]]), ([["b", "a"]], [["X", "Y"]])], "toks array<array<string>>, tag array<array<string>>")
    model = tagger.tagger(tagger.train(rows, "tag")).model
    rng = np.random.default_rng(1)
    sentences = [rng.choice(["a", "b", "c", "zz"], n).tolist() for n in lengths]
    assert model.paths(sentences) == [model.paths([s])[0] for s in sentences]


def test_offsets_are_summed_by_batch(docs):
    frame = docs("Ab c. D\U0001f600 e?  F", None, " ", "", "x " * 3000)
    rows = documents.tokens_table(frame, ["doc_id"])
    assert "ArrowEvalPython" in plan(rows) and "aggregate(" not in plan(rows)
    joined = rows.join(frame, "doc_id").select("*", F.expr("substr(text, begin_off + 1, end_off - begin_off)").alias("there"))
    got = joined.collect()
    assert len(got) > 3000 and [r for r in got if r.token != r.there] == []


def test_rows_are_worked_out_as_rows(docs):
    """Not in a list of structs that is made first and unfolded then."""
    frame = docs("The big dog saw her cat in New York.")
    for rows, word in ((documents.chunks_table(frame, ["doc_id"]), "array_join"), (documents.edges_table(frame, ["doc_id"]), "nsubj"), (documents.first_governors(frame, ["doc_id"]), "nsubj")):
        lines = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().split("\n") if word in line]
        assert lines and not any("lambda" in line for line in lines)


def test_a_trie_is_small():
    """Its Python objects take less than 24 times the bytes of its phrases."""
    rules = [(f"word{i} name{i * 7 % 5000}", "T") for i in range(20000)]
    size = sum(len(phrase) + 1 for phrase, _ in rules)
    trie = pickle.loads(pickle.dumps(phrases.Trie(rules)))
    tracemalloc.start()
    gc.collect()
    other = pickle.loads(pickle.dumps(phrases.Trie(rules)))
    assert other.spans(["word3", "name21", "word4", "x"]) == [(0, 2, "T")] == trie.spans(["word3", "name21", "word4", "x"])
    used = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert used < 24 * size


def test_entities_need_no_tags(docs):
    """Shapes are told from the tokens, so that a request for entities finds no part of speech."""
    assert "VBG" not in plan(documents.analysed(docs("The dog runs."), ["doc_id"], ["ner"]))


def test_only_sentences_with_names_or_pronouns_are_analysed(docs):
    frame = documents.marked(docs("It ran. Then Ann spoke. paris grew. Paris grew. THEIR dog. a 7 dog.", "no name.", ""), ["doc_id"])

    def layers(**options):
        return documents.layered(frame, ["mentions"], ["doc_id"], **options).orderBy("doc_id")
    options = {"rules": [("a 7", "PERSON"), ("grew", "X")]}
    rows = layers(sparing=True, **options).select("at", "toks", "mentions").collect()
    assert [r["at"] for r in rows] == [[1, 3, 4, 5], [], []] and [len(r.toks) for r in rows] == [4, 0, 0]
    every = layers(**options).select("mentions").collect()
    assert [[(i, m) for i, m in zip(r["at"], r.mentions) if m] for r in rows] == [[(i, m) for i, m in enumerate(r.mentions) if m] for r in every]
    table = phrases.Trie([("no", "LOCATION")])
    assert [r["at"] for r in layers(sparing=True, gazetteer=table).select("at").collect()] == [[1, 4], [0], []]


def test_relations_need_names(docs):
    frame = documents.marked(docs("It works in 5 days. Ann is in Paris."), ["doc_id"])
    for patterns, at in ((None, [1]), ([("NUMBER", "in", "MISC", "R")], [0, 1])):
        assert documents.layered(frame, ["relations"], ["doc_id"], sparing=True, patterns=patterns).first()["at"] == at


def test_only_the_longest_sentence_is_weighed(docs):
    """It is chosen by its text, before any layer is worked out; the first of those that are as long."""
    frame = docs("Good. A bad old day. One long sad one.", "Not one great dog. A bad big fat rat.", "Bad dog. Big dog.", "", None)
    rows = documents.document_sentiments(frame, ["doc_id"])
    assert sorted(map(tuple, rows.collect())) == [(0, 2), (1, 1), (2, 1)]
    assert "array_position" in plan(rows) and "longest" not in plan(rows)


def test_triples_and_mentions_make_no_phrases_of_the_rest(docs):
    """Their texts are put together where they are found, not for every phrase of a sentence."""
    frame = docs("The dog saw a cat.")
    for layer in ("triples", "mentions"):
        assert "AS chunks" not in plan(documents.analysed(frame, ["doc_id"], [layer]))
    assert documents.analysed(frame, ["doc_id"], ["chunks"]).first().chunks[0][0].text.startswith("The dog")


def test_forms_of_a_dictionary_share_the_analysis(spark, docs):
    """Each row is read at most twice, once of them for the join, and every form gives the rows that it gives alone."""
    rules = [("red fox", "ANIMAL"), ("fox", "X"), ("of Arts", "TAIL")]
    table = spark.createDataFrame(rules, "pattern string, type string")
    frame = docs("A red fox of Arts. The fox.", "", None, "Ann of Arts")
    forms = {"list": dictionary.as_rules(rules), "trie": dictionary.as_rules(table), "join": dictionary.as_rules(table, 0)}
    rows = dictionary.regexner_forms(frame, ["doc_id"], forms)
    assert 1 <= plan(rows).count("Scan ExistingRDD[doc_id") <= 2
    for form, given in forms.items():
        alone = dictionary.regexner_table(frame, ["doc_id"], given, trie_bytes=0 if form == "join" else None)
        assert sorted(rows.where(F.col("form") == form).drop("form").collect()) == sorted(alone.collect())
