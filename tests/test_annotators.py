import pytest
from pyspark.sql import functions as F

from lexmill import annotate, annotate_with_model
from lexmill.functions import lexicons as L
from lexmill.operators import coreference, dictionary, documents, phrases, tagging
from lexmill.plans.catalogue import CATALOGUE

EXPECTED = [
    ("tokenize", "Don't say John's dog can't run.", "Do n't say John 's dog ca n't run ."),
    ("tokenize", "a@b.com https://x.y/z?q $5.20, 10% U.S. Mr. X 1/2/2020...", "a@b.com https://x.y/z?q $5.20 , 10% U.S. Mr. X 1/2/2020 ..."),
    ("cleanxml", "<p>Hello <b>big</b> world</p><!-- x -->", "Hello-1 big-2 world-3"),
    ("ssplit", "The dogs ran. They did not stop!", "The dogs ran.\nThey did not stop!\n"),
    ("ssplit", "“Yes.” she said. (It is so.) Why?! Pi is 3.14.", "“Yes.”\nshe said.\n(It is so.)\nWhy?!\nPi is 3.14.\n"),
    ("pos", "The quick brown dogs are running.", "DT JJ JJ NNS VBP VBG ."),
    ("lemma", "The dogs stopped and were running.", "the dog stop and be run ."),
    ("ner", "Barack Obama paid $5.20, 10% more, in New York.", "PERSON PERSON O MONEY O PERCENT O O O LOCATION LOCATION O"),
    ("regexner", "She holds a Bachelor of Arts and more.", "O O O DEGREE DEGREE DEGREE O O O"),
    ("regexner", "It ends with Bachelor of", "O O O MISC O"),
    ("sentiment", "A good, great day. A pathetic, stupid day. It is not good.", "4\n0\n1\n"),
    ("parse", "The dog ran.", "(S (NP The dog) (VP ran) .)\n"),
    ("depparse", "The dog ran.", "det(dog-2, The-1) nsubj(ran-3, dog-2) root(ROOT-0, ran-3) punct(ran-3, .-4)\n"),
    ("natlog", "No dog has never eaten. Every cat sleeps.", "up down down down up up \nup up up up \n"),
    ("coref", "Barack Obama spoke. He left. Barack Obama returned.", "(Barack Obama:He)\n"),
    ("coref", "New York grew. New York shrank.", "(New York)\n"),
    ("dcoref", "Barack Obama spoke. He left.", "(Barack Obama:He)\n"),
    ("relation", "Barack Obama works for Harvard University.", "(Barack Obama,Work_For,Harvard University)\n"),
    ("quote", '"We won," said Barack Obama. "Nobody knows."', '("We won,",Barack Obama) ("Nobody knows.",)'),
    ("openie", "They did not stop!", "(1.0,they,do not,stop)\n"),
]


@pytest.fixture(scope="module")
def results(spark):
    """Every text through every annotator; the two that change the results of others on their own."""
    texts = list(dict.fromkeys(t for _, t, _ in EXPECTED))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    alone = ("cleanxml", "regexner")
    rows = [r for names in ([n for n in CATALOGUE if n not in alone], *[[n] for n in alone]) for r in annotate(frame, names).collect()]
    return {(r.functionality, texts[r.doc_id]): r.result for r in rows}


@pytest.mark.parametrize("name, text, result", EXPECTED)
def test_result(results, name, text, result):
    assert results[name, text] == result


def test_every_annotator_is_covered():
    assert {name for name, _, _ in EXPECTED} == set(CATALOGUE)


def test_empty_documents(docs):
    got = {(r.functionality, r.doc_id): r.result for r in annotate(docs("", "  \n ", None), CATALOGUE).collect()}
    for name in CATALOGUE:
        for i in range(3):
            if name in ("tokenize", "cleanxml"):
                assert (name, i) not in got
            else:
                assert got[name, i] == ""


def test_cleanxml_cleans_the_others(docs):
    got = {r.functionality: r.result for r in annotate(docs("<p>One <b>two</b></p>"), "tokenize,cleanxml,coref").collect()}
    assert got == {"tokenize": "One two", "cleanxml": "One-1 two-2", "coref": ""}


def test_ner_equals_regexner_when_both_are_asked(docs):
    got = {r.functionality: r.result for r in annotate(docs("A Bachelor of Laws."), "ner,regexner").collect()}
    assert got["ner"] == got["regexner"] == "O DEGREE DEGREE DEGREE O"
    assert annotate(docs("A Bachelor of Laws."), "ner").first().result == "O MISC O MISC O"


def test_long_sentences_are_analysed_in_full(docs):
    """One edge for each token, polarity and relations across the whole sentence, in time that grows with it."""
    import time
    took = {}
    for n in (101, 5_000, 100_000):
        unit = "No big dog eats without Barack Obama who works for Harvard University and he ".split()
        words = (unit * (n // len(unit) + 1))[:n]
        start = time.perf_counter()
        got = {r.functionality: r.result for r in annotate(docs(" ".join(words)), "parse,depparse,natlog,relation,coref").collect()}
        took[n] = time.perf_counter() - start
        assert got["depparse"].count("(") == len(got["natlog"].split()) == n
        assert got["parse"].startswith("(S (NP") and "down" in got["natlog"]
        assert got["relation"].count("Work_For") == words.count("Harvard") - (words[-1] == "Harvard")
        assert got["coref"]
    assert took[100_000] < 60 * max(1, took[5_000])


def test_line_as_sentence(docs):
    names = "tokenize,pos,lemma,ner,parse,depparse,natlog,openie"
    got = {r.functionality: r.result for r in annotate(docs("They ran. They won food."), names, line_as_sentence=True).collect()}
    assert got["tokenize"] == "[They, ran, ., They, won, food, .]"
    assert got["pos"] == "[PRP, VBD, ., PRP, VBD, NN, .]"
    assert got["lemma"] == "[they, run, ., they, win, food, .]"
    assert got["depparse"] == "1"
    assert got["openie"] == "[(1.0,they,win,food)]"
    assert got["parse"].count("(S ") == 1
    with pytest.raises(ValueError):
        annotate(docs("x"), "coref", line_as_sentence=True)


def test_overlapping_phrases_leftmost_then_longest(docs, spark):
    rules = [("Arts and", "X"), ("Bachelor of Arts", "DEGREE"), ("Bachelor", "B"), ("and a", "Y")]
    table = spark.createDataFrame(rules, "pattern string, type string")
    frame = docs("A Bachelor of Arts and a Bachelor of Laws.", "Arts and a Bachelor", "nothing")
    few = dictionary.regexner_table(frame, ["doc_id"], rules)
    for size in (0, 1 << 20):  # joined, and walked
        assert sorted(few.collect()) == sorted(dictionary.regexner_table(frame, ["doc_id"], table, trie_bytes=size).collect())
    tags = [r.ner for r in few.where("doc_id = 0").orderBy("sent_idx", "tok_in_sent").collect()]
    assert tags == ["O", "DEGREE", "DEGREE", "DEGREE", "Y", "Y", "B", "O", "MISC", "O"]


def test_gazetteer_as_a_table(docs, spark):
    names = spark.createDataFrame([("red fox", "ANIMAL"), ("fox", "X"), (None, "Y")], "pattern string, type string")
    frame = docs("A red fox of Harvard.", None, "fox")
    got = {(r.functionality, r.doc_id): r.result for r in annotate(frame, "ner,regexner,pos", rules=[("fox of", "RULE")], gazetteer=names).collect()}
    assert got["ner", 0] == "O ANIMAL RULE RULE MISC O" and got["ner", 2] == "X" and got["ner", 1] == ""
    assert {r.result for r in annotate(frame, "ner", gazetteer=names).collect()} == {"O ANIMAL ANIMAL O MISC O", "", "X"}


def test_joined_spans_stand_at_their_sentences(docs, spark):
    table = spark.createDataFrame([("x y", "T"), ("y", "U")], "pattern string, type string")
    texts = ["a. x y. b. c. y x y. d.", "none. at all.", "", None, "x y", "a. b. y."]
    frame = documents.marked(docs(*texts), ["doc_id"])
    trie = phrases.prepared(table)
    assert isinstance(trie, phrases.Trie) and phrases.prepared(table, 3) is table
    rows = [sorted(phrases.with_spans(frame, ["doc_id"], t, "spans").select("doc_id", "spans").collect()) for t in (trie, table)]
    assert rows[0] == rows[1]
    assert [[tuple(x) for s in r.spans for x in s] for r in rows[0]] == [[(0, 2, "T"), (0, 1, "U"), (1, 3, "T")], [], [], [], [(0, 2, "T")], [(0, 1, "U")]]
    assert [len(r.spans) for r in rows[0]] == [6, 2, 0, 0, 1, 3]


def test_trie_takes_the_longest_and_goes_on_after_it():
    trie = phrases.Trie([("a b c", "3"), ("a", "1"), ("b", "B"), ("c d", "2"), ("a b x y", "4")])
    assert trie.spans("a b x a b c d b a b".split()) == [(0, 1, "1"), (1, 2, "B"), (3, 6, "3"), (7, 8, "B"), (8, 9, "1"), (9, 10, "B")]


def test_table_gazetteer_reaches_what_builds_on_entities(docs, spark):
    names = spark.createDataFrame([("Ada Ray", "PERSON"), ("Mill House", "ORGANIZATION")], "pattern string, type string")
    frame = docs("Ada Ray works for Mill House. Ada Ray left. She returned.")
    got = {r.functionality: r.result for r in annotate(frame, "ner,relation,coref", gazetteer=names).collect()}
    assert got["ner"].startswith("PERSON PERSON O O ORGANIZATION ORGANIZATION")
    assert got["relation"] == "(Ada Ray,Work_For,Mill House)\n" and got["coref"] == "(Ada Ray:She)\n"


def test_relations_between_all_that_one_verb_parts(docs):
    both = "Barack Obama and Angela Merkel work for Harvard University"
    assert annotate(docs(both), "relation").first().result == (
        "(Barack Obama,Work_For,Harvard University)\n(Angela Merkel,Work_For,Harvard University)\n")
    parted = annotate(docs("Barack Obama lives in Paris and Angela Merkel works for Harvard University and the United Nations."), "relation").first().result
    assert parted == "(Barack Obama,Live_In,Paris)\n(Angela Merkel,Work_For,Harvard University)\n(Angela Merkel,Work_For,United Nations)\n"
    own = [("PERSON", "lead", "LOCATION", "Head"), ("PERSON", "lead", "LOCATION", "Boss"), ("LOCATION", "near", "LOCATION", "Near")]
    assert annotate(docs("Angela Merkel led Germany."), "relation", patterns=own).first().result == "(Angela Merkel,Boss,Germany)\n(Angela Merkel,Head,Germany)\n"
    assert annotate(docs("Angela Merkel led Germany."), "relation", patterns=[]).first().result == ""


def test_relations_by_a_table_of_patterns(docs, spark):
    frame = docs("Barack Obama and Angela Merkel work for Harvard University in Paris. Paris, in France.", "nothing", None)
    table = spark.createDataFrame([*L.RELATION_PATTERNS, L.RELATION_PATTERNS[0], (None, "work", "LOCATION", "x")], "first string, lemma string, second string, relation string")
    few, many = (sorted(documents.relations_table(frame, ["doc_id"], patterns=p).collect()) for p in (None, table))
    assert few == many and len(few) == 3
    assert documents.relations_table(frame, ["doc_id"], patterns=table.limit(0)).count() == 0


def test_large_dictionary_through_annotate(docs, spark):
    rules = spark.range(1500).select(F.concat(F.lit("word"), F.col("id")).alias("pattern"), F.lit("W").alias("type"))
    got = {(r.functionality, r.doc_id): r.result for r in annotate(docs("word7 word1600 word12.", ""), "regexner,ner,pos", rules=rules).collect()}
    assert got["regexner", 0] == got["ner", 0]
    assert got["regexner", 1] == "" and got["pos", 0]


def test_own_model(docs):
    def factory():
        calls = []
        def model(batch):
            calls.append(1)
            return batch.assign(n=batch["text"].str.len())[["doc_id", "n"]]
        return model
    assert sorted(map(tuple, annotate_with_model(docs("a", "bcd"), factory, "doc_id bigint, n bigint").collect())) == [(0, 1), (1, 3)]


def test_a_failing_document_costs_itself_only(docs):
    def factory():
        def model(batch):
            if batch["text"].isna().any() or (batch["text"] == "bad").any():
                raise KeyError("poison")
            return batch.assign(n=batch["text"].str.len(), kind="k")[["kind", "n", "doc_id"]]
        return model
    frame = docs("a", "bad", "cde", None, "bad")
    got = annotate_with_model(frame, factory, "doc_id bigint, n bigint, kind string", error="why").orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(0, 1, "k", None), (1, None, None, "KeyError: 'poison'"), (2, 3, "k", None),
                                      (3, None, None, "KeyError: 'poison'"), (4, None, None, "KeyError: 'poison'")]
    assert annotate_with_model(frame.limit(0), factory, "doc_id bigint", error="why").count() == 0
    with pytest.raises(ValueError, match="column why"):
        annotate_with_model(frame, factory, "doc_id bigint, why string", error="why")


TEXTS = ["One. Two words!  Three\n\nhere...", " lead. (Yes.) No", "héllo wörld, it's U.S. 3.5%", "...", "a" * 3000 + " " + "1,2" * 2000,
         "x\x1ey\x1fz. ok", "emoji 😀 ok. 𝔘nicode"]


def test_offsets_point_at_the_tokens(docs):
    frame = docs(*TEXTS)
    rows = documents.tokens_table(frame, ["doc_id"]).collect()
    for r in rows:
        assert TEXTS[r.doc_id][r.begin_off:r.end_off] == r.token
    for i, text in enumerate(TEXTS):
        ends = [(r.begin_off, r.end_off) for r in sorted(rows, key=lambda r: (r.sent_idx, r.tok_in_sent)) if r.doc_id == i]
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
        kept = set().union(*[range(*e) for e in ends])
        assert all(c.isspace() or c in "\x1e\x1f" for j, c in enumerate(text) if j not in kept)
    sentences = documents.sentences_table(frame, ["doc_id"]).collect()
    for s in sentences:
        inside = [r for r in rows if (r.doc_id, r.sent_idx) == (s.doc_id, s.sent_idx)]
        assert s.n_tokens == len(inside)
        assert (s.begin_off, s.end_off) == (min(r.begin_off for r in inside), max(r.end_off for r in inside))
        assert TEXTS[s.doc_id][s.begin_off:s.end_off].replace("\x1e", " ").replace("\x1f", " ") == s.text


def test_one_tag_per_token_and_disjoint_chains(docs):
    frame = docs(*TEXTS, "Tom Lee saw Ann Ray. He left her. Ann Ray saw it.")
    rows = documents.analysed(frame, ["doc_id"], ["pos", "lems", "ner", "pol", "edges"]).collect()
    for r in rows:
        for layer in (r.pos, r.lems, r.ner, r.pol):
            assert [len(x) for x in layer] == [len(x) for x in r.toks]
        for toks, es in zip(r.toks, r.edges):
            assert not es or ([e.dep for e in es] == list(range(len(toks))) and [e.gov for e in es].count(-1) == 1)
    places = [(m.doc_id, m.sent_idx, m.begin_tok, m.end_tok) for m in coreference.mentions_table(frame, ["doc_id"]).collect()]
    assert places and len(places) == len(set(places))


def test_edges_are_trees(spark, docs):
    """One root, and every token reaches it: of the corpus, and of random words of all classes."""
    import random
    rng = random.Random(2)
    words = ["the", "his", "dog", "Rome", "ran", "to", "not", "can", "of", "and", "big", "7", ",", "she", "quickly", "is", "No"]
    frame = docs(*[" ".join(rng.choices(words, k=rng.randrange(1, 25))) for _ in range(500)]).union(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))
    for r in documents.analysed(frame, ["doc_id"], ["edges"]).collect():
        for edges in r.edges:
            above = [e.gov for e in edges]
            assert above.count(-1) == 1 and above[0] is not None
            reached, left = {-1}, set(range(len(above)))
            while left:
                now = {i for i in left if above[i] in reached}
                assert now, "a cycle"
                reached |= now
                left -= now


def test_result_does_not_depend_on_partitions(docs):
    frame = docs(*TEXTS * 3)
    runs = [sorted(map(tuple, annotate(documents.spread(frame, n, ["doc_id"]), "pos,coref,depparse").collect())) for n in (1, 7)]
    assert runs[0] == runs[1]


def test_long_runs_stay_linear(docs):
    texts = ["1," * 100_000 + "1", "x." * 50_000, "ab1" * 100_000, "A-" * 50_000 + "b", "'" * 100_000, ". " * 50_000]
    counts = documents.analysed(docs(*texts), ["doc_id"]).select("doc_id", F.size(F.flatten("toks")).alias("n")).collect()
    assert {r.doc_id: r.n for r in counts} == {0: 1, 1: 1, 2: 200_000, 3: 1, 4: 100_000, 5: 50_000}


def test_layers_of_ascii_need_no_regex_and_no_list_of_branches():
    """Within a lambda, branches of a CASE are looked up in a linked list, and a regex costs more than the rest of a token."""
    for step in (tagging.tags()[0], tagging.shapes()[0]):
        assert "CASE WHEN" not in step.value
    first = tagging.tags()[0].value
    assert first.index("w < ':'") < first.index("RLIKE") and "(?:" not in first[:first.index("RLIKE")]
    assert len(tagging.phrases("ner", "named", [])) == 1 and "slice" not in tagging.phrases("ner", "named", [])[0].value


def test_tokens_at_the_edges_of_ascii(spark):
    """Tags and entities by comparison are those of the regexes."""
    words = ["iPhone", "Zoo", "Kelvin", "İstanbul", "École", "été", "~", "{", "_", "^", "\\", "@", "\x7f", "$5", "5x", "٣", "Ⅷ", "日本", "I", "A@b.c"]
    docs = spark.createDataFrame([(1, "so " + " ".join(words))], "doc_id bigint, text string")
    got = {r.functionality: r.result.split(" ") for r in annotate(docs, "pos,ner,cleanxml").collect()}
    assert dict(zip(got["cleanxml"], zip(got["pos"], got["ner"], strict=True), strict=True)) == {
        f"{w}-{i}": x for i, (w, x) in enumerate({
            "so": ("NN", "O"), "iPhone": ("NN", "O"), "Zoo": ("NNP", "MISC"), "Kelvin": ("NNP", "MISC"), "İstanbul": ("NNP", "MISC"),
            "École": ("NNP", "MISC"), "été": ("NN", "O"), "~": ("SYM", "O"), "{": ("-LRB-", "O"), "_": ("SYM", "O"), "^": ("SYM", "O"),
            "\\": ("SYM", "O"), "@": ("SYM", "O"), "\x7f": ("SYM", "O"), "$5": ("CD", "MONEY"), "5": ("CD", "NUMBER"), "x": ("NN", "O"),
            "٣": ("CD", "NUMBER"), "Ⅷ": ("CD", "NUMBER"), "日本": ("NN", "O"), "I": ("PRP", "O"), "A@b.c": ("NNP", "MISC")}.items(), 1)}


def test_sentence_lines_are_the_sentence_texts(spark):
    texts = ["", None, " \n ", "It ran.  Then\x1e it\x1f sat. ", ".", "a", "　One!  \n\nTwo? ... Three", "Don't! 'No.' It’s"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    lines = {r.doc_id: r.result for r in annotate(docs, "ssplit").collect()}
    listed = {}
    for r in sorted(documents.sentences_table(docs, ["doc_id"]).collect(), key=lambda r: (r.doc_id, r.sent_idx)):
        listed[r.doc_id] = listed.get(r.doc_id, "") + r.text + "\n"
    assert lines == {i: listed.get(i, "") for i in range(len(texts))}
