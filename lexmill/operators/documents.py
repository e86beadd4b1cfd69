"""From a table with a text column to annotated document rows and typed tables.

Every function here is row-local: one scan, no shuffle, no sort. `spread` is the only exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import html, text
from lexmill.functions import lexicons as L
from lexmill.functions.rows import each
from lexmill.functions.sqltext import quote, quoted
from lexmill.operators import phrases, syntax, tagger, tagging


def spread(docs: DataFrame, n: int, keys: list[str] | None = None) -> DataFrame:
    """Round-robin (or by `keys`) to `n` partitions; for an input of too few splits, where the caller asks for it."""
    return docs.repartition(n, *(keys or []))


def clean_xml(col: Column) -> Column:
    return html.html_to_text(col, drop_tags=("script", "style"))


def marked(docs: DataFrame, keys: list[str], text_col: str = "text", cleanxml: bool = False,
           line_as_sentence: bool = False) -> DataFrame:
    """Keys, `marked` and `cleaned`: the text with token and sentence marks, with and without blanks."""
    if cleanxml:
        docs, text_col = docs.select(*keys, clean_xml(F.col(text_col)).alias("plain_source")), "plain_source"
    column = text.mark(F.col(text_col))
    if line_as_sentence:
        column = F.replace(column, F.lit(text.SENTENCE_MARK), F.lit(text.TOKEN_MARK))
    frame = docs.select(*keys, column.alias("marked"))
    return frame.select(*keys, "marked", text.clean(F.col("marked")).alias("cleaned"))


# What each layer needs before it, in the order they are built.
NEEDS = {
    "toks": (),
    "lows": ("toks",),
    "pos": ("lows",),
    "lems": ("pos",),
    "ner": ("pos",),
    "cs": ("pos",),
    "bounds": ("cs",),
    "chunks": ("bounds",),
    "near": ("cs",),
    "edges": ("near",),
    "pol": ("pos",),
    "sentiment": ("pol",),
    "triples": ("bounds", "lems"),
    "pairs": ("ner", "lems"),
    "relations": ("ner", "lems"),
    "mentions": ("bounds", "lems", "ner"),
}


def closure(layers) -> list[str]:
    wanted = {"toks", *layers}
    for layer in reversed(list(NEEDS)):
        if layer in wanted:
            wanted.update(NEEDS[layer])
    return [layer for layer in NEEDS if layer in wanted]


def worth(layer: str, listed: dict, types=None) -> tuple[str, tuple[str, ...]] | None:
    """The condition over a sentence without which it has none of the layer's items, and the columns of spans it reads; None where
    nothing can be told. `listed` are the phrases of gazetteer and rules by name, None for a table whose spans are there."""
    types = set(L.ENTITY_TYPES if layer == "mentions" else types)
    if types & set(L.SHAPES):
        return None
    spans = tuple(f"{name}_spans" for name, given in listed.items() if given is None)
    heads = sorted({phrase.split()[0] for given in listed.values() if given for phrase, kind in given if kind in types and phrase.split()})
    tests = [f"x.s RLIKE {quote(syntax.MAY_MENTION)}"] if layer == "mentions" else []
    tests += [f"size(x.{name}) > 0" for name in spans]
    if heads:
        tests.append(f"exists(split(x.s, '{text.TOKEN_MARK}'), t -> t IN ({quoted(heads)}))")
    return " OR ".join(tests) or "false", spans


def layered(frame: DataFrame, layers, keys: list[str], rules=(), gazetteer=None, taggers=None, patterns=None,
            lemmas=None, types=None, sparing: bool = False) -> DataFrame:
    """Adds a column per layer, and those it needs, to a frame with the column `cleaned`. `rules` override the entity tags
    of `gazetteer` (None: the built-in one); either is a list of phrases and types, or a table as `phrases.prepared` has it.
    `taggers` maps `pos`, `ner` or `lemma` to what was learned for it, which then stands in for the built-in rules.
    `patterns` are those of the relations, a list; the layer `pairs` alone needs but their `lemmas` and `types`. `sparing` is
    for a caller that reads a single one of the layers mentions, pairs and relations: sentences that can have no item of it
    are left out of all layers, and the column `at` tells the places of the others."""
    needed, taggers = closure(layers), taggers or {}
    listed = {"named": L.GAZETTEER if gazetteer is None else gazetteer, "ner": rules}
    if "ner" in needed:
        for name, given in listed.items():
            if isinstance(given, phrases.Trie | DataFrame):
                frame = phrases.with_spans(frame, keys, given, f"{name}_spans")
                listed[name] = None
    learned = {column: taggers[name] for name, column in (("ner", "shaped"), ("pos", "pos")) if name in taggers and name in needed}
    frame = tagger.with_all_tags(frame, keys, learned)
    steps = {
        "lows": tagging.words, "pos": tagging.tags, "lems": tagging.lemmas,
        "ner": lambda: tagging.entities(listed["ner"], listed["named"], "ner" in taggers, "pos" in taggers),
        "cs": syntax.classes, "bounds": syntax.bounds, "chunks": syntax.chunks, "near": syntax.near, "edges": syntax.edges,
        "pol": syntax.polarities, "sentiment": syntax.sentiments, "triples": syntax.triples,
        "pairs": lambda: syntax.entity_pairs(lemmas, types), "relations": lambda: syntax.relations(patterns),
        "mentions": syntax.mentions,
    }
    condition = None
    if sparing and not taggers:
        if types is None and "relations" in layers:
            types = {t for p in (L.RELATION_PATTERNS if patterns is None else patterns) for t in (p[0], p[2])}
        condition = worth(*layers, listed, types)
    if condition:
        frame = frame.withColumn("wanted", F.expr(text.wanted_sentences("cleaned", *condition)))
        frame = frame.withColumns({"toks": F.expr(f"transform(wanted, x -> split(x.s, '{text.TOKEN_MARK}'))"), "at": F.col("wanted.i"),
                                   **{name: F.col(f"wanted.{name}") for name in condition[1]}})
    else:
        frame = frame.withColumn("toks", F.expr(text.sentence_tokens("cleaned")))
        if sparing:
            frame = frame.withColumn("at", F.expr("transform(toks, (s, i) -> i)"))
    for layer in needed[1:]:
        if layer == "lems" and "lemma" in taggers:
            frame = tagger.with_lemmas(frame, taggers["lemma"])
        elif layer != "pos" or "pos" not in taggers:
            for step in steps[layer]():
                frame = frame.withColumn(step.name, F.expr(step.sql()))
    return frame


def analysed(docs: DataFrame, keys: list[str], layers=(), text_col: str = "text", **options) -> DataFrame:
    """Keys, `toks` and the asked layers, one array over sentences each; or, instead of the layers, the `columns` that these
    are made of. With `sparing` also `at`, see `layered`."""
    columns = options.pop("columns", None) or ["toks", *layers]
    mark_options = {k: options.pop(k) for k in ("cleanxml", "line_as_sentence") if k in options}
    frame = layered(marked(docs, keys, text_col, **mark_options).drop("marked"), layers, keys, **options)
    return frame.select(*keys, *dict.fromkeys([*columns, *(["at"] if options.get("sparing") else [])]))


def sentence_rows(docs: DataFrame, keys: list[str], layers=(), text_col: str = "text", **options) -> DataFrame:
    """Keys, `sent_idx` and the struct `s` of `toks` and the asked layers, one row per sentence."""
    frame = analysed(docs, keys, layers, text_col, **options)
    rows = each(frame, keys, F.arrays_zip(*[c for c in frame.columns if c not in keys]), "sent_idx", "s")
    return rows.withColumn("sent_idx", F.col("s.at").cast("bigint")) if options.get("sparing") else rows


def token_rows(docs: DataFrame, keys: list[str], layers=(), text_col: str = "text", **options) -> DataFrame:
    """One row per token with the asked token layers (`pos`, `lems`, `ner`, `pol`)."""
    names = {"pos": "pos", "lems": "lemma", "ner": "ner", "pol": "polarity"}
    asked = [layer for layer in names if layer in layers]
    rows = sentence_rows(docs, keys, layers, text_col, **options)
    rows = each(rows, [*keys, "sent_idx", "s"], "s.toks", "tok_in_sent", "token")
    at = F.col("tok_in_sent").cast("int")
    return rows.select(*keys, "sent_idx", "tok_in_sent", "token",
                       *[F.get(f"s.{a}", at).alias(names[a]) for a in asked])


def _raw_sentences(docs: DataFrame, keys: list[str], text_col: str, **options) -> DataFrame:
    """Keys, `sent_idx`, `raw` (marked text with blanks) and `end_off` of every sentence."""
    frame = marked(docs, keys, text_col, **options)
    frame = frame.select(*keys, F.when(F.col("cleaned") == "", F.array().cast("array<string>"))
                         .otherwise(F.split("marked", text.SENTENCE_MARK)).alias("raws"))
    ends = F.expr(text.running_sum(f"transform(raws, r -> CAST(length(replace(r, '{text.TOKEN_MARK}', '')) AS BIGINT))"))
    frame = frame.select(*keys, F.arrays_zip(F.col("raws").alias("raw"), ends.alias("end_off")).alias("z"))
    return each(frame, keys, "z", "sent_idx", "z").select(*keys, "sent_idx", "z.raw", "z.end_off")


def sentences_table(docs: DataFrame, keys: list[str], text_col: str = "text", **options) -> DataFrame:
    """`sent_idx, begin_off, end_off, text, n_tokens`; offsets are 0-based characters, end exclusive."""
    body = F.regexp_replace(text.unmarked("raw"), rf"^{text.BLANK}++", "")
    rows = _raw_sentences(docs, keys, text_col, **options).select(*keys, "sent_idx", "end_off", "raw", body.alias("text"))
    return rows.select(
        *keys, "sent_idx", (F.col("end_off") - F.length("text")).alias("begin_off"), "end_off", "text",
        F.size(F.split("raw", text.TOKEN_MARK)).cast("bigint").alias("n_tokens"))


def sentence_lists(docs: DataFrame, keys: list[str], text_col: str = "text", **options) -> DataFrame:
    """`result`: the list of sentence texts of each document, printed as `[a, b]`."""
    texts = text.sentence_texts(F.col("marked"))
    return marked(docs, keys, text_col, **options).select(
        *keys, F.concat(F.lit("["), F.array_join(texts, ", "), F.lit("]")).alias("result"))


def tokens_table(docs: DataFrame, keys: list[str], text_col: str = "text", **options) -> DataFrame:
    """`sent_idx, tok_in_sent, token, begin_off, end_off`."""
    frame = marked(docs, keys, text_col, **options).withColumn("ends", F.arrow_udf(text.token_ends, "array<array<bigint>>")("marked"))
    sentences = F.arrays_zip(F.split("marked", text.SENTENCE_MARK).alias("raw"), "ends")
    frame = frame.select(*keys, F.when(F.col("cleaned") != "", sentences).alias("z"))
    rows = each(frame, keys, "z", "sent_idx", "s")
    pieces = F.arrays_zip(F.split("s.raw", text.TOKEN_MARK).alias("piece"), F.col("s.ends").alias("end_off"))
    rows = each(rows.select(*keys, "sent_idx", pieces.alias("z")), [*keys, "sent_idx"], "z", "tok_in_sent", "z")
    rows = rows.select(*keys, "sent_idx", "tok_in_sent", text.stripped("z.piece").alias("token"), "z.end_off")
    return rows.select(*keys, "sent_idx", "tok_in_sent", "token",
                       (F.col("end_off") - F.length("token")).alias("begin_off"), "end_off")


def _exploded(rows: DataFrame, keys: list[str], field: str, index: str | None, **columns) -> DataFrame:
    rows = each(rows, [*keys, "sent_idx"], f"s.{field}", "i", "x")
    first = [F.col("i").alias(index)] if index else []
    return rows.select(*keys, "sent_idx", *first, *[c.alias(n) for n, c in columns.items()])


def chunks_table(docs, keys, text_col="text", **options) -> DataFrame:
    rows = sentence_rows(docs, keys, ["bounds"], text_col, columns=syntax.CHUNK_READS.split(), **options)
    rows = each(rows, [*keys, "sent_idx", "s"], "s.bounds", "chunk_idx", "b").withColumn("j", F.col("chunk_idx").cast("int"))
    return rows.select(*keys, "sent_idx", "chunk_idx", F.expr(syntax.CHUNK).alias("x")).select(
        *keys, "sent_idx", "chunk_idx", "x.kind", F.col("x.b").cast("bigint").alias("begin_tok"), F.col("x.e").cast("bigint").alias("end_tok"),
        "x.text", F.col("x.head").cast("bigint").alias("head"))


def edges_table(docs, keys, text_col="text", **options) -> DataFrame:
    rows = sentence_rows(docs, keys, ["near"], text_col, columns=syntax.EDGE_READS.split(), **options)
    rows = each(rows, [*keys, "sent_idx", "s"], "s.pos", "i", "p").withColumn("i", F.col("i").cast("int"))
    return rows.select(*keys, "sent_idx", F.expr(syntax.edge()).alias("x")).select(
        *keys, "sent_idx", F.col("x.dep").cast("bigint").alias("dep_tok"), F.col("x.gov").cast("bigint").alias("gov_tok"), "x.rel")


def first_governors(docs, keys, text_col="text", **options) -> DataFrame:
    """The governor of the first token of every sentence; -1 where that token is the root."""
    rows = sentence_rows(docs, keys, ["near"], text_col, columns=syntax.EDGE_READS.split(), **options)
    first = rows.withColumns({"p": F.get("s.pos", F.lit(0)), "i": F.lit(0)})
    return first.select(*keys, "sent_idx", F.expr(syntax.edge()).gov.cast("bigint").alias("gov_tok"))


def sentiments_table(docs, keys, text_col="text", **options) -> DataFrame:
    rows = sentence_rows(docs, keys, ["sentiment"], text_col, **options)
    return rows.select(*keys, "sent_idx", F.col("s.sentiment").cast("bigint").alias("sentiment"))


def document_sentiments(docs, keys, text_col="text", **options) -> DataFrame:
    """The class of each document's longest sentence, the first one if several are as long. The sentence is chosen by its text
    before any layer is worked out, and is the only one that is analysed."""
    frame = marked(docs, keys, text_col).withColumn("texts", text.sentence_texts(F.col("marked")))
    frame = frame.withColumn("lengths", F.expr("transform(texts, t -> length(t))"))
    longest = F.get(F.split("cleaned", text.SENTENCE_MARK), F.array_position("lengths", F.array_max("lengths")).cast("int") - 1)
    chosen = frame.select(*keys, F.when(F.col("cleaned") != "", longest).otherwise("").alias("cleaned"))
    return each(layered(chosen, ["sentiment"], keys, **options), keys, "sentiment", "i", "x").select(*keys, F.col("x").cast("bigint").alias("sentiment"))


def triples_table(docs, keys, text_col="text", **options) -> DataFrame:
    return _exploded(sentence_rows(docs, keys, ["triples"], text_col, **options), keys, "triples", "triple_idx",
                     **{c: F.col(f"x.{c}") for c in ("confidence", "subject", "relation", "object")})


def relations_table(docs, keys, text_col="text", patterns=None, **options) -> DataFrame:
    """`relation_idx, entity1, type, entity2`: every pair of entities that a pattern names, by the places of both, then by type.
    `patterns` is a list of (type, lemma, type, relation) or a DataFrame (first, lemma, second, relation); with a table the
    pairs are joined to it, and only its lemmas and entity types are written into the plan."""
    columns = {c: F.col(f"x.{c}") for c in ("entity1", "type", "entity2")}
    if not isinstance(patterns, DataFrame):
        return _exploded(sentence_rows(docs, keys, ["relations"], text_col, patterns=patterns, sparing=True, **options), keys, "relations", "relation_idx", **columns)
    known = patterns.select("first", "lemma", "second", "relation").dropna().distinct()
    words = known.agg(F.collect_set("lemma").alias("lemmas"), F.array_union(F.collect_set("first"), F.collect_set("second")).alias("types")).first()
    rows = sentence_rows(docs, keys, ["pairs"], text_col, lemmas=sorted(words.lemmas) or [""], types=sorted(words.types) or [""], sparing=True, **options)
    pairs = each(rows, [*keys, "sent_idx"], "s.pairs", "i", "x").select(*keys, "sent_idx", "x.*")
    same = (F.col("type1") == F.col("first")) & (pairs["lemma"] == known["lemma"]) & (F.col("type2") == F.col("second"))
    named = pairs.join(known, same).select(*keys, "sent_idx", "b1", "b2", F.col("relation").alias("type"), "entity1", "entity2").distinct()
    place = F.row_number().over(Window.partitionBy(*keys, "sent_idx").orderBy("b1", "b2", "type")) - 1
    return named.select(*keys, "sent_idx", place.cast("bigint").alias("relation_idx"), "entity1", "type", "entity2")
