"""The entry points: a request for annotators becomes one lazy plan over the documents.

All annotators of a request but `coref`, `dcoref` and `quote` read the same array column, so the text is
scanned and analysed once however many are asked for, with no shuffle and nothing to persist. Both kinds of chains
come from one scan of their own, and so do quotations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lexmill.functions import text
from lexmill.operators import coreference, dictionary, phrases, quotes, syntax
from lexmill.operators.documents import layered, marked, spread
from lexmill.operators.tagging import Step
from lexmill.plans.catalogue import resolve, validate
from lexmill.sources import sinks

# The layers an annotator's output is written from.
LAYERS = {
    "cleanxml": [],
    "pos": ["pos"],
    "lemma": ["lems"],
    "ner": ["ner"],
    "regexner": ["ner"],
    "sentiment": ["sentiment"],
    "parse": ["chunks"],
    "depparse": ["edges"],
    "relation": ["relations"],
    "natlog": ["pol"],
    "openie": ["triples"],
}
CHAINS = ("coref", "dcoref")
SKIPS_EMPTY = ("tokenize", "cleanxml")
# With a line as one sentence, results are printed as lists.
LINE_FUNCTIONS = ("tokenize", "pos", "lemma", "ner", "parse", "depparse", "natlog", "openie")


# As written in SQL text.
NEWLINE = "\\n"


def _per_sentence(reads: str, value: str) -> str:
    return Step("", reads, value).sql()


def _lines(reads: str, line: str) -> str:
    """One line per sentence, each with its line end."""
    return f"array_join({_per_sentence(reads, f"concat({line}, '{NEWLINE}')")}, '')"


def _items(layer: str, item: str) -> str:
    """One line per item of every sentence's list."""
    return f"array_join(transform(flatten({layer}), t -> concat({item}, '{NEWLINE}')), '')"


def _over_document(layer: str) -> str:
    return f"array_join(flatten({layer}), ' ')"


# The result of each annotator over the layer columns.
RESULTS = {
    "tokenize": f"replace(replace(cleaned, '{text.SENTENCE_MARK}', ' '), '{text.TOKEN_MARK}', ' ')",
    "cleanxml": _over_document(_per_sentence("toks", "transform(s.toks, (t, i) -> concat(t, '-', i + 1))")),
    "pos": _over_document("pos"),
    "lemma": _over_document("lems"),
    "ner": _over_document("ner"),
    "regexner": _over_document("ner"),
    "parse": _lines(syntax.BRACKETED_READS, syntax.BRACKETED),
    "depparse": _lines(syntax.EDGE_TEXT_READS, syntax.EDGE_TEXT),
    "sentiment": _lines("sentiment", "CAST(s.sentiment AS STRING)"),
    "natlog": _lines("pol", "concat(array_join(s.pol, ' '), ' ')"),
    "openie": _items("triples", syntax.TRIPLE_TEXT),
    "relation": _items("relations", "concat('(', concat_ws(',', t.entity1, t.type, t.entity2), ')')"),
}

# The same over the one sentence of a line.
LINE_RESULTS = {
    "tokenize": "concat('[', array_join(get(toks, 0), ', '), ']')",
    "pos": "concat('[', array_join(get(pos, 0), ', '), ']')",
    "lemma": "concat('[', array_join(get(lems, 0), ', '), ']')",
    "ner": "concat('[', array_join(get(ner, 0), ', '), ']')",
    "natlog": "concat('[', array_join(get(pol, 0), ', '), ']')",
    "openie": f"concat('[', array_join(transform(get(triples, 0), t -> {syntax.TRIPLE_TEXT}), ', '), ']')",
    "parse": f"get({_per_sentence(syntax.BRACKETED_READS, syntax.BRACKETED)}, 0)",
    "depparse": "CAST(get(get(edges, 0), 0).gov AS STRING)",
}


def _rendered(name: str) -> Column:
    if name == "ssplit":
        return text.sentence_lines(F.col("marked"))
    return F.expr(RESULTS[name])


def _rendered_line(name: str) -> Column:
    empty = "" if name in ("parse", "depparse") else "[]"
    return F.expr(f"coalesce({LINE_RESULTS[name]}, '{empty}')")


def annotate(docs: DataFrame, functionality: str | list[str], keys: list[str] | str = "doc_id",
             text_col: str = "text", mappers: int | None = None, rules=None, gazetteer=None,
             line_as_sentence: bool = False, taggers=None, patterns=None) -> DataFrame:
    """Rows `(functionality, *keys, result)`, one per requested annotator and document.

    `rules` is a list of (phrase, type) or a DataFrame `(pattern, type)` of any size; it applies when `regexner` is
    requested, and then to every annotator that reads entities. So is `gazetteer`, which stands in for the built-in
    names. `taggers` maps `pos`, `ner` or `lemma` to a learned `tagger.Tagger` or `tagger.Lemmatizer`, for every annotator
    that reads these layers. `patterns` is a list of (type, lemma, type, relation) for `relation`. `cleanxml` cleans the
    text of every annotator.
    `tokenize` and `cleanxml` skip documents without tokens, the others give an empty string.
    With `line_as_sentence` a row is one sentence and results are printed as lists.
    `keys` must identify a document."""
    names = validate(functionality)
    keys = [keys] if isinstance(keys, str) else list(keys)
    if line_as_sentence and set(names) - set(LINE_FUNCTIONS):
        raise ValueError(f"Not for single sentences: {', '.join(n for n in names if n not in LINE_FUNCTIONS)}")
    if mappers:
        docs = spread(docs, mappers)

    by_chain = [n for n in names if n in CHAINS]
    local = [n for n in names if n not in by_chain and n != "quote"]
    options = {"rules": dictionary.as_rules(rules) if "regexner" in names else [], "gazetteer": dictionary.as_gazetteer(gazetteer),
               "taggers": taggers}
    clean_first = {"cleanxml": "cleanxml" in names}

    frames = []
    if local:
        frame = marked(docs, keys, text_col, line_as_sentence=line_as_sentence, **clean_first)
        # Every annotator of the plan offers its layers; Spark drops the columns that no result reads.
        layers = {layer for n in resolve(local) for layer in LAYERS.get(n, [])}
        if any(n in LAYERS for n in local) or line_as_sentence:
            frame = layered(frame, layers, keys, patterns=patterns, **options)
        rendered = {n: _rendered_line(n) if line_as_sentence else _rendered(n) for n in local}
        results = F.array(*[F.struct(F.lit(n).alias("functionality"), c.alias("result")) for n, c in rendered.items()])
        rows = frame.select(*keys, F.inline(results)).select("functionality", *keys, "result")
        frames.append(rows.where(~F.col("functionality").isin(*SKIPS_EMPTY) | (F.col("result") != ""))
                      if not line_as_sentence and set(local) & set(SKIPS_EMPTY) else rows)
    if by_chain:
        frames.append(coreference.chain_results(docs, keys, by_chain, text_col, **clean_first, **options))
    if "quote" in names:
        said = quotes.quote_results(docs, keys, text_col, **clean_first, **options)
        frames.append(said.select(F.lit("quote").alias("functionality"), *keys, "result"))
    return reduce(DataFrame.unionByName, frames)


def annotate_with_model(docs: DataFrame, factory: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
                        schema: str, error: str | None = None) -> DataFrame:
    """Runs a user's own model. `factory` is called once per partition and returns a function from a batch
    of documents to a batch of results; results are passed on batch by batch.

    An exception of the model ends the job, unless `error` names a column: then the documents of a failed batch are tried
    one by one, and one that fails alone gives a row of its own, with the columns that documents and results share, the
    others null, and the exception in the column `error`, which is null for results. A failure of `factory` ends the job."""
    if error is None:
        def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = factory()
            for batch in batches:
                yield model(batch)
        return docs.mapInPandas(run, schema)

    kinds = StructType.fromDDL(schema)
    names = kinds.names
    if error in names:
        raise ValueError(f"The results have a column {error} of their own")

    def tried(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for batch in batches:
            try:
                yield model(batch)[names].assign(**{error: None})
            except Exception:
                for i in range(len(batch)):
                    one = batch.iloc[i:i + 1]
                    try:
                        yield model(one)[names].assign(**{error: None})
                    except Exception as problem:
                        said = f"{type(problem).__name__}: {problem}"
                        yield pd.DataFrame({name: one[name] if name in one else pd.Series([None], one.index, object) for name in names}).assign(**{error: said})

    return docs.mapInPandas(tried, StructType([*kinds.fields, StructField(error, StringType())]))


def _keeps_order(options: dict) -> bool:
    """Whether results come in the order of the documents. Prepares tables of rules on the way."""
    for name in {"rules", "gazetteer"} & set(options):
        options[name] = phrases.prepared(options[name])
    large = [t for t in (options.get("taggers") or {}).values() if getattr(t, "lexicon", None) is not None]
    return not large and not any(isinstance(options.get(name), DataFrame) for name in ("rules", "gazetteer"))


def run_job(docs: DataFrame, functionality: str | list[str], path: str, mappers: int | None = None,
            keys: list[str] | str = "doc_id", sink: str = "sorted", **options) -> None:
    """Annotates and writes: one directory of sorted text files per annotator (`sorted`), lines with the annotator and
    the last key (`keyed`), JSON objects (`json`) or typed Parquet (`typed`).

    For sorted output the documents are range-partitioned by key before they are annotated: the pass that samples the
    keys then scans documents but annotates none, the shuffle carries text and not its many annotations, and
    every task writes a sorted run of each annotator, so no annotator is confined to one writer. Dictionaries too large for a
    trie and taggers too large to be sent shuffle by document: with them only the results are ranged. The other sinks range
    nothing."""
    names = validate(functionality)
    keys = [keys] if isinstance(keys, str) else list(keys)
    if sink not in SINKS:
        raise ValueError(f"No such sink: {sink}")
    if sink != "sorted":
        SINKS[sink](annotate(docs, names, keys=keys, mappers=mappers, **options), path, keys)
        return
    ranged = _keeps_order(options)
    ordered = docs.repartitionByRange(*([mappers] if mappers else []), *keys) if ranged else docs
    sinks.write_by_functionality(annotate(ordered, names, keys=keys, **options), path, keys, mappers, ranged)


def ranked_results(docs: DataFrame, functionality: str | list[str], path: str, keys: list[str] | str = "doc_id", **options) -> DataFrame:
    """`functionality`, keys, `rank` and `result` of every annotator and document, in key order. The documents are brought into
    key order, annotated once and written to `path`; see `sinks.ranked`."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    ranged = _keeps_order(options)
    ordered = docs.repartitionByRange(*keys).sortWithinPartitions(*keys) if ranged else docs
    return sinks.ranked(annotate(ordered, functionality, keys=keys, **options), path, keys, ranged)


SINKS = {
    "sorted": None,
    "keyed": lambda results, path, keys: sinks.write_keyed(results, path, keys[-1]),
    "json": lambda results, path, keys: sinks.write_json(results, path),
    "typed": lambda results, path, keys: sinks.write_typed(results, path),
}
