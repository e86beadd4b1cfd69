"""The checked queries: one per operator, each over whole tables of a folder of parquet files."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import html
from lexmill.functions.rows import each
from lexmill.operators import coreference, dictionary, documents, quotes, tagger
from lexmill.plans.annotate import LINE_FUNCTIONS, annotate, annotate_with_model, ranked_results, run_job
from lexmill.queries import fixtures
from lexmill.sources import readers, sinks

KEY = ["doc_id"]


def spread(spark: SparkSession, docs: DataFrame, keys: list[str]) -> DataFrame:
    """To spark.lexmill.spread partitions where that is set: for a small table that is one split of one file."""
    n = spark.conf.get("spark.lexmill.spread", None)
    return documents.spread(docs, int(n), keys) if n else docs


def docs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark, readers.read_docs(spark, sf_dir, "documents", KEY), KEY)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents and a few English ones, on which the linguistic rules fire."""
    docs = readers.read_docs(spark, sf_dir, "documents", KEY)
    return spread(spark, docs.unionByName(spark.createDataFrame(fixtures.ROWS, fixtures.SCHEMA)), KEY)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark, readers.read_docs(spark, sf_dir, "pages", ["page_id"], "html"), ["page_id"])


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page as an article of two blocks."""
    def block(kind: str, content) -> F.Column:
        return F.struct(F.lit(kind).alias("type"), content.alias("content"))
    return pages(spark, sf_dir).select("page_id", F.array(
        block("sanitized_html", F.col("text")), block("image", F.lit("picture.png"))).alias("contents"))


def scratch(spark: SparkSession) -> str:
    """A new folder in the one the cluster names in spark.checkpoint.dir, which all executors must share; a folder of
    this machine only where none is set and Spark runs on this machine alone."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/run-{uuid.uuid4()}"
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="lexmill-")


def table(fn: Callable, *args, **kwargs) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(corpus(spark, sf_dir), KEY, *args, **kwargs)


def token_layer(layer: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: documents.token_rows(corpus(spark, sf_dir), KEY, [layer])


def asked(functionality: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: annotate(corpus(spark, sf_dir), functionality)


def regexner(spark, sf_dir):
    return dictionary.regexner_table(corpus(spark, sf_dir), KEY, fixtures.RULES)


def ner_gazetteer(spark, sf_dir):
    """Names from a table drawn from the documents."""
    docs = corpus(spark, sf_dir)
    return dictionary.regexner_table(docs, KEY, (), gazetteer=openings(docs))


def regexner_rules(spark, sf_dir):
    """Rules with ties, nulls, odd blanks and a frequent word: as a list, as a table that is walked and as one that is joined."""
    table_ = spark.createDataFrame(fixtures.ODD_RULES, "pattern string, type string")
    forms = {"list": fixtures.ODD_RULES, "trie": table_, "join": table_}
    return dictionary.regexner_forms(corpus(spark, sf_dir), KEY, {
        form: dictionary.as_rules(rules, 0 if form == "join" else 1 << 20) for form, rules in forms.items()})


def silver(spark: SparkSession, sf_dir: str, layer: str) -> DataFrame:
    """What the built-in rules say of the corpus, as labels to learn from."""
    return documents.analysed(corpus(spark, sf_dir), KEY, [layer])


def tagger_counts(spark, sf_dir):
    return tagger.train(silver(spark, sf_dir, "pos"), "pos")


def lemma_counts(spark, sf_dir):
    return tagger.train_lemmas(documents.analysed(corpus(spark, sf_dir), KEY, ["pos", "lems"]))


def let_go(spark: SparkSession) -> None:
    """Spark deletes what was shuffled for frames that are no longer used only when the driver collects its garbage, which
    Python's references to them keep from it."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(frame: DataFrame) -> DataFrame:
    """Written as Parquet and read back, as a model's counts are."""
    path = scratch(frame.sparkSession)
    let_go(frame.sparkSession)
    frame.write.parquet(path, compression="zstd")
    return frame.sparkSession.read.parquet(path)


def learned_layers(spark, sf_dir):
    """Parts of speech, lemmas and entities by models that were learned from every other document, on all documents."""
    labels = stored(documents.analysed(corpus(spark, sf_dir), KEY, ["pos", "lems", "ner"]).where("pmod(doc_id, 2) = 0"))
    taggers = {name: tagger.tagger(stored(tagger.train(labels, name))) for name in ("pos", "ner")}
    taggers["lemma"] = tagger.lemmatizer(stored(tagger.train_lemmas(labels)))
    let_go(spark)
    return documents.token_rows(corpus(spark, sf_dir), KEY, ["pos", "lems", "ner"], taggers=taggers, gazetteer=[])


def openings(docs: DataFrame) -> DataFrame:
    """A dictionary that grows with the data: the first two words of every document."""
    first = F.regexp_extract("text", r"^(\p{L}+ \p{L}+)(?:[ .,]|\z)", 1)
    return docs.select(first.alias("pattern")).where("pattern != ''").distinct().withColumn("type", F.lit("OPENING"))


def regexner_join(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    return dictionary.regexner_table(docs, KEY, openings(docs))


def relation_table(spark, sf_dir):
    """Relations between names drawn from the documents, by a table of patterns."""
    docs = corpus(spark, sf_dir)
    patterns = spark.createDataFrame(fixtures.OPENING_PATTERNS, "first string, lemma string, second string, relation string")
    return documents.relations_table(docs, KEY, patterns=patterns, gazetteer=dictionary.as_gazetteer(openings(docs)))


def sentence_list(spark, sf_dir):
    return documents.sentence_lists(corpus(spark, sf_dir), KEY)


def cleanxml(spark, sf_dir):
    return annotate(pages(spark, sf_dir), "cleanxml", keys="page_id")


def line_as_sentence(spark, sf_dir):
    keys = ["conv_id", "turn"]
    lines = spread(spark, readers.read_docs(spark, sf_dir, "conversations", keys), keys)
    return annotate(lines, LINE_FUNCTIONS, keys=keys, line_as_sentence=True)


def select_blocks(spark, sf_dir):
    blocks = articles(spark, sf_dir).select("page_id", html.select_blocks(F.col("contents")).alias("blocks"))
    return each(blocks, ["page_id"], "blocks", "block_idx", "content")


def html_to_text(spark, sf_dir, convert=html.html_to_text):
    return pages(spark, sf_dir).select("page_id", convert(F.col("text"), ("script", "style")).alias("text"))


def articles_to_lines(spark, sf_dir):
    return articles(spark, sf_dir).select("page_id", html.article_text(F.col("contents"), nfkd=False).alias("text"))


def drop_newlines(spark, sf_dir):
    return docs_of(spark, sf_dir).select("doc_id", html.drop_newlines(F.col("text")).alias("text"))


def normalize_nfkd(spark, sf_dir):
    return docs_of(spark, sf_dir).select("doc_id", html.normalize_nfkd(F.col("text")).alias("text"))


def one_line_docs(spark, sf_dir):
    return docs_of(spark, sf_dir).withColumn("text", F.regexp_replace("text", r"[\r\n]", " "))


def plain_lines(spark, sf_dir, read=readers.read_plain_lines):
    path = scratch(spark)
    sinks.write_lines(one_line_docs(spark, sf_dir), path)
    return read(spark, path)


def read_lines_indexed(spark, sf_dir):
    """Per text how often it was read; `first` is 0 and `gap` counts numbers that are missing or given twice."""
    lines = plain_lines(spark, sf_dir, readers.read_lines)
    return lines.groupBy("text").agg(F.count("*").alias("n")).crossJoin(F.broadcast(lines.agg(
        F.min("doc_id").alias("first"), (F.max("doc_id") + 1 - F.countDistinct("doc_id")).alias("gap"))))


def lines_by_offset(spark, sf_dir):
    """`off`: the byte offset of a line less the widths of the lines before it in its file, which is 0."""
    lines = plain_lines(spark, sf_dir, readers.read_lines_by_offset)
    before = Window.partitionBy("path").orderBy("byte_offset").rowsBetween(Window.unboundedPreceding, -1)
    widths = F.coalesce(F.sum(F.octet_length("text") + 1).over(before), F.lit(0))
    return lines.select((F.col("byte_offset") - widths).alias("off"), "text")


def read_rules(spark, sf_dir):
    """The openings of the documents, written as a dictionary file and read back."""
    path = scratch(spark)
    openings(docs_of(spark, sf_dir)).select(F.concat_ws("\t", "pattern", "type").alias("value")).write.mode("overwrite").text(path)
    return readers.read_rules(spark, path)


def read_articles(spark, sf_dir):
    path = scratch(spark)
    articles(spark, sf_dir).select(F.col("page_id").cast("string").alias("id"), "contents").write.mode("overwrite").json(path)
    return readers.read_articles(spark, path).select(
        "id", F.size("contents").cast("bigint").alias("n_blocks"), F.get("contents", F.lit(0)).content.alias("content"))


def spread_rows(spark, sf_dir):
    """How many partitions have rows, and how many rows there are: 16 and all of them, once spread."""
    rows = documents.spread(readers.read_docs(spark, sf_dir, "documents", KEY), 16)
    sizes = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("parts"), F.sum("n").alias("n_rows"), (F.max("n") - F.min("n") <= 16).alias("even"))


def sorted_results(spark, sf_dir):
    return ranked_results(corpus(spark, sf_dir), "tokenize", scratch(spark))


def sink_by_functionality(spark, sf_dir):
    path = scratch(spark)
    run_job(one_line_docs(spark, sf_dir), "tokenize,pos", path)
    return spark.read.text(path).select(F.col("functionality").cast("string").alias("functionality"), F.col("value").alias("result"))


def sink_keyed(spark, sf_dir):
    path = scratch(spark)
    sinks.write_keyed(annotate(docs_of(spark, sf_dir), "tokenize"), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def sink_json(spark, sf_dir):
    path = scratch(spark)
    sinks.write_json(annotate(docs_of(spark, sf_dir), "tokenize"), path)
    return spark.read.schema("functionality string, doc_id bigint, result string").json(path)


def with_model(spark, sf_dir):
    def factory():
        def model(batch: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"doc_id": batch["doc_id"], "n_chars": batch["text"].str.len().astype("int64")})
        return model
    return annotate_with_model(docs_of(spark, sf_dir), factory, "doc_id bigint, n_chars bigint")


def model_errors(spark, sf_dir):
    """A model that fails on texts of an odd length: their rows alone are lost, and say why."""
    def factory():
        def model(batch: pd.DataFrame) -> pd.DataFrame:
            if (batch["text"].str.len() % 2).any():
                raise ValueError("odd")
            return pd.DataFrame({"doc_id": batch["doc_id"], "n_chars": batch["text"].str.len().astype("int64")})
        return model
    return annotate_with_model(docs_of(spark, sf_dir), factory, "doc_id bigint, n_chars bigint", error="problem")


def progress(spark, sf_dir):
    """What the observation saw once a job had run over the counted documents."""
    counted, seen = sinks.counted(readers.read_docs(spark, sf_dir, "documents", KEY))
    counted.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["n"],)], "n bigint")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "tokenize": table(documents.tokens_table),
        "ssplit": table(documents.sentences_table),
        "sentence_list": sentence_list,
        "cleanxml": cleanxml,
        "pos": token_layer("pos"),
        "lemma": token_layer("lems"),
        "ner": token_layer("ner"),
        "regexner": regexner,
        "regexner_join": regexner_join,
        "regexner_rules": regexner_rules,
        "ner_gazetteer": ner_gazetteer,
        "tagger_counts": tagger_counts,
        "lemma_counts": lemma_counts,
        "learned_layers": learned_layers,
        "natlog": token_layer("pol"),
        "sentiment": table(documents.sentiments_table),
        "doc_sentiment": table(documents.document_sentiments),
        "parse_chunks": table(documents.chunks_table),
        "depparse_edges": table(documents.edges_table),
        "first_governor": table(documents.first_governors),
        "coref": table(coreference.mentions_table, "coref"),
        "coref_text": asked("coref"),
        "dcoref": table(coreference.mentions_table, "dcoref"),
        "dcoref_text": asked("dcoref"),
        "relation": table(documents.relations_table),
        "relation_table": relation_table,
        "quote": table(quotes.quotes_table),
        "openie": table(documents.triples_table),
        "line_as_sentence": line_as_sentence,
        "annotate_long": asked("tokenize,ssplit,pos,lemma,ner"),
        "annotate_syntax": asked("parse,depparse,natlog,sentiment"),
        "annotate_with_model": with_model,
        "model_errors": model_errors,
        "progress": progress,
        "select_blocks": select_blocks,
        "html_to_text": html_to_text,
        "html_to_text_exact": partial(html_to_text, convert=html.html_to_text_exact),
        "normalize_nfkd": normalize_nfkd,
        "drop_newlines": drop_newlines,
        "articles_to_lines": articles_to_lines,
        "plain_lines": plain_lines,
        "read_lines_indexed": read_lines_indexed,
        "read_lines_by_offset": lines_by_offset,
        "read_articles": read_articles,
        "read_rules": read_rules,
        "spread": spread_rows,
        "sorted_results": sorted_results,
        "sink_by_functionality": sink_by_functionality,
        "sink_keyed": sink_keyed,
        "sink_json": sink_json,
    }
