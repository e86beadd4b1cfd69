"""From raw documents to token ids in five stages, each one an operator of lexmill.llm.

A stage takes what its predecessor wrote and returns the columns of documents; the last one returns token ids."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from lexmill.llm import bpe, decontaminate, language, secrets, simhash  # noqa: E402
from lexmill.llm.common import shared_folder  # noqa: E402

#: The language of most letters must have at least this share of them.
LEAST_SHARE = 0.5


def lean(spark: SparkSession) -> None:
    """Documents are long rows: 1,000 of them make an Arrow batch of some MB, where Spark's 10,000 would make dozens."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """n_chars, where there is such a column, follows the text."""
    return docs.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter (null and empty ones too) and those that no language has half of. The model is
    learned from the labelled rows of docs; a label is no input of a prediction. Without labelled rows all stay that have
    a letter."""
    lean(spark)
    model = language.learn(docs)
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.identify(docs, model, name="__language", spans=False)
    return found.where((F.col("__language.lang_pred") != language.UNKNOWN) & (F.col("__language.score") >= LEAST_SHARE)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts are linked if their fingerprints over three-word shingles differ in two bits or less. Of each group of linked
    texts one row stays: that of the smallest id. A null id counts as the largest; texts without a word are one group."""
    lean(spark)
    return simhash.one_of_each(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a full window of a benchmark item go. Items shorter than a window prove less: their words are cut
    out of a document, and it stays."""
    lean(spark)
    return recounted(decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; all documents stay."""
    lean(spark)
    found = secrets.scan(docs, shared_folder(spark, "ledger"), name="__findings")
    return recounted(secrets.mask(found, name="__findings"), docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), and the digests of ids and of the decoded text."""
    lean(spark)
    tokens = bpe.encoded(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("secrets", mask_secrets),
    ("tokens", encode_tokens),
]
#: No stage but the first steps of some can be written in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written to the shared folder and read again."""
    folder = shared_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
