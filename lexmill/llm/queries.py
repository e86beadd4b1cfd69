"""The operators over the tables they are meant for; their SQL is in oracle.py."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import bpe, decontaminate, html, language, licenses, quality, repeats, runs, search, secrets, sharding, simhash, topk
from lexmill.llm.common import documents, shared_folder
from lexmill.llm.oracle import oracle_sql


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe.encoded(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.mapInArrow(bpe.digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(repeats.repeated(documents(spark, sf_dir)))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rated(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(documents(spark, sf_dir))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.report(decontaminate.leaks(documents(spark, sf_dir).select("doc_id", "text"), benchmark))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(documents(spark, sf_dir).select("doc_id", "text"), shared_folder(spark, "ledger")))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.identify(docs.select("doc_id", "text"), language.learn(docs), spans=False)
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "language.lang_pred", "language.score")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; of each tenth document by the checksum of its id, the words from one of them on are those of a
    period over and over."""
    words, h = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), F.crc32(F.col("doc_id").cast("string").cast("binary"))
    dealt = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))
    dealt = dealt.withColumn("a", F.when(F.size("w") > 0, F.col("g") % F.size("w")).cast("int"))
    dealt = dealt.withColumn("p", F.expr("CAST(1 + (size(w) - a) DIV (3 + g % 8) AS INT)"))
    again = F.expr("concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), CAST(4 + g % 8 AS INT))), 1, size(w) - a))")
    return dealt.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_periods(documents(spark, sf_dir)))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                         F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), "best.length", (-F.col("best.period")).alias("period"),
                        F.expr("1000 * best.length DIV -best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 20)


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20, 64)


__all__ = ["oracle_sql", "queries"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_bpe, op2_repeats, op3_quality, op4_sharding, op5_decontamination, op6_secrets, op7_language, op8_licenses, op9_simhash, op10_html, op11_runs, op12_search,
        op13_topk)}
