"""Sources: text lines with a line number or byte offset, articles, dictionaries, any table."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions.text import running_sum

ARTICLES = "id string, contents array<struct<type:string,content:string>>"
ROW_BITS = 33  # a monotonically increasing id keeps the row number in its low 33 bits


def read_plain_lines(spark: SparkSession, path) -> DataFrame:
    """`text`, one row per line."""
    return spark.read.text(path).withColumnRenamed("value", "text")


def read_lines(spark: SparkSession, path) -> DataFrame:
    """`doc_id, text` with a 0-based line number over all files, empty lines counted.

    A first job counts the lines of each split; the numbers of a split then start at the count of the
    splits before it. The text itself is neither shuffled nor sent to Python."""
    lines = read_plain_lines(spark, path)
    lines = lines.withColumn("split", F.spark_partition_id()).withColumn("mid", F.monotonically_increasing_id())
    counts = lines.groupBy("split").agg(F.count("*").alias("n"))
    # One row per split of the input, not per line.
    before = F.sum("n").over(Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("split", F.coalesce(before, F.lit(0)).alias("base"))
    in_split = F.col("mid").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # The join is on the split, of which a broadcast row is 100 bytes: 100 TB in splits of 128 MB are 80 MB.
    return lines.join(F.broadcast(bases), "split").select((F.col("base") + in_split).alias("doc_id"), "text")


def read_lines_by_offset(spark: SparkSession, path) -> DataFrame:
    """`path, byte_offset, text`: the 0-based byte at which each line starts in its file. Lines end with
    LF, CRLF or CR.

    Offsets are summed within each split by a small Arrow helper, and the bytes of the splits before it
    in the same file (one row per split) are added by a join."""
    def offsets_in_split(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, upto = None, 0
        for batch in batches:
            where = list(zip(batch["path"], batch["block"]))
            ends = batch["width"].to_numpy()
            starts = np.empty(len(batch), dtype="int64")
            cuts = [i for i in range(len(where)) if i == 0 or where[i] != where[i - 1]] + [len(where)]
            for a, b in zip(cuts, cuts[1:]):
                if where[a] != block:
                    block, upto = where[a], 0
                sums = np.cumsum(ends[a:b])
                starts[a:b] = upto + sums - ends[a:b]
                upto += int(sums[-1])
            yield batch.assign(offset=starts)[["path", "block", "offset", "value"]]

    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        (F.octet_length("value") + 1).cast("bigint").alias("width"), "value")
    inside = raw.mapInPandas(offsets_in_split, "path string, block bigint, offset bigint, value string")
    sizes = raw.groupBy("path", "block").agg(F.sum("width").alias("bytes"))
    before = F.sum("bytes").over(
        Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("path", "block", F.coalesce(before, F.lit(0)).alias("base"))
    lines = inside.join(F.broadcast(bases), ["path", "block"]).select(  # one row per split of a file
        "path", (F.col("base") + F.col("offset")).alias("start"), F.regexp_replace("value", r"\r\z", "").alias("value"))
    # A lone CR is a line end too.
    parts = F.split("value", "\r")
    ends = F.expr(running_sum("transform(split(value, '\\r'), p -> CAST(octet_length(p) + 1 AS BIGINT))"))
    return (lines.select("path", "start", F.inline(F.arrays_zip(parts.alias("text"), ends.alias("upto"))))
            .select("path", (F.col("start") + F.col("upto") - F.octet_length("text") - 1).alias("byte_offset"), "text"))


def read_articles(spark: SparkSession, path) -> DataFrame:
    """`id, contents, _corrupt_record` from JSON lines; a bad line becomes a row with only the record."""
    return (spark.read.schema(ARTICLES + ", _corrupt_record string")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


def read_numbered_articles(spark: SparkSession, path) -> DataFrame:
    """`doc_id, id, contents, _corrupt_record`: as `read_articles`, with the line number as key, since an article's own
    id may be missing or given twice."""
    schema = ARTICLES + ", _corrupt_record string"
    record = F.from_json("text", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return read_lines(spark, path).where("trim(text) != ''").select("doc_id", record.alias("r")).select("doc_id", "r.*")


def read_rules(spark: SparkSession, path) -> DataFrame:
    """`pattern, type` from lines `phrase TAB type`."""
    return (spark.read.csv(path, sep="\t", schema="pattern string, type string", quote="")
            .where(F.col("pattern").isNotNull() & F.col("type").isNotNull()))


def read_docs(spark: SparkSession, folder: str, table: str, keys: list[str], text_col: str = "text") -> DataFrame:
    """Keys and `text` of a parquet table; only these columns are read."""
    return spark.read.parquet(f"{folder}/{table}.parquet").select(*keys, F.col(text_col).alias("text"))
