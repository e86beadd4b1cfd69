"""Sinks: one sorted text directory per annotator, keyed text, JSON, typed parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

def write_by_functionality(results: DataFrame, path: str, keys: list[str] | str = "doc_id", n: int | None = None,
                           ranged: bool = False) -> None:
    """`path/functionality=<name>/part-*`, sorted by key within and across the parts; the keys are dropped.

    An annotator's rows are range-partitioned by key as well, so they fill many tasks. `ranged` says the
    rows already come in key ranges, and saves that shuffle."""
    keys = [keys] if isinstance(keys, str) else keys
    if not ranged:
        results = results.repartitionByRange(*([n] if n else []), "functionality", *keys)
    (results.sortWithinPartitions("functionality", *keys).select("functionality", "result")
     .write.mode("overwrite").partitionBy("functionality").text(path))


def ranked(results: DataFrame, path: str, keys: list[str] | str = "doc_id", ordered: bool = False) -> DataFrame:
    """`functionality`, keys, `rank`, `result`: the place of each result among its annotator's in key order, from 1. `path` is
    a new folder.

    The results are written once, in key order, each with its partition and its place there; what was written is counted by
    partition, and the counts of the partitions before are added to the places, so that nothing is computed twice and no task
    holds an annotator's results whole. `ordered` says that the rows come in key order already, across partitions and within
    them; else they are range-partitioned and sorted first. Equal keys are in any order."""
    keys = [keys] if isinstance(keys, str) else keys
    if not ordered:
        results = results.repartitionByRange("functionality", *keys).sortWithinPartitions("functionality", *keys)
    # The partition in the upper bits, the row in the lower 33.
    results.withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    written = results.sparkSession.read.parquet(path).withColumn("part", F.shiftright("at", 33))
    inside = F.row_number().over(Window.partitionBy("functionality", "part").orderBy("at"))
    counts = written.groupBy("functionality", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("functionality").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("functionality", "part", F.coalesce(before, F.lit(0)).alias("base"))  # one row per partition
    return written.withColumn("inside", inside).join(bases, ["functionality", "part"]).select(
        "functionality", *keys, (F.col("base") + F.col("inside")).cast("bigint").alias("rank"), "result")


def write_keyed(results: DataFrame, path: str, key: str = "doc_id") -> None:
    """Lines `(functionality, key) TAB result`, unsorted, without a shuffle."""
    line = F.concat(F.lit("("), "functionality", F.lit(", "), F.col(key).cast("string"), F.lit(")\t"), "result")
    results.select(line.alias("value")).write.mode("overwrite").text(path)


def write_json(results: DataFrame, path: str) -> None:
    """One JSON object per result."""
    results.write.mode("overwrite").json(path)


def write_typed(frame: DataFrame, path: str) -> None:
    """Parquet with all typed columns."""
    frame.write.mode("overwrite").parquet(path)


def write_lines(frame: DataFrame, path: str, key: str = "doc_id", text_col: str = "text") -> None:
    """One line of text per row in key order, across and within the files."""
    (frame.repartitionByRange(key).sortWithinPartitions(key).select(F.col(text_col).alias("value"))
     .write.mode("overwrite").text(path))


def counted(frame: DataFrame, name: str = "progress") -> tuple[DataFrame, Observation]:
    """The frame and an observation of its row count `n`, filled by whatever job runs it."""
    seen = Observation(name)
    return frame.observe(seen, F.count(F.lit(1)).alias("n")), seen
