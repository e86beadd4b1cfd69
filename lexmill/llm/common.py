"""What several operators share: blocks of Arrow batches, rolling hashes, checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that a Python worker unfolds at once; one longer text makes a block of its own.
BLOCK_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def unused(frame: DataFrame, *names: str) -> list[str]:
    """The names, each made longer until frame has no such column."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def blocks(batches: Iterator[pa.RecordBatch], text: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches between rows, so that the texts of a block have about size bytes at most."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(batch.schema.get_field_index(text)))
        ends = np.cumsum(pa.compute.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(batch):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def packed(rows: Iterable[tuple], schema: pa.Schema, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of rows, each of about size bytes at most, unless one row is larger."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += 64 + sum(len(x) for x in row if isinstance(x, bytes | str | list))
        if weight >= size:
            yield batch_of(held, schema)
            held, weight = [], 0
    if held:
        yield batch_of(held, schema)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings of a column, one after the other (null: none), and where each begins, with the end."""
    texts = [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) for x in texts], out=bounds[1:])
    return np.frombuffer(b"".join(texts), np.uint8), bounds


def rolling_hash(data: np.ndarray, width: int) -> np.ndarray:
    """The polynomial rolling hash (modulo 2**64, then mixed) of every window of width bytes; width is a power of 2.
    A window's hash is made of those of its halves, so that all windows are hashed in log2(width) passes."""
    base = np.uint64(0x9E3779B97F4A7C15)
    out = data.astype(np.uint64) + np.uint64(1)
    done = 1
    with np.errstate(over="ignore"):
        while done < width:
            if len(out) <= done:
                return np.empty(0, np.uint64)
            out = out[:-done] * base + out[done:]
            base = base * base
            done *= 2
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return out


def shared(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; one of this machine only where none is set and Spark
    runs on this machine alone."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lexmill-")
        context.setCheckpointDir(folder)
    return folder


def shared_folder(spark: SparkSession, name: str) -> str:
    """The path of a new folder in the shared one."""
    return f"{shared(spark).rstrip('/')}/{name}-{uuid.uuid4()}"


def saved(frame: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder."""
    shared(frame.sparkSession)
    return frame.checkpoint()
