"""Periodic runs of words, by catching squares as words are appended.

Words come one after the other. Whenever a power of two of them is complete, that block gets a catcher, which waits for the
words between two and four block lengths further on: if a square xx of period p has arrived, with 2 * size <= p < 4 * size,
then its first half holds a whole block of that size, and the block stands again p words later. So each appended word has,
for each block size, the suffix that it ends compared with the two catchers in reach, by a hash that is put together from
those of the suffix's halves. A block of one word also watches the next word.

What a catcher has caught in a row, block after block at one distance, is merged into one stretch, held against the words
themselves and extended to both ends: a run. A stretch inside a run of a smaller period is skipped if it is no longer than
that run; the same words under a multiple of their period are dropped in the end.

The texts of a block of documents are one stream of words. Between two of them stands a word that equals no other, so that
no square crosses it, and all words of the stream advance in one array operation for each block size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import blocks

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
#: Odd factors of the suffix hashes.
LEFT, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def doubled(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every 2 * size words from those of every size words."""
    with np.errstate(over="ignore"):
        out = hashes[:-size] * LEFT + hashes[size:]
        out ^= out >> np.uint64(32)
        out *= MIX
    return out


def caught(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and distance of every completed block that stands again, from two to four block lengths on (and of one word,
    right after it)."""
    rows = -(-len(hashes) // size)
    grid = np.zeros(rows * size, np.uint64)
    grid[:len(hashes)] = hashes
    grid = grid.reshape(rows, size)
    begins, distances = [], []
    for back in (1, 2, 3) if size == 1 else (2, 3):
        row, column = np.nonzero(grid[back:] == grid[:-back, :1])
        inside = (row + back) * size + column < len(hashes)
        begins.append(row[inside] * size)
        distances.append(back * size + column[inside])
    return np.concatenate(begins), np.concatenate(distances)


def merged(begins: np.ndarray, distances: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and distance of what was caught block after block at one distance."""
    order = np.lexsort((begins, distances))
    begins, distances = begins[order], distances[order]
    new = np.ones(len(begins), bool)
    new[1:] = (distances[1:] != distances[:-1]) | (begins[1:] != begins[:-1] + size)
    first = np.flatnonzero(new)
    last = np.append(first, len(begins))[1:] - 1
    return begins[first], begins[last] + size, distances[first]


def stretches(words: np.ndarray, begin: int, end: int, period: int, size: int) -> Iterator[tuple[int, int]]:
    """Where words equal those a period later around [begin, end), as far as that goes to both sides. A side is shorter
    than a block, since the next block would have been caught too."""
    low, high = max(0, begin - size), min(len(words) - period, end + size)
    same = np.zeros(high - low + 2, np.int8)
    same[1:-1] = words[low:high] == words[low + period:high + period]
    turns = np.flatnonzero(np.diff(same)) + low
    yield from zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True)


def find(words: np.ndarray, longest: int, exponent: int = 2, shortest: int = 2) -> np.ndarray:
    """Rows (start, end, period) of all runs of at least exponent (2 or more) periods and shortest words, by start and
    period. Words are numbers; no stretch between words that stand once is longer than longest."""
    found: list[tuple[int, int, int]] = []
    reach = np.zeros(len(words) + 1, np.int64)  # for each word, the end of the run of a small period around it
    noted = 0
    hashes, size = words.astype(np.uint64), 1
    while exponent * (1 if size == 1 else 2 * size) <= longest and len(hashes) > size:
        small = [r for r in found[noted:] if r[2] <= size]
        for start, end, _ in small:
            np.maximum(reach[start:end], end, out=reach[start:end])
        found[noted:] = small + [r for r in found[noted:] if r[2] > size]
        noted += len(small)
        begins, distances = caught(hashes, size)
        fresh = reach[begins] < begins + distances + size
        begins, ends, periods = merged(begins[fresh], distances[fresh], size)
        least = np.maximum((exponent - 1) * periods, shortest - periods)
        likely = np.flatnonzero(ends - begins + 2 * (size - 1) >= least)
        for begin, end, period, need in zip(*(x[likely].tolist() for x in (begins, ends, periods, least)), strict=True):
            found.extend((a, b + period, period) for a, b in stretches(words, begin, end, period, size) if b - a >= need)
        hashes, size = doubled(hashes, size), 2 * size
    if not found:
        return np.empty((0, 3), np.int64)
    runs = np.unique(np.array(found, np.int64), axis=0)  # by start, end, period
    smallest = np.ones(len(runs), bool)
    smallest[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[smallest]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def numbered(texts: list[bytes | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each text; a number for each word of all of them, with one of its own after each text; where each begins."""
    split = [[] if t is None else t.split() for t in texts]  # of bytes: at space and \x09-\x0d alone
    bounds = np.cumsum([0] + [len(ws) + 1 for ws in split])
    numbers: dict[bytes, int] = {}
    stream = np.empty(bounds[-1], np.int64)
    for ws, a, b in zip(split, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        stream[a:b - 1] = np.fromiter((numbers.setdefault(w, len(numbers)) for w in ws), np.int64, len(ws))
    stream[bounds[1:] - 1] = len(numbers) + np.arange(len(split))
    return split, stream, bounds


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def run_rows(batches: Iterator[pa.RecordBatch], exponent: int, shortest: int) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "text"):
        split, stream, bounds = numbered(batch.column(1).cast(pa.binary()).to_pylist())
        runs = find(stream, max(map(len, split), default=0), exponent, shortest)
        owner = np.searchsorted(bounds, runs[:, 0], side="right") - 1
        rows: list[list[tuple[int, int, int]]] = [[] for _ in split]
        for i, (start, end, period) in zip(owner.tolist(), runs.tolist(), strict=True):
            rows[i].append((start - int(bounds[i]), end - start, period))
        texts = [collapsed(ws, rs) for ws, rs in zip(split, rows, strict=True)]
        lists = [[{"start": s, "length": n, "period": p} for s, n, p in rs] for rs in rows]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, RUN_TYPE), pa.array(texts, pa.binary()).cast(pa.string())],
                                         ["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, exponent: int = 4, shortest: int = 6, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, runs (start in words from 0, length, period; by start, then period) and collapsed, the words joined by one
    space without those that a run holds after its first period.

    Words are parted by ASCII white space. A run is a stretch with its smallest period, of at least exponent periods and
    shortest words, that no neighbouring word extends. A null or blank text has no run and is collapsed to an empty one.
    Every row is returned, repeated ones and null ids too; columns other than the two named are not read. A task holds a
    block of texts of about 4 MB, or one longer text."""
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        lambda batches: run_rows(batches, exponent, shortest), f"doc_id long, runs {RUNS}, collapsed string")
