"""Benchmark decontamination with an FM-index for each shard of the training text.

A shard is a block of documents inside a task. Its text is a sequence of word numbers over the words of the benchmark;
a word that no item has can be in no window, so a stretch of such words is one separator, and stretches too short for
any window are left out. The index of that sequence (suffix array, Burrows-Wheeler transform in a wavelet tree with
rank blocks, every SAMPLE-th suffix position) is searched backwards for all windows at once; hits are located by
stepping to a sampled position, and overlapping hits are merged to spans.

Documents are neither shuffled nor split. The benchmark is sent to the executors in parts of PART_BYTES of text, each
searched in a pass of its own after the last, so that its size is bounded whatever the benchmark's is.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import blocks

WINDOW = 10
SAMPLE = 8
SHARD_BYTES = 4 << 20
#: Bytes of benchmark text that are searched in one pass.
PART_BYTES = 8 << 20
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Lower-cases A-Z and makes a space of every byte outside [0-9A-Za-z\x80-\xff].
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
LEAK = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("stop", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("long", T.BooleanType())])
ARROW_LEAK = pa.struct({
    "n_words": pa.int64(), "spans": pa.list_(pa.struct({"first": pa.int64(), "stop": pa.int64()})), "items": pa.list_(pa.string()), "long": pa.bool_()})


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


class Bits:
    """A bit vector with the number of ones before every 64th place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """The ones before each place."""
        inside = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & inside)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


class WaveletTree:
    """Ranks of symbols in a sequence: a level for each bit of a symbol, from the highest, zeros before ones."""

    def __init__(self, symbols: np.ndarray, highest: int):
        self.levels = []
        for bit in range(max(1, highest.bit_length()) - 1, -1, -1):
            ones = (symbols >> bit) & 1
            self.levels.append((bit, Bits(ones), int(len(ones) - ones.sum())))
            symbols = np.concatenate((symbols[ones == 0], symbols[ones == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        start = np.zeros_like(at)
        for bit, bits, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            a, b = bits.rank(start), bits.rank(at)
            start, at = np.where(one, zeros + a, start - a), np.where(one, zeros + b, at - b)
        return at - start

    def get(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for bit, bits, zeros in self.levels:
            one, ones = bits.get(at) == 1, bits.rank(at)
            out |= one.astype(out.dtype) << bit
            at = np.where(one, zeros + ones, at - ones)
        return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the length that is compared; the last symbol must be the only smallest one."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        behind = np.zeros_like(rank)
        behind[:-step] = rank[step:] + 1
        pair = rank * (len(text) + 2) + behind
        order = np.argsort(pair, kind="stable")
        new = np.concatenate(([0], np.cumsum(pair[order][1:] != pair[order][:-1])))
        rank[order] = new
        if new[-1] == len(text) - 1 or step >= len(text):
            return order
        step *= 2


class FMIndex:
    def __init__(self, text: np.ndarray, highest: int):
        """text: symbols from 1 to highest; the end is marked here."""
        text = np.append(text, 0)
        order = suffix_array(text)
        self.tree = WaveletTree(text[order - 1], highest)
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=highest + 1))))
        sampled = order % SAMPLE == 0
        self.marks, self.samples = Bits(sampled), order[sampled]
        self.size = len(text)

    def back(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.smaller[symbol] + self.tree.rank(symbol, row)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [from, to) of suffixes that begin with each phrase; a phrase is a row, 0 fills it up at its front."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for column in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((phrases[:, column] > 0) & (low < high))
            symbol = phrases[live, column]
            low[live], high[live] = self.back(symbol, low[live]), self.back(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of the rows begin: steps back to a sampled one, of which there is one in SAMPLE."""
        out, steps, left, row = np.zeros_like(rows), 0, np.arange(len(rows)), rows
        while len(left):
            marked = self.marks.get(row) == 1
            out[left[marked]] = self.samples[self.marks.rank(row[marked])] + steps
            left, row = left[~marked], row[~marked]
            row = self.back(self.tree.get(row), row) if len(row) else row
            steps += 1
        return out


class Part:
    """The windows of a part of the benchmark: numbers of its words, distinct windows, and whose they are."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for name, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 2) for w in words_of(text)]  # 1 parts stretches
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners[tuple(words[i:i + window])].add(name)
        self.owners = [sorted(x) for x in owners.values()]
        self.lengths = np.array([len(w) for w in owners], np.int64)
        self.phrases = np.array([(0,) * (window - len(w)) + w for w in owners], np.int64).reshape(-1, window)
        self.window = window


def search_block(part: Part, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[set[str]], np.ndarray]:
    """Where each text's words begin in the block; which words are hit; each text's items; which have a full window."""
    words = [words_of(t) for t in texts]
    bounds = np.concatenate(([0], np.cumsum([len(w) for w in words], dtype=np.int64)))
    hit, items, full = np.zeros(bounds[-1], bool), [set() for _ in texts], np.zeros(len(texts), bool)
    if not len(part.lengths) or not len(hit):
        return bounds, hit, items, full
    numbers = np.concatenate([np.fromiter(map(part.numbers.get, w, repeat(0)), np.int64, len(w)) for w in words])
    ends = np.zeros(len(numbers) + 1, bool)  # a stretch also ends with its text
    ends[bounds] = True
    known = numbers > 0
    begins = known & np.concatenate(([True], ~known[:-1] | ends[1:-1]))
    stops = known & np.concatenate((~known[1:] | ends[1:-1], [True]))
    first, last = np.flatnonzero(begins), np.flatnonzero(stops)
    enough = last - first + 1 >= part.lengths.min()
    first, last = first[enough], last[enough]
    if not len(first):
        return bounds, hit, items, full
    sizes = last - first + 2  # with a separator
    at = np.cumsum(sizes) - sizes
    place = np.repeat(first - at, sizes) + np.arange(sizes.sum())
    symbols = np.ones(len(place), np.int64)
    inside = np.ones(len(place), bool)
    inside[at + sizes - 1] = False
    symbols[inside] = numbers[place[inside]]
    index = FMIndex(symbols, len(part.numbers) + 1)
    low, high = index.search(part.phrases)
    counts = high - low
    found = np.repeat(np.arange(len(counts)), counts)
    rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + low[found]
    start = place[index.locate(rows)]
    change = np.zeros(len(hit) + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + part.lengths[found], -1)
    hit = np.cumsum(change[:-1]) > 0
    doc = np.searchsorted(bounds, start, side="right") - 1
    for d, w in np.unique(np.stack((doc, found), axis=1), axis=0).tolist():
        items[d].update(part.owners[w])
        full[d] |= part.lengths[w] == part.window
    return bounds, hit, items, full


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def search_part(part: Part, text: str, name: str):
    """Adds what this part finds to the column name, which holds what the parts before it found, or null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text, SHARD_BYTES):
            texts = [(x or "").encode() for x in batch.column(text).to_pylist()]
            bounds, hit, items, full = search_block(part, texts)
            touched = np.array([bool(x) for x in items], bool)
            out = []
            for i, before in enumerate(batch.column(name).to_pylist()):
                names, long, own = items[i], bool(full[i]), None
                if touched[i]:
                    own = hit[bounds[i]:bounds[i + 1]].copy()
                if before and before["items"]:
                    own = np.zeros(bounds[i + 1] - bounds[i], bool) if own is None else own
                    for s in before["spans"]:
                        own[s["first"]:s["stop"]] = True
                    names, long = names | set(before["items"]), long or before["long"]
                spans = [{"first": a, "stop": b} for a, b in runs(own)] if own is not None else []
                out.append({"n_words": int(bounds[i + 1] - bounds[i]), "spans": spans, "items": sorted(names), "long": long})
            at = batch.schema.get_field_index(name)
            yield batch.set_column(at, name, pa.array(out, ARROW_LEAK))
    return run


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
          window: int = WINDOW, name: str = "leak", part_bytes: int = PART_BYTES, then=None, schema: T.StructType | None = None) -> DataFrame:
    """The documents, all columns, with a column name: n_words; spans (words from first to before stop, merged); items
    (ids of benchmark items as sorted strings); long (a hit of a full window, not only of a shorter item).

    Words are lower-cased (A-Z) runs of [0-9A-Za-z] and non-ASCII characters. A null or empty text has no words and no
    hits; so has a null item. An item of fewer words than a window is one window. Items of one id count as one, a null
    id is written as an empty string. A column that is called name already is replaced."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"), F.col(item_text).alias("body")) \
        .where("body IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = max(1, math.ceil(size / part_bytes))
    out = docs.withColumn(name, F.lit(None).cast(LEAK))
    for i in range(parts):
        own = items.where(F.pmod(F.xxhash64("name", "body"), F.lit(parts)) == i).collect()  # about part_bytes
        search = search_part(Part([(r.name, r.body.encode()) for r in own], window), text, name)
        if then and i == parts - 1:
            return out.mapInArrow(lambda batches, search=search: then(search(batches)), schema)
        out = out.mapInArrow(search, out.schema)
    return out


def without_spans(batches: Iterator[pa.RecordBatch], text: str, name: str) -> Iterator[pa.RecordBatch]:
    """Cuts the spans of the column name out of the texts and drops that column."""
    for batch in batches:
        out = []
        for body, leak in zip(batch.column(text).to_pylist(), batch.column(name).to_pylist(), strict=True):
            if leak["spans"]:
                data = body.encode()
                places = [m.span() for m in WORD.finditer(data)]
                kept, done = [], 0
                for s in leak["spans"]:
                    kept.append(data[done:places[s["first"]][0]])
                    done = places[s["stop"] - 1][1]
                body = b"".join([*kept, data[done:]]).decode()
            out.append(body)
        at = batch.schema.get_field_index(text)
        cleaned = batch.set_column(at, text, pa.array(out, pa.string()))
        yield cleaned.select([n for n in cleaned.schema.names if n != name])


def cut(found: DataFrame, text: str = "text", name: str = "leak") -> DataFrame:
    """What leaks() gave, with the spans cut out of the texts and without the column name."""
    schema = T.StructType([f for f in found.schema if f.name != name])
    return found.mapInArrow(lambda batches: without_spans(batches, text, name), schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", name: str = "__leak", **options) -> DataFrame:
    """The documents without those that have a full window of an item, and without the words of shorter items."""
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            long = pa.array([x["long"] for x in batch.column(name).to_pylist()], pa.bool_())
            yield from without_spans(iter([batch.filter(pa.compute.invert(long))]), text, name)
    return leaks(docs, benchmark, text, name=name, then=finish, schema=docs.drop(name).schema, **options)


def report(found: DataFrame, doc_id: str = "doc_id", name: str = "leak") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    leak = F.col(name)
    hit = F.aggregate(leak.spans, F.lit(0).cast("long"), lambda n, s: n + s.stop - s.first)
    return found.select(
        F.col(doc_id).alias("doc_id"), leak.n_words.alias("n_words"), hit.alias("n_hit"), F.size(leak["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(leak["items"], ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
