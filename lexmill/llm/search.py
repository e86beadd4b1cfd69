"""Ranked lexical search with hashed max-sketches.

A document is folded into a sketch: an array whose width grows with its number of distinct terms, in which each place holds
the largest count of the terms that hash to it. What a count adds to a score (its impact) never falls as the count grows, so
a place also bounds the impact of every such term, and the sum of a query's looked-up impacts, weighted, is an upper bound
of its score. Sketches are made once and do not depend on the queries, nor on the statistics of the corpus.

A part of the queries is answered in two rounds. The first takes each query's FIRST * k highest bounds and scores those
documents exactly; its k-th exact score is the query's threshold. In the second, the documents whose bound reaches the
threshold of some query are scored exactly; no other can enter a result. Within a task the threshold goes on rising with
the task's own k-th score. Bounds and scores of a block of documents against all queries of a part are matrix products.

Only sketches, keys and results leave a task. The queries go in parts of PART_BYTES of text, which bounds what is
broadcast: the terms of a part, their weights by query, and the keys of the first round.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from heapq import heappush, heapreplace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import batch_of, blocks, packed, saved

#: Places of a sketch for each distinct term, rounded up to a power of 2.
SPREAD = 12
#: A count that the sketch's bytes can't hold; its impact is below MOST.
MANY = 255
#: Impacts are (SCALE * count) // (1000 * count + 12 * m), hence below SCALE / 1000.
SCALE = 1_000_000_000
MOST = SCALE // 1000
#: Documents of the first round, in multiples of k.
FIRST = 3
#: Bytes of query text that are answered at once.
PART_BYTES = 128 << 10
#: Keys of 8 bytes that are broadcast at most; more are joined by a shuffle.
FEW_KEYS = 1 << 20
#: Looked-up impacts that a task holds at once.
TILE = 1 << 22
#: Lower-cases A-Z and makes a space of every byte outside [0-9A-Za-z\x80-\xff].
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SKETCH = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary())])
HIT = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


class Corpus(NamedTuple):
    """Documents with a term, and all their terms with repeats."""
    n_docs: int
    n_terms: int

    def mass(self, n):
        """A document's m from its number of terms."""
        return 75 + (25 * n * self.n_docs) // self.n_terms

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * df + 1)))


class Part(NamedTuple):
    """Terms of a part of the queries with their hashes, and what a term's impact is multiplied by in each query."""
    terms: dict[bytes, int]
    hashes: np.ndarray
    weights: np.ndarray


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TABLE).split()


def hashed(terms) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(t) for t in terms), np.uint64, len(terms))


def impact(count, mass):
    return (SCALE * count) // (1000 * count + 12 * mass)


def sketch(counts: dict[bytes, int]) -> bytes:
    width = 1 << max(4, (SPREAD * len(counts) - 1).bit_length())
    out = np.zeros(width, np.uint8)
    most = np.minimum(np.fromiter(counts.values(), np.int64, len(counts)), MANY).astype(np.uint8)
    np.maximum.at(out, (hashed(counts) & np.uint64(width - 1)).astype(np.int64), most)
    return out.tobytes()


def sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for block in blocks(iter([batch]), "text"):
                for key, text in zip(block.column(0).to_pylist(), block.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    if terms := terms_of(text):
                        yield key, len(terms), sketch(Counter(terms))
    yield from packed(rows(), SKETCH)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """key, doc_id, text; two rows of one key are the same row twice, or are scored once too often."""
    return docs.select(F.xxhash64(F.col(doc_id), F.col(text)).alias("key"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n (terms with repeats) and sketch of every document with a term, written to the shared folder."""
    return saved(keyed(docs, doc_id, text).select("key", "text").mapInArrow(sketch_rows, "key long, n long, sketch binary"))


def document_counts(docs: DataFrame, text: str, terms: dict[bytes, int]) -> np.ndarray:
    """How many documents hold each term."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, known = np.zeros(len(sent.value), np.int64), sent.value
        for batch in blocks(batches, "text"):
            for one in batch.column(0).cast(pa.binary()).to_pylist():
                counts[[known[t] for t in set(terms_of(one)) if t in known]] += 1
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"term": pa.array(held, pa.int32()), "n": pa.array(counts[held], pa.int64())})

    found = docs.select(F.col(text).alias("text")).mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    sent.unpersist()
    out = np.zeros(len(terms), np.int64)
    out[found["term"].to_numpy()] = found["n"].to_numpy()
    return out


def bounds(batches: Iterator[pa.RecordBatch], corpus: Corpus, part: Part) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of some documents, and the upper bounds of their scores in each query: looked-up impacts times weights, in
    single precision, raised by more than all that its roundings can take away."""
    weights = part.weights.astype(np.float32)
    safe = 1 + (len(part.hashes) + 8) * 2.0 ** -23
    counts = np.arange(MANY + 1)
    for batch in batches:
        keys, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        texts = batch.column(2).to_pylist()
        widths = np.array([len(t) for t in texts], np.int64)
        for width in np.unique(widths).tolist():
            all_rows = np.flatnonzero(widths == width)
            places = (part.hashes & np.uint64(width - 1)).astype(np.int64)
            step = max(1, min(TILE // max(1, len(places)), 8 * TILE // width))
            for at in range(0, len(all_rows), step):
                rows = all_rows[at:at + step]
                folded = np.frombuffer(b"".join([texts[i] for i in rows.tolist()]), np.uint8).reshape(len(rows), width)
                impacts = impact(counts, corpus.mass(sizes[rows])[:, None]).astype(np.float32)
                impacts[:, MANY] = MOST
                looked_up = impacts[np.arange(len(rows))[:, None], folded[:, places]]
                yield keys[rows], np.ceil((looked_up @ weights).astype(np.float64) * safe)


def highest_rows(batches: Iterator[pa.RecordBatch], corpus: Corpus, part: Part, most: int) -> Iterator[pa.RecordBatch]:
    """Of each query the task's highest bounds above 0, as many as most."""
    n_items = part.weights.shape[1]
    best, holders = np.zeros((n_items, 0)), np.zeros((n_items, 0), np.int64)
    for keys, bound in bounds(batches, corpus, part):
        best = np.concatenate((best, bound.T), axis=1)
        holders = np.concatenate((holders, np.broadcast_to(keys, (n_items, len(keys)))), axis=1)
        if best.shape[1] > most:
            top = np.argpartition(-best, most - 1, axis=1)[:, :most]
            best, holders = np.take_along_axis(best, top, 1), np.take_along_axis(holders, top, 1)
    item, place = np.nonzero(best > 0)
    yield pa.RecordBatch.from_pydict({"item": pa.array(item, pa.int32()), "key": pa.array(holders[item, place], pa.int64()),
                                      "bound": pa.array(best[item, place], pa.float64())})


def reaching_rows(batches: Iterator[pa.RecordBatch], corpus: Corpus, part: Part, least: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Keys of the documents whose bound reaches the threshold of some query."""
    for keys, bound in bounds(batches, corpus, part):
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys[(bound >= least).any(axis=1)], pa.int64())})


def scored_rows(batches: Iterator[pa.RecordBatch], corpus: Corpus, part: Part, least: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """Of each query the task's k best documents by exact score, of least or more."""
    floor = least.copy()  # rises to the k-th score of this task
    best: list[list[tuple[int, int, int]]] = [[] for _ in floor]
    for batch in blocks(batches, "text"):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            terms = terms_of(text)
            held = [(part.terms[t], c) for t, c in Counter(terms).items() if t in part.terms]
            if not held:
                continue
            at, count = np.array(held, np.int64).T
            scores = impact(count, corpus.mass(len(terms))) @ part.weights[at]
            entry = (0, 0) if doc_id is None else (1, -doc_id)  # the larger the better; without an id last
            for i in np.flatnonzero(scores >= floor).tolist():
                row = (int(scores[i]), *entry)
                if len(best[i]) < k:
                    heappush(best[i], row)
                elif row > best[i][0]:
                    heapreplace(best[i], row)
                if len(best[i]) == k:
                    floor[i] = max(floor[i], best[i][0][0])
    yield batch_of([(i, -neg if known else None, score) for i, rows in enumerate(best) for score, known, neg in rows], HIT)


def best_of(hits: DataFrame, k: int) -> DataFrame:
    """item, doc_id, score, rank."""
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def answers(docs: DataFrame, index: DataFrame, corpus: Corpus, texts: list[bytes | None], k: int) -> DataFrame:
    """item (the place in texts), rank, doc_id, score; docs has key, doc_id and text."""
    context = docs.sparkSession.sparkContext
    split = [Counter(terms_of(t)) for t in texts]
    terms = {t: i for i, t in enumerate(dict.fromkeys(t for c in split for t in c))}
    df = document_counts(docs, "text", terms)
    weights = np.zeros((len(terms), len(split)), np.int64)
    for i, counts in enumerate(split):
        for t, n in counts.items():
            weights[terms[t], i] = n * corpus.weight(int(df[terms[t]]))
    sent = context.broadcast((corpus, Part(terms, hashed(terms), weights)))

    def scored(rows: DataFrame, least) -> DataFrame:
        return rows.select("doc_id", "text").mapInArrow(lambda b: scored_rows(b, *sent.value, least.value, k), "item int, doc_id long, score long")

    highest = Window.partitionBy("item").orderBy(F.col("bound").desc(), "key")
    first = index.mapInArrow(lambda b: highest_rows(b, *sent.value, FIRST * k), "item int, key long, bound double") \
        .withColumn("rank", F.row_number().over(highest)).where(F.col("rank") <= FIRST * k).select("key").distinct()
    lowest = context.broadcast(np.ones(len(split), np.int64))
    thresholds = best_of(scored(docs.join(F.broadcast(first), "key", "left_semi"), lowest), k).where(F.col("rank") == k).select("item", "score").toArrow()
    least = np.ones(len(split), np.int64)
    least[thresholds["item"].to_numpy()] = thresholds["score"].to_numpy()
    risen = context.broadcast(least)
    reaching = saved(index.mapInArrow(lambda b: reaching_rows(b, *sent.value, risen.value), "key long"))
    reaching = F.broadcast(reaching) if reaching.count() <= FEW_KEYS else reaching
    found = saved(best_of(scored(docs.join(reaching, "key", "left_semi"), risen), k).select("item", "rank", "doc_id", "score"))
    for x in (sent, lowest, risen):
        x.unpersist()
    return found


def search(docs: DataFrame, items: DataFrame, k: int, index: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: for each row of items the k documents of the highest score above 0, all where
    there are fewer, equal scores by ascending doc_id (a null one last). index is what sketches() gave for docs.

    Terms are maximal runs of letters of any case (A-Z lower-cased), digits and all characters beyond ASCII. A null text has
    none: such a document is in no statistic and no result, such an item has no row. A document that is there twice is two
    documents; an item that is there twice is answered twice. Columns other than those named are not read."""
    spark = docs.sparkSession
    index = sketches(docs, doc_id, text) if index is None else index
    docs = keyed(docs, doc_id, text)
    corpus = Corpus(*index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first())
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    size = asked.agg(F.sum(F.octet_length("text") + 16).alias("bytes")).first().bytes or 0
    dealt = saved(asked.repartition(max(1, -(-size // part_bytes))).withColumn("part", F.spark_partition_id()))
    found = []
    for r in dealt.select("part").distinct().orderBy("part").collect() if corpus.n_docs else []:
        rows = dealt.where(F.col("part") == r.part).select("item_id", "text").collect()
        names = spark.createDataFrame([(i, x.item_id) for i, x in enumerate(rows)], f"item int, item_id {dealt.schema['item_id'].dataType.simpleString()}")
        best = answers(docs, index, corpus, [x.text.encode() for x in rows], k)
        found.append(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.union, found) if found else asked.select(
        "item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
