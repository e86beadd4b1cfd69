"""Exact top-k search by inner product, through histograms of all scores.

Every vector is scored against every query, several times over, and no score is kept. In each round a task counts, for
each query, how many of its scores fall into each of BINS parts of the query's range; the sums over all tasks tell in which
part the query's k-th highest score lies, and that part is the next round's range. When parts are single numbers, the k-th
value is known, and with it how many scores are above it. The last pass returns what is above, and at the value itself each
task's smallest ids, as many as are missing; the smallest of those win.

A task need not count parts below its own k-th score, since the global one can't be lower. Queries go in blocks of
QUERY_BYTES, each broadcast and answered by itself, so that neither the driver nor a task holds more of them; the vectors
are never shuffled. Scores are whole numbers: products are summed in single or double precision where no sum can leave the
range in which these are exact, else in Python's integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import saved

#: Parts of a range, as a power of 2.
BIN_BITS = 7
BINS = 1 << BIN_BITS
#: Bytes of the query vectors that are broadcast at once.
QUERY_BYTES = 8 << 20
#: Scores that a task holds at once.
TILE = 1 << 21
WIDEST = (1 << 63) - 1


class Block(NamedTuple):
    """Queries of one length of vector."""
    ids: np.ndarray
    vectors: np.ndarray


def vectors(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and scaled vectors of a batch (id, vector), those of one length together; rows with a null id or vector, or a
    component that is null or not finite (also once scaled), are left out."""
    ids, lists = batch.column(0), batch.column(1)
    lengths = pa.compute.list_value_length(lists)
    good = pa.compute.and_(pa.compute.is_valid(ids), pa.compute.is_valid(lists))
    for length in pa.compute.unique(pa.compute.filter(lengths, good)).to_pylist():
        chosen = pa.compute.and_(good, pa.compute.fill_null(pa.compute.equal(lengths, length), False))
        own = pa.compute.filter(ids, chosen).to_numpy(zero_copy_only=False).astype(np.int64)
        values = pa.compute.list_flatten(pa.compute.filter(lists, chosen)).cast(pa.float64()).to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore", invalid="ignore"):
            scaled = np.floor(values.reshape(len(own), length) * scale)
        finite = np.isfinite(scaled).all(axis=1)
        yield own[finite], scaled[finite]


def survey_rows(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """For each length of vector how many there are, the largest sum of squares and the largest component."""
    seen: dict[int, list] = {}
    for batch in batches:
        for _, found in vectors(batch, scale):
            if len(found):
                entry = seen.setdefault(found.shape[1], [0, 0.0, 0.0])
                with np.errstate(over="ignore"):
                    entry[0] += len(found)
                    entry[1] = max(entry[1], float((found * found).sum(axis=1).max()))
                    entry[2] = max(entry[2], float(np.abs(found).max(initial=0)))
    yield pa.RecordBatch.from_pydict({"width": pa.array(list(seen), pa.int32()), "n": pa.array([e[0] for e in seen.values()], pa.int64()),
                                      "square": pa.array([e[1] for e in seen.values()], pa.float64()),
                                      "largest": pa.array([e[2] for e in seen.values()], pa.float64())})


def products(queries: np.ndarray, rows: np.ndarray, largest: float) -> np.ndarray:
    """Inner products as int64; largest is that of all components of either side."""
    bound = max(1, queries.shape[1]) * largest * largest
    if bound < 1 << 24:
        return (queries.astype(np.float32) @ rows.astype(np.float32).T).astype(np.int64)
    if bound < 1 << 53:
        return (queries @ rows.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in side], object).reshape(side.shape) for side in (queries, rows)]
    return np.clip(whole[0] @ whole[1].T, -WIDEST, WIDEST).astype(np.int64) if queries.shape[1] else np.zeros((len(queries), len(rows)), np.int64)


def tiles(batches: Iterator[pa.RecordBatch], scale: float, block: Block, largest: float) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Scores of some queries against some rows: the first query's place, the rows' ids, the scores, and which of them are
    a query's against a row of its own id."""
    step = min(len(block.ids), 1024)
    for batch in batches:
        for ids, rows in vectors(batch, scale):
            if rows.shape[1] != block.vectors.shape[1]:
                continue
            for at in range(0, len(ids), TILE // step):
                some = slice(at, at + TILE // step)
                for first in range(0, len(block.ids), step):
                    mine = block.ids[first:first + step]
                    scores = products(block.vectors[first:first + step], rows[some], largest)
                    own = np.zeros(scores.shape, bool)
                    shared = np.flatnonzero(np.isin(ids[some], mine))
                    own[:, shared] = mine[:, None] == ids[some][shared]
                    yield first, ids[some], scores, own


def histogram_rows(batches, scale, block, largest, low, shift, k) -> Iterator[pa.RecordBatch]:
    """For each query, how many scores lie in each part of its range, from the part of this task's k-th one up."""
    counts = np.zeros((len(block.ids), BINS), np.int64)
    least = low.copy()  # where the part of this task's k-th score so far begins
    for first, _, scores, own in tiles(batches, scale, block, largest):
        mine = slice(first, first + len(scores))
        counted = (scores >= least[mine, None]) & ~own
        query = np.nonzero(counted)[0] + first
        place = (scores[counted] - low[query]).view(np.uint64) >> shift[query].view(np.uint64)
        inside = place < BINS
        counts += np.bincount(query[inside] * BINS + place[inside].astype(np.int64), minlength=counts.size).reshape(counts.shape)
        full = counts[mine, ::-1].cumsum(axis=1)[:, ::-1] >= k
        least[mine] = low[mine] + (np.maximum(full.sum(axis=1) - 1, 0) << shift[mine])
    above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
    query, place = np.nonzero((counts > 0) & (above < k))
    for at in range(0, len(query), 1 << 16):
        some = slice(at, at + (1 << 16))
        yield pa.RecordBatch.from_pydict({"query": pa.array(query[some], pa.int32()), "place": pa.array(place[some], pa.int32()),
                                          "n": pa.array(counts[query[some], place[some]], pa.int64())})


def chosen_rows(batches, scale, block, largest, value, missing) -> Iterator[pa.RecordBatch]:
    """What is above a query's value, and of what is at it the smallest ids, as many as are missing."""
    level: dict[int, np.ndarray] = {}
    for first, ids, scores, own in tiles(batches, scale, block, largest):
        mine = slice(first, first + len(scores))
        query, row = np.nonzero((scores > value[mine, None]) & ~own)
        if len(query):
            yield pa.RecordBatch.from_pydict({"query_id": pa.array(block.ids[query + first], pa.int64()), "query": pa.array(query + first, pa.int32()),
                                              "vec_id": pa.array(ids[row], pa.int64()), "score": pa.array(scores[query, row], pa.int64())})
        query, row = np.nonzero((scores == value[mine, None]) & ~own)
        for some in np.split(np.arange(len(query)), np.flatnonzero(np.diff(query)) + 1) if len(query) else []:
            q = int(query[some[0]]) + first
            level[q] = np.sort(np.concatenate((level.get(q, np.empty(0, np.int64)), ids[row[some]])))[:missing[q]]
    for q, held in level.items():
        yield pa.RecordBatch.from_pydict({"query_id": pa.array(np.full(len(held), block.ids[q]), pa.int64()), "query": pa.array(np.full(len(held), q), pa.int32()),
                                          "vec_id": pa.array(held, pa.int64()), "score": pa.array(np.full(len(held), value[q]), pa.int64())})


def kth_values(rows: DataFrame, sent, low: np.ndarray, shift: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query its k-th highest score and how many of the k are at that score; where there are fewer than k, a
    value below all scores."""
    context = rows.sparkSession.sparkContext
    above = np.zeros(len(low), np.int64)
    value = np.full(len(low), -WIDEST - 1, np.int64)
    open_ = np.ones(len(low), bool)
    while open_.any():
        state = context.broadcast((np.where(open_, low, WIDEST), shift))
        counts = rows.mapInArrow(lambda b, s=state: histogram_rows(b, *sent.value, *s.value, k), "query int, place int, n long") \
            .groupBy("query", "place").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query").orderBy(F.col("place").desc())
        upper = counts.select("query", "place", "n", (F.sum("n").over(down) - F.col("n")).alias("before")).join(
            rows.sparkSession.createDataFrame(pa.table({"query": pa.array(np.arange(len(low)), pa.int32()), "known": pa.array(above, pa.int64())})), "query")
        met = upper.where((F.col("known") + F.col("before") < k) & (F.col("known") + F.col("before") + F.col("n") >= k)).toArrow()
        state.unpersist()
        at, mine = met["query"].to_numpy(), open_[met["query"].to_numpy()]
        place = np.full(len(low), -1, np.int64)
        place[at[mine]] = met["place"].to_numpy()[mine]
        above[at[mine]] += met["before"].to_numpy()[mine]
        open_ &= place >= 0  # else there are fewer than k scores
        low = np.where(open_, low + (np.maximum(place, 0) << shift), low)
        ready = open_ & (shift == 0)
        value[ready] = low[ready]
        open_ &= ~ready
        shift = np.maximum(shift - BIN_BITS, 0)
    return value, k - above


def answers(rows: DataFrame, block: Block, survey, k: int, scale: float) -> DataFrame:
    context = rows.sparkSession.sparkContext
    largest = max(survey.largest, float(np.abs(block.vectors).max(initial=0)))
    with np.errstate(over="ignore"):
        norms = np.sqrt((block.vectors ** 2).sum(axis=1)) * np.sqrt(survey.square)
    bound = [min(int(x * (1 + 1e-9)) + 2, WIDEST >> 1) if np.isfinite(x) else WIDEST >> 1 for x in norms.tolist()]
    capped = any(b == WIDEST >> 1 for b in bound)  # scores may lie anywhere in a long
    low = np.array([-WIDEST if capped else -b for b in bound], np.int64)
    bits = [64 if capped else (2 * b + 1).bit_length() for b in bound]
    shift = np.array([-(-max(0, n - BIN_BITS) // BIN_BITS) * BIN_BITS for n in bits], np.int64)  # each round's parts fill one of the last
    sent = context.broadcast((scale, block, largest))
    value, missing = kth_values(rows, sent, low, shift, k)
    state = context.broadcast((value, missing))
    chosen = rows.mapInArrow(lambda b: chosen_rows(b, *sent.value, *state.value), "query_id long, query int, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    best = saved(chosen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
    state.unpersist()
    sent.unpersist()
    return best


def packed_rows(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """The queries of a partition, those of one length of vector in one row."""
    held: dict[int, list] = {}
    for batch in batches:
        for ids, found in vectors(batch, scale):
            held.setdefault(found.shape[1], []).append((ids, found))
    for width, parts in held.items():
        ids = np.concatenate([p[0] for p in parts])
        yield pa.RecordBatch.from_pydict({"width": pa.array([width], pa.int32()), "ids": [ids.tobytes()],
                                          "vectors": [np.concatenate([p[1] for p in parts]).tobytes()]})


def top_k(rows: DataFrame, queries: DataFrame, k: int, scale: float = 1.0, vec_id: str = "vec_id", vector: str = "embedding",
          query_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row of queries the k rows of the highest inner product, all where
    there are fewer, equal scores by ascending vec_id. Components are taken as double and turned into floor(scale * x).

    Rows with the query's own vec_id are no candidates. Rows with a null vec_id or vector, or with a component that is null
    or not finite (also once scaled), take no part, nor do vectors of another length than the query's. A repeated vec_id
    is several rows: each is a candidate, and each, as a query, is answered. Scores beyond a long are cut to its ends.
    Columns other than the two named are not read."""
    spark = rows.sparkSession

    def columns(frame: DataFrame) -> DataFrame:
        return frame.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"))

    rows = columns(rows)
    survey = rows.mapInArrow(lambda b: survey_rows(b, scale), "width int, n long, square double, largest double") \
        .groupBy("width").agg(F.sum("n").alias("n"), F.max("square").alias("square"), F.max("largest").alias("largest"))
    widths = {r.width: r for r in survey.collect()}
    size = columns(queries).agg(F.sum(8 * (1 + F.size("embedding"))).alias("bytes")).first().bytes or 0
    parts = max(1, -(-size // query_bytes))
    dealt = saved(columns(queries).repartition(parts).mapInArrow(lambda b: packed_rows(b, scale), "width int, ids binary, vectors binary")
                  .withColumn("part", F.spark_partition_id()))
    found = [spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")]
    for r in dealt.select("part", "width").collect():
        own = dealt.where((F.col("part") == r.part) & (F.col("width") == r.width)).first()
        ids = np.frombuffer(own.ids, np.int64)
        if len(ids) and r.width in widths:
            block = Block(ids, np.frombuffer(own.vectors, np.float64).reshape(len(ids), r.width))
            found.append(answers(rows, block, widths[r.width], k, scale))
    return reduce(DataFrame.union, found[1:] or found)
