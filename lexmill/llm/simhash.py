"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is mapped to the bit counts of its 32 two-bit segments. One changed bit moves one count by one, so
the Manhattan distance of two count vectors never exceeds the number of differing bits: it is a lower bound that is
cheap to test. Two changed bits touch two coordinates at most, hence two of GROUPS groups of coordinates; the grid has
one family of cells for each choice of GROUPS - 2 groups, whose coordinates a cell fixes. Fingerprints within two bits
meet in at least one cell, are held against the bound there, then bit by bit.

Counts are written in unary (0: 00, 1: 01, 2: 11), which makes the Manhattan distance a population count.

Only distinct fingerprints enter the grid, so copies cost nothing. A cell of more than CELL fingerprints (a large group
of near copies) is not joined with itself: each of its members names the 65 points within one bit, and fingerprints that
name one point are linked to the smallest of them. Two fingerprints are within two bits exactly if they share a point,
so no link is lost, and the work is 65 rows for each member however large the cell is.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import blocks, saved, unused

WORDS = 3
SEED = 42
GROUPS = 5
#: From so many fingerprints on, a cell is linked by points instead of pairs; either way gives all links.
CELL = 64
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: bytes, width: int = WORDS) -> np.ndarray:
    words = text.translate(LOWER).split()  # of bytes: at space and \x09-\x0d alone
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    n = max(1, len(words) - width + 1)
    ends = np.cumsum([len(w) for w in words]) + np.arange(len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    stops = ends[min(width, len(words)) - 1:].tolist()
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), stops, strict=True)), np.uint64, n)


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One fingerprint for each run of counts[i] hashes: the bits that over half of the run have. A bit of each byte at
    a time is summed in byte lanes, over at most 255 hashes, then the lanes of a run."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    first = np.concatenate(([0], np.cumsum(counts[some])[:-1]))
    pieces = -(-counts[some] // 255)
    run = np.repeat(np.arange(len(some)), pieces)
    begins = np.concatenate(([0], np.cumsum(pieces)[:-1]))
    at = first[run] + 255 * (np.arange(len(run)) - begins[run])
    lanes = np.uint64(0x0101010101010101)
    fingers = np.zeros((len(some), 8), np.uint8)
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & lanes, at).view(np.uint8).reshape(-1, 8)
        total = np.add.reduceat(sums.astype(np.int64), begins, axis=0)
        fingers |= ((2 * total > counts[some][:, None]) << bit).astype(np.uint8)
    out[some] = fingers.view(np.uint64)[:, 0]
    return out


def fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All columns but the last, which is the text; then its fingerprint."""
    for batch in blocks(batches, "text"):
        hashes = [shingle_hashes((x or "").encode()) for x in batch.column(batch.num_columns - 1).to_pylist()]
        prints = majority(np.concatenate(hashes), np.array([len(h) for h in hashes], np.int64)) if hashes else np.empty(0, np.uint64)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints.view(np.int64))], [*batch.schema.names[:-1], "bits"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """doc_id, bits (long) of every row; 0 where the text has no word or is null. With digest, also a hash of the text."""
    more = [F.xxhash64(F.col(text)).alias("digest")] if digest else []
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), *more, F.col(text).alias("text")) \
        .mapInArrow(fingerprint_rows, "doc_id long, digest long, bits long" if digest else "doc_id long, bits long")


def masks(groups: int) -> list[int]:
    """For each choice of groups - 2 groups of segments, the bits of their segments, as signed longs."""
    parts = [sum(3 << 2 * s for s in range(32) if s * groups // 32 == g) for g in range(groups)]
    kept = [sum(parts[g] for g in choice) for choice in combinations(range(groups), groups - 2)]
    return [m - (1 << 64) if m >> 63 else m for m in kept]


def links(prints: DataFrame, groups: int = GROUPS, cell: int = CELL) -> DataFrame:
    """Pairs (a, b), a < b, that connect whatever fingerprints of a table of distinct ones (bits) are linked: all
    pairs within two bits in cells of up to cell members, and enough of them to connect the same ones in others."""
    low, high = F.lit(0x5555555555555555), F.lit(0xAAAAAAAAAAAAAAAA - (1 << 64))
    bits = F.col("bits")  # of each segment's two bits: either one, then both
    unary = bits.bitwiseOR(F.shiftrightunsigned(bits, 1)).bitwiseAND(low) \
        .bitwiseOR(bits.bitwiseAND(F.shiftleft(bits, 1)).bitwiseAND(high))
    grid = F.array(*[F.struct(F.lit(i).alias("family"), F.col("unary").bitwiseAND(F.lit(m)).alias("place")) for i, m in enumerate(masks(groups))])
    cells = prints.select("bits", unary.alias("unary")).select("bits", "unary", F.explode(grid).alias("at")) \
        .select("at.family", "at.place", "bits", "unary")
    sizes = cells.groupBy("family", "place").agg(F.count("*").alias("n")).where("n > 1")
    met = cells.join(sizes, ["family", "place"])
    small = met.where(F.col("n") <= cell).select("family", "place", "bits", "unary")
    a, b = small.alias("a"), small.alias("b")
    near = (a.join(b, (F.col("a.family") == F.col("b.family")) & (F.col("a.place") == F.col("b.place"))
                   & (F.col("a.bits") < F.col("b.bits"))
                   & (F.bit_count(F.col("a.unary").bitwiseXOR(F.col("b.unary"))) <= 2)
                   & (F.bit_count(F.col("a.bits").bitwiseXOR(F.col("b.bits"))) <= 2))
            .select(F.col("a.bits").alias("a"), F.col("b.bits").alias("b")))
    flips = F.array(F.lit(0), *[F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)])
    points = (met.where(F.col("n") > cell).select("bits").distinct()
              .select("bits", F.explode(flips).alias("flip")).select("bits", F.col("bits").bitwiseXOR(F.col("flip")).alias("point")))
    stars = (points.groupBy("point").agg(F.collect_list("bits").alias("all")).where("size(all) > 1")  # 65 at most
             .select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a < b"))
    return near.union(stars).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """node, root: the smallest node of its component, for every node of the pairs (a < b) but the roots. Large and
    small stars in turn, each round written to the shared folder; rounds grow with the logarithm of the longest path."""
    edges = saved(pairs.select(F.col("b").alias("node"), F.col("a").alias("root")))
    before = None
    while True:
        both = edges.union(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("m")).select("node", F.least("node", "m").alias("m"))
        large = both.where("root > node").join(least, "node").select(F.col("root").alias("node"), F.col("m").alias("root")) \
            .union(both.where("root < node").join(least, "node").select("node", F.col("m").alias("root"))).distinct()
        lowest = large.groupBy("node").agg(F.min("root").alias("m"))
        small = large.join(lowest, "node").where("root != m").select(F.col("root").alias("node"), F.col("m").alias("root"))
        edges = saved(small.union(lowest.select("node", F.col("m").alias("root"))).where("node != root").distinct())
        state = edges.agg(F.count("*"), F.countDistinct("node"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if state == before and state[0] == state[1]:
            return edges
        before = state


def rooted(prints: DataFrame, groups: int, cell: int, **least: Column) -> DataFrame:
    """bits, root and the named minima of every distinct fingerprint; root is the same throughout a component."""
    first = saved(prints.groupBy("bits").agg(*[c.alias(name) for name, c in least.items()]))
    roots = components(links(first.select("bits"), groups, cell))
    return first.join(roots.withColumnRenamed("node", "bits"), "bits", "left").withColumn("root", F.coalesce("root", "bits"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", groups: int = GROUPS, cell: int = CELL) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id (the smallest doc_id reachable over links).

    Words are lower-cased (A-Z) and parted by ASCII white space; a null or blank text has fingerprint zero and is linked
    like any other. Every row is returned, repeated ones too; a null id is in no minimum, and a component of null ids
    alone has a null component_id. Columns other than the two named are not read."""
    prints = saved(fingerprints(docs, doc_id, text))
    nodes = rooted(prints, groups, cell, lowest=F.min("doc_id"))
    lowest = nodes.groupBy("root").agg(F.min("lowest").alias("component_id"))
    named = nodes.join(lowest, "root").select("bits", "component_id")
    return prints.join(named, "bits").select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", groups: int = GROUPS, cell: int = CELL) -> DataFrame:
    """One row of each component, with all its columns: the smallest doc_id's, and of several texts under that id the
    one of the smallest hash. A null id is larger than any other; a row that is there twice stays once. Texts without a
    word, null ones too, are one component."""
    prints = saved(fingerprints(docs, doc_id, text, digest=True))
    nodes = rooted(prints, groups, cell, least=F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "digest")))
    late, key, digest = unused(docs, "late", "key", "digest")
    best = nodes.groupBy("root").agg(F.min("least").alias("least")).select(
        F.col("least.late").alias(late), F.coalesce("least.doc_id", F.lit(0)).alias(key), F.col("least.digest").alias(digest))
    rows = docs.withColumns({late: F.col(doc_id).isNull(), key: F.coalesce(F.col(doc_id).cast("long"), F.lit(0)),
                             digest: F.xxhash64(F.col(text))})
    kept = rows.join(best, [late, key, digest], "left_semi").dropDuplicates([late, key, digest])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
