"""Sharding by best-fit-decreasing bin packing, in two levels.

Equal texts form a group that stays together. Groups are dealt by a hash to buckets; in each bucket they are packed, by
size from the largest, into cartons of a fixed capacity: a group enters the carton with the tightest remaining room,
found in a balanced tree, or opens a new one. Then the cartons, whose number is bounded by the total size over the
capacity and by the number of buckets, are packed the same way into the shards: the least shard capacity is sought for
which best fit needs no more shards than there are. A group larger than a carton is a carton of its own, and there are
at most as many of those as capacities in the total.

What is sent between machines is a row key, a size and a hash of every document, not its text.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.llm.common import saved

SHARDS = 8
#: Cartons for each shard, about: the finer, the nearer in size are the shards.
CARTONS = 500
#: Rows of a bucket, about.
BUCKET_ROWS = 20_000


class Rooms:
    """Open cartons in a balanced (AVL) tree, by remaining room and number; takes out the tightest that fits."""

    def __init__(self):
        self.root = None

    def add(self, key: tuple[int, int]) -> None:
        self.root = self._add(self.root, key)

    def take(self, size: int) -> tuple[int, int] | None:
        """The least key whose room is at least size, taken out; None if there is none."""
        node, best = self.root, None
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[1]
            else:
                node = node[2]
        if best is not None:
            self.root = self._remove(self.root, best)
        return best

    # a node: [key, left, right, height]
    @staticmethod
    def _height(node) -> int:
        return node[3] if node else 0

    def _fixed(self, node):
        lean = self._height(node[1]) - self._height(node[2])
        if lean > 1:
            if self._height(node[1][1]) < self._height(node[1][2]):
                node[1] = self._turned(node[1], 2)
            return self._turned(node, 1)
        if lean < -1:
            if self._height(node[2][2]) < self._height(node[2][1]):
                node[2] = self._turned(node[2], 1)
            return self._turned(node, 2)
        node[3] = 1 + max(self._height(node[1]), self._height(node[2]))
        return node

    def _turned(self, node, side: int):
        """The child of that side comes above its parent."""
        up, other = node[side], 3 - side
        node[side], up[other] = up[other], node
        node[3] = 1 + max(self._height(node[1]), self._height(node[2]))
        up[3] = 1 + max(self._height(up[1]), self._height(up[2]))
        return up

    def _add(self, node, key):
        if node is None:
            return [key, None, None, 1]
        side = 1 if key < node[0] else 2
        node[side] = self._add(node[side], key)
        return self._fixed(node)

    def _remove(self, node, key):
        if key == node[0]:
            if not node[1] or not node[2]:
                return node[1] or node[2]
            least = node[2]
            while least[1]:
                least = least[1]
            node[0], key = least[0], least[0]
            node[2] = self._remove(node[2], key)
        else:
            side = 1 if key < node[0] else 2
            node[side] = self._remove(node[side], key)
        return self._fixed(node)


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of every item; items come by size from the largest, equal ones in their order. A larger item than the
    capacity gets a bin of its own."""
    bins, rooms, count = [0] * len(sizes), Rooms(), 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = rooms.take(sizes[i])
        if found is None:
            found = (max(capacity, sizes[i]), count)
            count += 1
        bins[i] = found[1]
        rooms.add((found[0] - sizes[i], found[1]))
    return bins


def least_capacity(sizes: list[int], bins: int) -> list[int]:
    """The packing of the least capacity, by halving, for which best fit needs no more than so many bins."""
    low, high = max([1, *sizes, -(-sum(sizes) // bins)]), max(1, sum(sizes))
    best = best_fit_decreasing(sizes, high)
    while low <= high:
        middle = (low + high) // 2
        tried = best_fit_decreasing(sizes, middle)
        if max(tried, default=0) < bins:
            best, high = tried, middle - 1
        else:
            low = middle + 1
    return best


def pack_bucket(capacity: int):
    def run(_: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("text_hash", "ascending")])
        bins = best_fit_decreasing(table.column("size").to_pylist(), capacity)
        return pa.table({"text_hash": table.column("text_hash"), "bucket": table.column("bucket"), "carton": pa.array(bins, pa.int32()),
                         "size": table.column("size")})
    return run


def sharded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, cartons: int = CARTONS) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32, law (`bytes`: shards are near equal in size), shard, slot (from 0,
    gapless in a shard), grown_shard (null) for every row.

    A null text counts as empty, and is in a group with the empty ones. Repeated rows each get a slot of their own.
    Which slot a row has depends on its id and text alone, so a lost task gives the same slots again."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = saved(docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
                             F.crc32(body).alias("text_crc32"), F.unhex(F.sha2(body, 256)).alias("text_hash")))
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    capacity = max(1, math.ceil(total / (shards * cartons)))
    buckets = max(1, math.ceil(count / BUCKET_ROWS))
    groups = rows.groupBy("text_hash").agg(F.sum("size").alias("size")).withColumn("bucket", F.pmod(F.xxhash64("text_hash"), F.lit(buckets)))
    packed = saved(groups.groupBy("bucket").applyInArrow(pack_bucket(capacity), "text_hash binary, bucket long, carton int, size long"))
    sums = packed.groupBy("bucket", "carton").agg(F.sum("size").alias("size")).orderBy("bucket", "carton").collect()
    placed = least_capacity([r["size"] for r in sums], shards)
    where = docs.sparkSession.createDataFrame([(r.bucket, r.carton, s) for r, s in zip(sums, placed, strict=True)], "bucket long, carton int, shard int")
    homes = packed.join(where, ["bucket", "carton"]).select("text_hash", "shard")
    homed = saved(rows.join(homes, "text_hash").select(
        "doc_id", "size", "text_crc32", "shard", "text_hash", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets)).alias("part")))
    # slots: a row's place in its part of a shard, after the rows of the parts before it
    parts = homed.groupBy("shard", "part").count().orderBy("shard", "part").collect()  # shards times buckets
    before, bases = dict.fromkeys(range(shards), 0), []
    for r in parts:
        bases.append((r.shard, r.part, before[r.shard]))
        before[r.shard] += r["count"]
    based = docs.sparkSession.createDataFrame(bases, "shard int, part long, base long")
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_hash"))
    return homed.withColumn("place", place).join(based, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("place") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
