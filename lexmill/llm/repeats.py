"""Removal of repeated byte strings with suffix arrays of shards.

A byte goes if a string of LENGTH bytes covers it that also starts in a document of a smaller id. Suffixes are dealt to
shards by content, so that equal strings meet: of the GRAM-byte grams of a string, the one with the smallest hash is its
anchor, and all strings of a text with one anchor form a context, the bytes from the first of them to the end of the
last. Two equal strings have equal anchors at the same place, so their contexts are in the same group.

1. Documents are dealt to blocks by id. Each block lists its distinct contexts as hashes with their smallest id.
2. Hashes are dealt by anchor. A context that stands in an earlier document elsewhere goes whole. Where contexts of one
   anchor differ, one document of each is asked for its bytes, if they can have a string in common: of the bytes of a
   string besides the anchor, half stand before it or half behind it, and a hash of each half comes with the context.
   With more text there are more anchors that texts share by chance; their contexts differ in both halves.
3. The bytes are dealt by anchor to shards; a shard sorts the suffixes of its contexts by induction, takes the common
   prefixes of neighbours, and finds runs of LENGTH common bytes: in each, all but the smallest id have a repeated
   string. An anchor with more than HOT such contexts is cut to single strings, dealt by their own hashes, so that no
   shard must hold them all; of strings that are alone there is nothing to sort, and their 128-bit hashes are compared.
4. What was found goes back to the blocks, where bytes are removed.

Documents are dealt out once: the first, third and fourth steps read the same exchange, in one plan. Hashes of contexts have 88 bits.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import rolling_hash, utf8
from lexmill.llm.suffixes import common_prefixes, suffix_array

LENGTH = 50
GRAM = 16
#: Bytes of text in a block, hashes in a bucket, about; and bytes of the input for each shard, which gets less than half
#: as much, since only contexts that differ from others of their anchor come to a shard.
BLOCK = 4 << 20
BUCKET = 1 << 20
PIECE = 1 << 18
SHARD = 4 << 20
HOT = 2_000
LAST = (1 << 63) - 1  # stands for a null id, which comes after all others
ALL = -1
M20, M40, M48 = np.uint64((1 << 20) - 1), np.uint64((1 << 40) - 1), np.uint64((1 << 48) - 1)
#: Which strings of a context are asked for: those with half of the other bytes before the anchor, those with half behind
#: it; and whether they go one by one.
BEFORE, BEHIND, SPREAD = 1, 2, 4
RANDOM = np.random.default_rng(50).integers(1, 1 << 63, 256, np.uint64)
POWER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def key(anchor: np.ndarray, context: np.ndarray) -> np.ndarray:
    """One number for both, to find a context again within a block."""
    with np.errstate(over="ignore"):
        return mixed(anchor * np.uint64(0xD6E8FEB86659FD93) + context)


@functools.cache
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of POWER and of its inverse from 1 on."""
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(size, POWER)), np.cumprod(np.full(size, INVERSE))


def half(length: int) -> int:
    """So many bytes a string has before its anchor or behind it."""
    return (length - GRAM + 1) // 2


class Contexts:
    """The contexts of a block of texts: where each begins and how many strings it has; its text; where its anchor is; its
    hashes, and in one number those of the halves beside the anchor. Texts are looked at in pieces that stay in a
    processor's cache; a longer text is a piece of its own."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, length: int):
        none = np.empty(0, np.int64)
        found = [(none, none, none, none, *[none.astype(np.uint64)] * 3)]
        i = 0
        while i < len(bounds) - 1:
            stop = max(i + 1, int(np.searchsorted(bounds, bounds[i] + PIECE, side="right")) - 1)
            first, count, doc, at, *hashes = contexts_of(data[bounds[i]:bounds[stop]], bounds[i:stop + 1] - bounds[i], length)
            found.append((first + bounds[i], count, doc + i, at + bounds[i], *hashes))
            i = stop
        self.first, self.count, self.doc, self.at, self.anchor, self.hash, self.halves = map(np.concatenate, zip(*found, strict=True))


def contexts_of(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    hashes = rolling_hash(data, GRAM)
    span = length - GRAM + 1
    if len(hashes) < span:
        none = np.empty(0, np.int64)
        return none, none, none, none, *[none.astype(np.uint64)] * 3
    least = hashes & np.uint64(0xFFFFFFFF00000000)
    least |= np.arange(len(hashes), dtype=np.uint64)  # of equal hashes the first
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:len(least) - (span - width)], least[span - width:]) if span > width else least
    # a context ends where the anchor changes, and where a text has no more strings
    ends = np.maximum(bounds[:-1], bounds[1:] - length + 1)
    edge = np.ones(len(least) + 1, bool)
    np.not_equal(least[1:], least[:-1], out=edge[1:-1])
    edge[bounds[bounds < len(edge)]] = edge[ends[ends < len(edge)]] = True
    edges = np.flatnonzero(edge)
    first, stop = edges[:-1], edges[1:]
    doc = np.searchsorted(bounds, first, side="right") - 1
    inside = first < ends[doc]
    first, stop, doc = first[inside], stop[inside], doc[inside]
    after = stop - 1 + length
    up, down = powers(max(2 * PIECE, 1 << (len(data) - 1).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(RANDOM[data] * up[:len(data)])))
        raw = (sums[after] - sums[first]) * down[first] + (after - first).astype(np.uint64)
        at = (least[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        side = half(length)
        halves = []  # 0: no string of the context has such a half
        for begin, some in ((at - side, at - first >= side), (at + GRAM, at - stop + 1 < side)):
            begin = np.where(some, begin, 0)
            code = mixed((sums[begin + side] - sums[begin]) * down[begin]) % M20 + np.uint64(1)
            halves.append(np.where(some, code, np.uint64(0)))
    return first, stop - first, doc, at, mixed(hashes[at]) & M40, mixed(raw) & M48, halves[0] << np.uint64(20) | halves[1]


def squeezed(array: np.ndarray, width: int) -> bytes:
    """The low width bytes of each number, byte by byte, packed."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(-1, 8)[:, :width].T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueezed(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view(np.uint64)[:, 0]


def parts_of(labels: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each label with the places that have it."""
    order = np.argsort(labels, kind="stable")
    edges = np.flatnonzero(np.concatenate(([True], labels[order][1:] != labels[order][:-1], [True]))) if len(labels) else []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(labels[order[a]]), order[a:b]


def block_contexts(table: pa.Table, length: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, Contexts]:
    table = table.combine_chunks()
    data, bounds = utf8(table.column("text").combine_chunks() if table.num_rows else pa.array([], pa.string()))
    ranks = table.column("rank").to_numpy()
    return data, bounds, ranks, Contexts(data, bounds, length)


def list_contexts(buckets: int, length: int):
    """Step 1."""
    schema = pa.schema({"bucket": pa.int64(), "block": pa.int64(), "anchors": pa.binary(), "hashes": pa.binary(),
                        "halves": pa.binary(), "ranks": pa.binary()})

    def run(block: tuple, table: pa.Table) -> pa.Table:
        _, _, ranks, found = block_contexts(table, length)
        rank = ranks[found.doc]
        keys = key(found.anchor, found.hash)
        order = np.lexsort((rank, keys))
        keys = keys[order]
        first = order[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(order) else order
        first = first[np.argsort(rank[first], kind="stable")]
        rows = []
        for bucket, own in parts_of((found.anchor[first] % np.uint64(buckets)).astype(np.int64)):
            at = first[own]
            rows.append({"bucket": bucket, "block": block[0].as_py(), "anchors": squeezed(found.anchor[at], 5),
                         "hashes": squeezed(found.hash[at], 6), "halves": squeezed(found.halves[at], 5),
                         "ranks": squeezed(rank[at].astype(np.int64), 8)})
        return pa.Table.from_pylist(rows, schema)
    return run


def in_common(group: np.ndarray, code: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which contexts have the hash of a half (not 0) in common with another one of their anchor and of another id."""
    out = np.zeros(len(code), bool)
    some = np.flatnonzero(code)
    if len(some):
        both = group[some].astype(np.uint64) << np.uint64(20) | code[some]
        order = np.argsort(both, kind="stable")
        some, both = some[order], both[order]
        new = np.concatenate(([True], both[1:] != both[:-1]))
        starts = np.flatnonzero(new)
        out[some] = (np.minimum.reduceat(rank[some], starts) < np.maximum.reduceat(rank[some], starts))[np.cumsum(new) - 1]
    return out


def resolve(hot: int):
    """Step 2. For each block: the keys of contexts that go whole, and those whose bytes are asked for (and which of them:
    BEFORE, BEHIND, SPREAD)."""
    schema = pa.schema({"block": pa.int64(), "whole": pa.binary(), "asked": pa.binary(), "how": pa.binary()})

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        widths = (("anchors", 5), ("hashes", 6), ("halves", 5), ("ranks", 8))
        columns = [[unsqueezed(x, w) for x in table.column(c).to_pylist()] for c, w in widths]
        block = np.repeat(table.column("block").to_numpy(), [len(x) for x in columns[0]])
        anchor, context, halves, rank = map(np.concatenate, columns)
        rank = rank.astype(np.int64)
        order = np.lexsort((rank, context, anchor))
        anchor, context, halves, rank, block = anchor[order], context[order], halves[order], rank[order], block[order]
        new_anchor = np.concatenate(([True], anchor[1:] != anchor[:-1]))
        new = new_anchor | np.concatenate(([True], context[1:] != context[:-1]))
        group, own = np.cumsum(new_anchor) - 1, np.cumsum(new) - 1
        whole = rank > rank[new][own]
        some = np.flatnonzero(new & (np.bincount(group[new]) > 1)[group])
        how = np.zeros(len(rank), np.uint8)
        for bit, code in ((BEFORE, halves[some] >> np.uint64(20)), (BEHIND, halves[some] & M20)):
            how[some[in_common(group[some], code, rank[some])]] |= bit
        asked = how > 0
        how[asked & (np.bincount(group[asked], minlength=group[-1] + 1) > hot)[group]] |= SPREAD
        keys = key(anchor, context)
        rows = []
        for b, at in parts_of(block):
            ask = at[asked[at]]
            gone = at[whole[at]]
            if len(ask) or len(gone):
                rows.append({"block": b, "whole": squeezed(np.sort(keys[gone]), 8), "asked": squeezed(keys[ask], 8), "how": how[ask].tobytes()})
        return pa.Table.from_pylist(rows, schema)
    return run


def gathered(table: pa.Table, column: str, width: int = 8) -> np.ndarray:
    return np.concatenate([np.empty(0, np.uint64), *(unsqueezed(x, width) for x in table.column(column).to_pylist())])


FETCHED = "shard long, block long, contexts binary, ranks binary, places binary, sizes binary, bytes binary, digests binary"


def fetch(shards: int, length: int):
    """Step 3, in the blocks: the bytes of contexts that are asked for, by the document of the smallest id; of single strings
    the hashes."""
    names = ("contexts", "ranks", "places", "sizes", "bytes", "digests")
    schema = pa.schema({"shard": pa.int64(), "block": pa.int64()} | dict.fromkeys(names, pa.binary()))

    def run(block: tuple, docs: pa.Table, asked: pa.Table) -> pa.Table:
        wanted = gathered(asked, "asked")
        if not len(wanted) or not docs.num_rows:
            return schema.empty_table()
        how = np.frombuffer(b"".join(asked.column("how").to_pylist()), np.uint8)
        data, _, ranks, found = block_contexts(docs, length)
        order = np.argsort(wanted)
        wanted, how = wanted[order], how[order]
        keys = key(found.anchor, found.hash)
        at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
        mine = np.flatnonzero(wanted[at] == keys)
        mine = mine[np.lexsort((ranks[found.doc[mine]], keys[mine]))]
        mine = mine[np.concatenate(([True], keys[mine][1:] != keys[mine][:-1]))] if len(mine) else mine
        how, rank, anchor, keys = how[at[mine]], ranks[found.doc[mine]].astype(np.int64), found.anchor[mine], keys[mine]
        first = found.first[mine]
        edge = found.at[mine] - half(length)  # from behind it on, strings have their half behind the anchor
        start = np.where(how & BEFORE, first, np.maximum(first, edge + 1))
        stop = np.where(how & BEHIND, first + found.count[mine], np.minimum(first + found.count[mine], edge + 1))
        whole, pack = data.tobytes(), zstandard.ZstdCompressor(level=1)
        spread = how & SPREAD > 0
        rows = []

        def send(shard: np.ndarray, of: np.ndarray, starts: np.ndarray, sizes: np.ndarray, column: str, values) -> None:
            for s, own in parts_of(shard):
                rows.append({"shard": s, "block": block[0].as_py(), "contexts": squeezed(keys[of[own]], 8), "ranks": squeezed(rank[of[own]], 8),
                             "places": squeezed(starts[own] - first[of[own]], 8), "sizes": squeezed(sizes[own], 8), column: values(own)})

        of = np.flatnonzero(~spread)
        starts, sizes = start[of], (stop - start)[of] - 1 + length
        send((anchor[of] % np.uint64(shards)).astype(np.int64), of, starts, sizes, "bytes", lambda own: pack.compress(
            b"".join([whole[a:a + n] for a, n in zip(starts[own].tolist(), sizes[own].tolist(), strict=True)])))
        of = np.flatnonzero(spread)
        n = (stop - start)[of]
        singles = np.arange(n.sum()) + np.repeat(start[of] - np.cumsum(n) + n, n)
        digests = np.frombuffer(b"".join([xxhash.xxh3_128_digest(whole[a:a + length]) for a in singles.tolist()]), np.uint64).reshape(-1, 2)
        send((digests[:, 0] % np.uint64(shards)).astype(np.int64), np.repeat(of, n), singles, np.full(len(singles), length), "digests",
             lambda own: digests[own].tobytes())
        return pa.Table.from_pylist(rows, schema)
    return run


def among_sorted(lengths: np.ndarray, data: np.ndarray, ranks: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The strings that also stand in a context of a smaller id: their contexts and their places in them. data: the bytes of
    contexts of these lengths."""
    sizes = lengths + 1  # with a sign that parts the strings and that none of them has
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    text = np.ones(bounds[-1] + 1, np.uint16)
    inside = np.ones(len(text), bool)
    inside[bounds[1:] - 1] = inside[-1] = False
    text[inside] = data.astype(np.uint16) + np.uint16(2)
    text[-1] = 0
    # of the places in order those where LENGTH bytes of one string begin; equal ones are neighbours
    pieces = sizes - length
    full = np.zeros(len(text), bool)
    full[np.arange(pieces.sum()) + np.repeat(bounds[:-1] - np.cumsum(pieces) + pieces, pieces)] = True
    order = suffix_array(text, length)
    order = order[full[order]]
    shared = common_prefixes(text, order, length)
    run_of = np.cumsum(shared[order] < length) - 1
    owner = np.repeat(np.arange(len(sizes)), sizes)[order]
    mine = ranks[owner]
    least = np.minimum.reduceat(mine, np.flatnonzero(shared[order] < length))
    some = np.flatnonzero(mine > least[run_of])
    return owner[some], order[some] - bounds[owner[some]]


def sort_shard(length: int):
    """Step 3, in the shards: which strings of a context also stand in a context of a smaller id; a bit for each."""
    schema = pa.schema({"block": pa.int64(), "context": pa.int64(), "bits": pa.int64()})

    def run(table: pa.Table) -> pa.Table:
        found = []
        for column in ("bytes", "digests"):
            part = table.filter(pc.is_valid(table.column(column))).combine_chunks()
            if not part.num_rows:
                continue
            contexts, ranks, places, lengths = (gathered(part, c).astype(np.int64) for c in ("contexts", "ranks", "places", "sizes"))
            blocks = np.repeat(part.column("block").to_numpy(), [len(unsqueezed(x, 8)) for x in part.column("places").to_pylist()])
            values = part.column(column).to_pylist()
            if column == "bytes":
                unpack = zstandard.ZstdDecompressor()
                data = np.frombuffer(b"".join(map(unpack.decompress, values)), np.uint8)
                owner, place = among_sorted(lengths, data, ranks, length)
            else:
                low, high = np.frombuffer(b"".join(values), np.uint64).reshape(-1, 2).T
                order = np.lexsort((ranks, high, low))
                new = np.concatenate(([True], (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])))
                least = ranks[order][new][np.cumsum(new) - 1]
                owner = order[ranks[order] > least]
                place = np.zeros(len(owner), np.int64)
            bits = np.zeros(len(lengths), np.uint64)
            np.bitwise_or.at(bits, owner, np.uint64(1) << (place + places[owner]).astype(np.uint64))
            some = np.flatnonzero(bits)
            found.append(pa.Table.from_arrays([pa.array(blocks[some]), pa.array(contexts[some]), pa.array(bits[some].view(np.int64))], schema=schema))
        return pa.concat_tables(found) if found else schema.empty_table()
    return run


REMOVED = "rank long, text string, n_bytes long, gone array<struct<start:long,stop:long>>"


def remove(length: int):
    """Step 4: where each text of a block has repeated bytes."""
    spans = pa.list_(pa.struct({"start": pa.int64(), "stop": pa.int64()}))
    schema = pa.schema({"rank": pa.int64(), "text": pa.string(), "n_bytes": pa.int64(), "gone": spans})

    def run(block: tuple, docs: pa.Table, found: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        data, bounds, ranks, own = block_contexts(docs, length)
        rows = found.to_pylist()
        whole = np.sort(np.concatenate([np.empty(0, np.uint64), *(unsqueezed(r["whole"], 8) for r in rows if r["whole"] is not None)]))
        contexts = np.array([r["context"] for r in rows if r["context"] is not None], np.int64).view(np.uint64)
        bits = np.array([r["bits"] for r in rows if r["context"] is not None], np.int64).view(np.uint64)
        keys = key(own.anchor, own.hash)
        rank = ranks[own.doc]
        order = np.lexsort((rank, keys))
        new = np.concatenate(([True], keys[order][1:] != keys[order][:-1])) if len(order) else np.empty(0, bool)
        least = np.empty(len(keys), np.int64)
        least[order] = rank[order][new][np.cumsum(new) - 1] if len(order) else 0
        later = rank > least  # than another document of this block
        if len(whole):
            later |= whole[np.minimum(np.searchsorted(whole, keys), len(whole) - 1)] == keys
        change = np.zeros(len(data) + 1, np.int64)
        np.add.at(change, own.first[later], 1)
        np.add.at(change, own.first[later] + own.count[later] - 1 + length, -1)
        if len(contexts):
            merged = np.argsort(contexts, kind="stable")
            contexts, bits = contexts[merged], bits[merged]
            start = np.flatnonzero(np.concatenate(([True], contexts[1:] != contexts[:-1])))
            contexts, bits = contexts[start], np.bitwise_or.reduceat(bits, start)
            at = np.minimum(np.searchsorted(contexts, keys), len(contexts) - 1)
            some = np.flatnonzero((contexts[at] == keys) & ~later)
            for k in range(length):
                hit = own.first[some[(bits[at[some]] >> np.uint64(k)) & np.uint64(1) == 1]] + k
                np.add.at(change, hit, 1)
                np.add.at(change, hit + length, -1)
        gone = np.cumsum(change[:-1]) > 0
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        begins = np.flatnonzero(gone & (edge[:-1] | ~np.concatenate(([False], gone[:-1])))) if len(data) else np.empty(0, np.int64)
        stops = np.flatnonzero(gone & (edge[1:] | ~np.concatenate((gone[1:], [False])))) + 1 if len(data) else begins
        doc = np.searchsorted(bounds, begins, side="right") - 1
        lists = [[] for _ in range(docs.num_rows)]
        for d, a, b in zip(doc.tolist(), begins.tolist(), stops.tolist(), strict=True):
            lists[d].append({"start": a - int(bounds[d]), "stop": b - int(bounds[d])})
        return pa.Table.from_arrays([pa.array(ranks), docs.column("text").combine_chunks(), pa.array(np.diff(bounds)), pa.array(lists, spans)], schema=schema)
    return run


def repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, block: int = BLOCK, hot: int = HOT) -> DataFrame:
    """doc_id, text, n_bytes, gone (spans of repeated bytes, merged: start, stop) for every row.

    A null text has no bytes. A null id comes after all others. Rows of one id do not count for each other, only for
    later ones. Strings of fewer than length bytes are never repeated. length: 17 to 79. Columns other than the two named
    are not read."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("rank"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block))
    buckets = max(1, math.ceil(total / 17 / BUCKET))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("rank"), F.lit(blocks)))
    by_block = dealt.groupBy("block")
    listed = by_block.applyInArrow(list_contexts(buckets, length), "bucket long, block long, anchors binary, hashes binary, halves binary, ranks binary")
    resolved = listed.groupBy("bucket").applyInArrow(resolve(hot), "block long, whole binary, asked binary, how binary")
    shards = max(1, math.ceil(total / SHARD))
    fetched = by_block.cogroup(resolved.select("block", "asked", "how").groupBy("block")).applyInArrow(fetch(shards, length), FETCHED)
    strings = fetched.groupBy("shard").applyInArrow(sort_shard(length), "block long, context long, bits long")
    found = (resolved.select("block", "whole", F.lit(None).cast("long").alias("context"), F.lit(None).cast("long").alias("bits"))
             .union(strings.select("block", F.lit(None).cast("binary"), "context", "bits")))
    out = by_block.cogroup(found.groupBy("block")).applyInArrow(remove(length), REMOVED)
    return out.select(F.when(F.col("rank") != LAST, F.col("rank")).alias("doc_id"), "text", "n_bytes", "gone")


def kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, removed, runs = [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
            data, done, sha, n = (text or "").encode(), 0, hashlib.sha256(), 0
            for s in spans:
                sha.update(data[done:s["start"]])
                done, n = s["stop"], n + s["stop"] - s["start"]
            sha.update(data[done:])
            digests.append(sha.hexdigest())
            removed.append(n)
            runs.append(len(spans))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                                          pa.array(digests)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 from what repeated() gave."""
    return found.mapInArrow(kept_rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
