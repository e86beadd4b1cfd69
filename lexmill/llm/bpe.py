"""Byte-level BPE over content-defined chunks.

A rolling hash cuts every text where the content says so, so that a passage which stands in many documents gives the
same chunks in all of them. A chunk that occurs more than once is encoded once, by the document that owns it (the
smallest row key), and its ids travel to the others; a chunk that occurs once is encoded where it stands. Chunk joins
are then repaired: the text around a join is encoded again, out to the nearest places where any encoding must have a
border, and the window grows until its edges fall on token borders of both chunks.

Such a place lies between a printable ASCII character and a space or line feed: the pattern that splits text before
the merges can hold white space only at the front of a piece, so it always ends a piece there, whatever stands around.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import blocks, packed, rolling_hash, utf8

WIDTH = 16
#: The mean length of a chunk, in bytes, as a power of 2.
CHUNK_BITS = 9
ADDED = "<|endoftext|>"
OUT = "doc_id long, n_tokens long, ids binary, decoded string"


@functools.cache
def vocabulary(path: str):
    """The encoder, the bytes of every id, and their number, for a byte-level tokenizer file without normalizer."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError("only byte-level tokenizers without normalizer and prefix space")
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    added = {x["content"]: x["id"] for x in spec["added_tokens"]}
    ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
    order = [ranks[bytes(letters[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))] for m in spec["model"]["merges"]]
    if order != sorted(order):
        raise ValueError("ids must follow the order of the merges")
    encoder = tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    pieces = [b""] * (1 + max([*ranks.values(), *added.values()]))
    for token, i in [*ranks.items(), *((t.encode(), i) for t, i in added.items())]:
        pieces[i] = token
    return encoder, pieces, np.array([len(x) for x in pieces], np.int64)


def encode(path: str, text: str) -> np.ndarray:
    return vocabulary(path)[0].encode_to_numpy(text, allowed_special="all")


def cuts(data: np.ndarray, bounds: np.ndarray, bits: int) -> np.ndarray:
    """Where chunks begin, in a block of texts: at every text, and after every window whose hash ends in zeros."""
    hashes = rolling_hash(data, WIDTH)
    at = np.flatnonzero((hashes & np.uint64((1 << bits) - 1)) == 0) + WIDTH
    at = at[at < len(data)]
    at = at[(data[at] & 0xC0) != 0x80]  # not inside a character
    owner = np.searchsorted(bounds, at, side="right") - 1
    at = at[at - bounds[owner] >= WIDTH]  # the window lies in one text
    return np.union1d(at, bounds[:-1][np.diff(bounds) > 0])


def row_key(doc_id: int | None, text: bytes) -> bytes:
    """Rows with equal ids and texts have equal results, and one key."""
    return xxhash.xxh3_128_digest(text + b"\0" + str(doc_id).encode())


def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in blocks(batches, "text"):
        texts = [(x or "").encode() for x in batch.column(1).to_pylist()]
        ids = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([
            pa.array([row_key(i, t) for i, t in zip(ids, texts, strict=True)], pa.binary()), batch.column(0).cast(pa.int64()),
            pa.array([pack.compress(t) for t in texts], pa.binary())], ["key", "doc_id", "packed"])


def chunk_rows(bits: int):
    """A row for each chunk of a text, its first place only: 128-bit hash, the key of the row it stands in, and where."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            data, bounds = utf8(batch.column(1))
            starts = cuts(data, bounds, bits)
            ends = np.append(starts[1:], len(data))
            row = np.searchsorted(bounds, starts, side="right") - 1
            whole = data.tobytes()
            keys = [row_key(i, whole[a:b]) for i, a, b in zip(batch.column(0).to_pylist(), bounds[:-1], bounds[1:], strict=True)]
            hashes = [xxhash.xxh3_128_digest(whole[a:b]) for a, b in zip(starts, ends, strict=True)]
            first = dict(reversed([((h, r), i) for i, (h, r) in enumerate(zip(hashes, row.tolist(), strict=True))]))
            at = np.array(sorted(first.values()), np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array([hashes[i] for i in at], pa.binary()), pa.array([keys[r] for r in row[at]], pa.binary()),
                pa.array(starts[at] - bounds[row[at]]), pa.array(ends[at] - bounds[row[at]])], ["chunk", "key", "start", "stop"])
    return run


def encode_owned(path: str):
    """Encodes the chunks that a document owns: packed text and a list of (chunk, start, stop) to (chunk, ids)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for text, owned in zip(batch.column("packed"), batch.column("owned"), strict=True):
                whole = unpack.decompress(text.as_py())
                for x in owned.as_py():
                    yield x["chunk"], pack.compress(encode(path, whole[x["start"]:x["stop"]].decode()).astype(np.uint32).tobytes())

    schema = pa.schema({"chunk": pa.binary(), "ids": pa.binary()})
    return lambda batches: packed(rows(batches), schema)


def borders(text: np.ndarray) -> np.ndarray:
    """Where any encoding of the text has a border: both ends, and before a space or line feed after printable ASCII."""
    blank = (text[1:] == 32) | (text[1:] == 10)
    return np.concatenate(([0], np.flatnonzero(blank & (text[:-1] > 32) & (text[:-1] < 127)) + 1, [len(text)]))


def joined(path: str, text: bytes, starts: np.ndarray, known: dict[bytes, np.ndarray]) -> np.ndarray:
    """The ids of a whole text from those of its chunks (known by hash, else encoded here and then known), joins repaired."""
    _, _, lengths = vocabulary(path)
    if not text:
        return np.empty(0, np.uint32)
    data = np.frombuffer(text, np.uint8)
    stops = np.append(starts[1:], len(text))
    safe = borders(data)
    inner = starts[1:]
    left = safe[np.searchsorted(safe, inner, side="right") - 1]
    right = safe[np.searchsorted(safe, inner, side="left")]
    windows: list[list[int]] = []  # [from, to), apart from each other
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        if a == b:
            continue
        if windows and a <= windows[-1][1]:
            windows[-1][1] = max(b, windows[-1][1])
        else:
            windows.append([a, b])
    chunk_ids: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def ids_of(k: int) -> tuple[np.ndarray, np.ndarray]:
        """A chunk's ids and where, in the text, each of them ends."""
        if k not in chunk_ids:
            a, b = int(starts[k]), int(stops[k])
            chunk = xxhash.xxh3_128_digest(text[a:b])
            ids = known.get(chunk)
            if ids is None:
                ids = known[chunk] = encode(path, text[a:b].decode())
            chunk_ids[k] = ids, np.concatenate(([a], a + np.cumsum(lengths[ids])))
        return chunk_ids[k]

    def agrees(position: int, k: int) -> bool:
        edges = ids_of(k)[1]
        i = int(np.searchsorted(edges, position))
        return i < len(edges) and edges[i] == position

    out, done, w = [], 0, 0
    for k in range(len(starts)):
        a, b = int(starts[k]), int(stops[k])
        while True:
            a = max(a, done)
            if a >= b:
                break
            if w < len(windows) and windows[w][0] < b:
                start, stop = windows[w]
                w += 1
                if start > a:
                    while start > a and not agrees(start, k):  # grow to the left until the edge is a token border
                        start = int(safe[np.searchsorted(safe, start) - 1])
                    start = max(start, a)
                    if start > a:
                        ids, edges = ids_of(k)
                        out.append(ids[np.searchsorted(edges, a):np.searchsorted(edges, start)])
                while stop < len(text):  # grow to the right until the edge is a token border of the chunk there
                    there = int(np.searchsorted(starts, stop, side="right")) - 1
                    if stop == starts[there] or agrees(stop, there):
                        break
                    stop = int(safe[np.searchsorted(safe, stop, side="right")])
                while w < len(windows) and windows[w][0] <= stop:
                    stop = max(stop, windows[w][1])
                    w += 1
                out.append(encode(path, text[start:stop].decode()))
                done = stop
                continue
            ids, edges = ids_of(k)
            out.append(ids[np.searchsorted(edges, a):])
            done = b
    return np.concatenate(out)


def encode_all(path: str, bits: int):
    """The last pass: every text from its chunks, those that others share given."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        unpack = zstandard.ZstdDecompressor()
        pieces = vocabulary(path)[1]
        for batch in batches:
            for doc, text, shared in zip(*map(batch.column, ("doc_id", "packed", "shared")), strict=True):
                whole = unpack.decompress(text.as_py())
                data = np.frombuffer(whole, np.uint8)
                known = {x["chunk"]: np.frombuffer(unpack.decompress(x["ids"]), np.uint32) for x in shared.as_py() or ()}
                ids = joined(path, whole, cuts(data, np.array([0, len(data)]), bits), known)
                decoded = b"".join(map(pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")
                yield doc.as_py(), len(ids), ids.astype("<u4").tobytes(), decoded

    schema = pa.schema({"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary(), "decoded": pa.string()})
    return lambda batches: packed(rows(batches), schema)


def encoded(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", bits: int = CHUNK_BITS) -> DataFrame:
    """Encodes and decodes every whole text: doc_id, n_tokens, ids (little-endian unsigned 32-bit), decoded.

    path: a byte-level BPE file, the same on every machine. A null text counts as empty: no ids, an empty text. Rows
    stay apart, repeated ones too; a null id stays null. Columns other than the two named are not read."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    chunks = rows.mapInArrow(chunk_rows(bits), "chunk binary, key binary, start long, stop long")
    # Both joins below ask for the same columns and the same filter, so that the texts are dealt out once.
    texts = rows.mapInArrow(keyed, "key binary, doc_id long, packed binary").where("key IS NOT NULL")
    shared = (chunks.groupBy("chunk").agg(F.count("*").alias("n"), F.min(F.struct("key", "start", "stop")).alias("owner"))
              .where("n > 1").select("chunk", "owner.*"))
    owners = shared.groupBy("key").agg(F.collect_list(F.struct("chunk", "start", "stop")).alias("owned"))
    ids = (texts.join(owners, "key").select("doc_id", "packed", "owned")
           .mapInArrow(encode_owned(path), "chunk binary, ids binary").dropDuplicates(["chunk"]))
    found = (chunks.select("chunk", "key").join(ids, "chunk")
             .groupBy("key").agg(F.collect_set(F.struct("chunk", "ids")).alias("shared")))
    return texts.join(found, "key", "left").select("doc_id", "packed", "shared").mapInArrow(encode_all(path, bits), OUT)


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_tokens, ids, decoded) to (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    for batch in batches:
        sha = lambda x: hashlib.sha256(x).hexdigest()
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array([sha(x) for x in batch.column(2).to_pylist()]),
            pa.array([sha(x.encode()) for x in batch.column(3).to_pylist()])], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
