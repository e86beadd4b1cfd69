"""The packing against plain best fit; the laws of the placement."""

import zlib

import pytest

from lexmill.llm import sharding


def plain(sizes, capacity):
    rooms, bins = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [(room, b) for b, room in enumerate(rooms) if room >= sizes[i]]
        if not fits:
            rooms.append(max(capacity, sizes[i]))
            fits = [(rooms[-1], len(rooms) - 1)]
        bins[i] = min(fits)[1]
        rooms[bins[i]] -= sizes[i]
    return bins


def test_best_fit(rng):
    for _ in range(200):
        sizes = [rng.randrange(1, 60) for _ in range(rng.randrange(80))]
        assert sharding.best_fit_decreasing(sizes, 50) == plain(sizes, 50)
    assert sharding.best_fit_decreasing([1] * 3000, 10)[-1] == 299


def test_least_capacity():
    assert max(sharding.least_capacity([5, 5, 4, 3, 3], 2)) <= 1
    assert sharding.least_capacity([], 8) == []
    assert len(set(sharding.least_capacity([7] * 8, 8))) == 8


@pytest.mark.parametrize("bucket", [30, 50_000])
def test_placement(rows, rng, bucket, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket)
    texts = ["é" * rng.randrange(300) for _ in range(400)] + ["same text"] * 150 + [None, "", ""]
    pairs = [*enumerate(texts), (None, "no id"), (None, "no id"), (3, texts[3]), (3, texts[3])]
    got = sharding.sharded(rows(pairs)).collect()
    assert len(got) == len(pairs)
    want = sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs if i is not None)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got if r.doc_id is not None) == want
    sizes, slots, homes = {}, {}, {}
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 8
        sizes[r.shard] = sizes.get(r.shard, 0) + r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
        homes.setdefault((r["size"], r.text_crc32), set()).add(r.shard)
    assert all(len(x) == 1 for x in homes.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 0.02 * sum(sizes.values()) / 8
    again = sharding.sharded(rows(pairs, 5)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_few_rows_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "a", 9, "z")], "id bigint, body string, size int, shard string")
    [row] = sharding.sharded(docs, "id", "body").collect()
    assert (row.doc_id, row["size"], row.slot) == (1, 2, 0)
    assert sharding.sharded(docs.limit(0), "id", "body").count() == 0
