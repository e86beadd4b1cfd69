"""Against fingerprints taken bit by bit and components over all pairs."""

import re

import xxhash

from lexmill.llm import simhash


def brute(pairs):
    def bits(text):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
        if not words:
            return 0
        hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    prints = [bits(t) for _, t in pairs]
    root = list(range(len(pairs)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(pairs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(pairs):
        ids = [pairs[j][0] for j in range(len(pairs)) if find(j) == find(i) and pairs[j][0] is not None]
        out.append((doc_id, f"{prints[i]:016x}", min(ids, default=None)))
    return out


def texts(rng):
    words = ["".join(rng.choices("abcdéüß", k=3)) for _ in range(60)]
    out = []
    for _ in range(25):
        base = rng.choices(words, k=rng.randrange(1, 400))
        out.append(" ".join(base))
        for _ in range(rng.randrange(6)):
            base[rng.randrange(len(base))] = rng.choice(words)
            out.append(rng.choice([" ", "\n", "\t "]).join(base).replace("a", "A"))
    return [*out, *out[:5], None, "", " \x0b ", "a", "a b", "A B", "x\xa0y", "w " * 3000]


def test_components(rows, rng):
    pairs = [*enumerate(texts(rng), 5), (None, "a"), (None, "lonely text of a null id"), (7, "a")]
    want = sorted(brute(pairs), key=repr)
    for cell in (64, 2):  # by pairs, and all by points
        got = simhash.near_duplicates(rows(pairs), cell=cell)
        assert sorted(map(tuple, got.collect()), key=repr) == want


def test_links_lose_nothing(spark, rng):
    base = [rng.getrandbits(64) for _ in range(20)]
    prints = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (1 << 64) - 1 for b in base for _ in range(12)} | {0, 1, 1 << 63, (1 << 64) - 1}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    frame = spark.createDataFrame([(x,) for x in signed], "bits bigint")
    assert {tuple(r) for r in simhash.links(frame).collect()} == want
    assert {tuple(r) for r in simhash.links(frame, cell=1).collect()} <= want


def test_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)], "a bigint, b bigint")
    assert {r.root for r in simhash.components(chain).collect()} == {0}
    assert simhash.components(chain).count() == 300


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(docs).count() == 0
