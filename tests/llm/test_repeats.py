"""Against every string of every document."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from lexmill.llm import common, repeats, suffixes

LENGTH = 50


def brute(pairs):
    first = {}
    data = [(repeats.LAST if i is None else i, (t or "").encode()) for i, t in pairs]
    for rank, d in data:
        for k in range(len(d) - LENGTH + 1):
            s = d[k:k + LENGTH]
            first[s] = min(first.get(s, rank), rank)
    out = []
    for (doc_id, _), (rank, d) in zip(pairs, data, strict=True):
        gone = np.zeros(len(d) + 1, bool)
        for k in range(len(d) - LENGTH + 1):
            if first[d[k:k + LENGTH]] < rank:
                gone[k:k + LENGTH] = True
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        out.append((doc_id, len(d), int(gone.sum()), int((gone[:-1] & ~gone[1:]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def texts(rng):
    passages = ["".join(rng.choices("abcdé \n", k=rng.randrange(20, 400))) for _ in range(15)]
    out = ["".join(rng.choice([rng.choice(passages), "".join(rng.choices("xyzw", k=rng.randrange(60)))]) for _ in range(rng.randrange(6))) for _ in range(60)]
    out += [p[rng.randrange(10):len(p) - rng.randrange(10)] for p in passages for _ in range(3)]
    return [*out, "a" * 500, "a" * 49, "a" * 50, "b" + "a" * 120, "ab" * 300, "ba" * 200, None, "", out[0], out[1], "é" * 100, "日本語" * 60]


@pytest.mark.parametrize(("block", "hot"), [(1 << 22, 2000), (1500, 2000), (1500, 0), (1 << 22, 1)])
def test_removed(rows, rng, block, hot):
    found = texts(rng)
    ids = rng.sample(range(1000), len(found))
    pairs = [*zip(ids, found, strict=True), (None, found[2]), (None, "q" * 80), (ids[3], found[5]), (ids[3], found[3])]
    got = repeats.report(repeats.repeated(rows(pairs), block=block, hot=hot))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(pairs)


def test_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    got = repeats.report(repeats.repeated(docs, block=100_000))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(pairs)


def test_empty_and_other_columns(spark):
    assert repeats.repeated(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    docs = spark.createDataFrame([(1, "x" * 60, "r", 1), (2, "x" * 60, "r", 2)], "id bigint, body string, rank string, block int")
    got = repeats.report(repeats.repeated(docs, "id", "body")).collect()
    assert sorted(tuple(r)[:4] for r in got) == [(1, 60, 0, 0), (2, 60, 60, 1)]


def test_contexts_that_share_only_their_anchor_are_not_asked_for(rng):
    """An anchor that stands in many texts by chance costs no bytes; half a string beside it does."""
    def letters(n):
        return "".join(rng.choices("abcdefghijklmnop", k=n))
    anchor = min((letters(repeats.GRAM) for _ in range(20_000)), key=lambda g: int(common.rolling_hash(np.frombuffer(g.encode(), np.uint8), repeats.GRAM)[0]))

    def asked(before, behind, n=40, hot=2000):
        found = [letters(60) + before + anchor + behind + letters(60) for _ in range(n)]
        block = pa.table({"rank": list(range(n)), "text": found})
        listed = repeats.list_contexts(1, LENGTH)((pa.scalar(0),), block)
        resolved = repeats.resolve(hot)(listed)
        fetched = repeats.fetch(1, LENGTH)((pa.scalar(0),), block, resolved)
        return len(repeats.gathered(resolved, "asked")), fetched
    assert asked("", "")[0] == asked("abc", "d" * 13)[0] == 0
    for before, behind in (("abcdefghijklmnopq", ""), ("", "abcdefghijklmnopq"), ("abcdefghi", "q" * 17)):
        assert asked(before, behind)[0] >= 40
        _, fetched = asked(before, behind, hot=10)  # single strings go as hashes, and only those with that half
        digests = [x for x in fetched.column("digests").to_pylist() if x is not None]
        assert 16 * 40 <= sum(map(len, digests)) <= 16 * 40 * 18


@pytest.mark.parametrize("wide", [0, 600])
def test_suffix_arrays(rng, wide, monkeypatch):
    monkeypatch.setattr(suffixes, "WIDE", wide)
    for _ in range(150):
        text = rng.choices(range(1, rng.choice([2, 3, 11])), k=rng.randrange(60)) + [0]
        order = suffixes.suffix_array(np.array(text))
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        shared = suffixes.common_prefixes(np.array(text), order, 5)
        for a, b in zip(order[:-1].tolist(), order[1:].tolist(), strict=True):
            n = next((k for k in range(5) if text[a + k:a + k + 1] != text[b + k:b + k + 1] or not text[b + k:b + k + 1]), 5)
            assert shared[b] == n


@pytest.mark.parametrize("wide", [0, 600])
def test_suffixes_are_sorted_no_further_than_asked(rng, wide, monkeypatch):
    monkeypatch.setattr(suffixes, "WIDE", wide)
    for _ in range(150):
        text = rng.choices(range(1, rng.choice([2, 3, 11])), k=rng.randrange(60)) * 2 + [0]
        most = rng.randrange(1, 12)
        order = suffixes.suffix_array(np.array(text), most).tolist()
        assert sorted(order) == list(range(len(text)))
        heads = [text[i:i + most] for i in order]
        assert heads == sorted(heads)


def test_work_does_not_grow_with_what_strings_have_in_common(rng, monkeypatch):
    """Copies that agree in thousands of bytes need no more rounds of comparison than such that agree in 64."""
    monkeypatch.setattr(suffixes, "WIDE", 7)
    rounds = []

    def counted(numbers, *args, inner=suffixes.by_doubling, sort=np.argsort):
        sorts = []
        with monkeypatch.context() as m:
            m.setattr(suffixes.np, "argsort", lambda *a, **b: sorts.append(1) or sort(*a, **b))
            out = inner(numbers, *args)
        rounds.append(len(sorts))
        return out
    monkeypatch.setattr(suffixes, "by_doubling", counted)
    passage = rng.choices(range(1, 5), k=4000)
    suffixes.suffix_array(np.array([*passage, 5, *passage, 6, *passage, 0]), 50)
    assert rounds and max(rounds) <= 6


def test_only_places_in_the_order_have_common_prefixes():
    text = np.array([*b"abcabcabc", 0])
    assert suffixes.common_prefixes(text, np.array([6, 3, 0]), 5).tolist() == [5, 0, 0, 3, 0, 0, 0, 0, 0, 0]
