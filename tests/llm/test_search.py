"""Against the score of every document for every item."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lexmill.llm import search

ITEMS = "item_id bigint, text string"


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, k):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, counts, n in held:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * counts[t] // (1000 * counts[t] + 12 * m))
                        for t in terms(text) if t in counts)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def answer(rows, spark, docs, items, k, **more):
    found = search.search(rows(docs), spark.createDataFrame(items, ITEMS), k, **more)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=repr)


def corpus(rng, n=250):
    words = ["w" + "".join(rng.choices("abcdéÜß中", k=rng.randrange(1, 4))) for _ in range(200)] + ["the"] * 60
    docs = []
    for i in range(n):
        text = rng.choice([" ", ", ", "\n", "-"]).join(rng.choices(words, k=rng.choice([1, 5, 40, 300])))
        docs.append((i, text if rng.random() < 0.8 else docs[rng.randrange(len(docs))][1] if docs else text))
    items = [(j, " ".join(rng.choices(words, k=rng.choice([1, 6, 30])))) for j in range(30)]
    return docs, [*items, (30, docs[0][1])]


@pytest.mark.parametrize("k", [1, 20, 300])
def test_all_scores(rows, spark, rng, k):
    docs, items = corpus(rng)
    assert answer(rows, spark, docs, items, k) == brute(docs, items, k)


def test_parts_of_the_items_and_shuffled_keys(rows, spark, rng, monkeypatch):
    monkeypatch.setattr(search, "FEW_KEYS", 0)
    docs, items = corpus(rng, 80)
    assert answer(rows, spark, docs, items, 5, part_bytes=2000) == brute(docs, items, 5)


def test_odd_rows(rows, spark, rng):
    docs = [(1, "a b c"), (1, "a b c"), (1, "a b d"), (None, "a b c"), (None, "A-B!C"), (2, None), (3, ""), (4, " .,;"), (5, "z " * 3000 + "a"), (-6, "a b c")]
    items = [(1, "A b"), (1, "a b"), (2, None), (3, ""), (4, "nothing known"), (5, "c c c z"), (None, "d"), (6, "x" * 1000)]
    for k in (1, 3, 50):
        assert answer(rows, spark, docs, items, k) == brute(docs, items, k)
    assert answer(rows, spark, docs, [], 3) == answer(rows, spark, [(1, None)], items, 3) == []
    wide = rows(docs).selectExpr("*", "1 AS key", "2 AS item", "3 AS score", "4 AS rank", "5 AS n")
    assert search.search(wide, spark.createDataFrame(items, ITEMS), 3).count() == len(brute(docs, items, 3))


def test_bounds_are_never_below_scores(rng):
    docs, items = corpus(rng)
    docs += [(900, "wa " * 700), (901, "wa " * 255 + "wb")]
    split = [Counter(terms(t)) for _, t in items]
    known = {t.encode(): i for i, t in enumerate(dict.fromkeys(t for c in split for t in c))}
    weights = np.zeros((len(known), len(split)), np.int64)
    for i, counts in enumerate(split):
        for t, n in counts.items():
            weights[known[t.encode()], i] = n * rng.randrange(20000)
    stats = search.Corpus(len(docs), sum(len(terms(t)) for _, t in docs))
    part = search.Part(known, search.hashed(known), weights)
    [batch] = search.sketch_rows(iter([pa.RecordBatch.from_pydict({"key": [i for i, _ in docs], "text": [t for _, t in docs]})]))
    exact = {}
    for i, t in docs:
        counts = Counter(terms(t))
        mass = stats.mass(sum(counts.values()))
        exact[i] = sum((search.impact(counts[w.decode()], mass) * weights[p] for w, p in known.items() if w.decode() in counts), np.zeros(len(split), np.int64))
    seen, loose = 0, 0
    for keys, bound in search.bounds(iter([batch]), stats, part):
        for key, row in zip(keys.tolist(), bound, strict=True):
            assert (row >= exact[key]).all()
            seen, loose = seen + 1, loose + float((row > 1.5 * exact[key] + 1).mean())
    assert seen == len(docs) and loose < 0.5 * seen


def test_sketch_holds_maxima():
    counts = {f"t{i}".encode(): 1 + i % 7 for i in range(1000)} | {b"often": 300}
    folded = np.frombuffer(search.sketch(counts), np.uint8)
    places = (search.hashed(counts) & np.uint64(len(folded) - 1)).astype(int)
    want = np.zeros(len(folded), int)
    for place, count in zip(places, counts.values(), strict=True):
        want[place] = max(want[place], min(count, 255))
    assert len(folded) == 16384 and folded.tolist() == want.tolist()
