"""Against a search of every window at every word."""

import hashlib
import re

import pytest

from lexmill.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add("" if name is None else str(name))
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def cases(rng):
    pool = ["the", "of", "and", "été", "日本", "a1"]
    items = [(i, " ".join(rng.choices(pool, k=rng.randrange(14)))) for i in range(30)]
    items += [(90, "One, two; THREE four five six seven eight nine ten eleven twelve"), (91, None), (92, " .. "), (None, "null item here"), (93, "solo" * 5), (93, "other text of one id")]
    docs = [(i, " ".join(rng.choices([*pool, "x", "Y."], k=rng.randrange(200)))) for i in range(60)]
    docs += [(100, "x one two three FOUR five-six seven eight nine ten eleven y"), (101, None), (102, ""), (103, " .,"), (None, "the null item here."),
             (104, "of " * 20_000), (105, "The the"), (105, "The the"), (106, "solosolosolosolosolo other text of one id")]
    return docs, items


@pytest.mark.parametrize("part", [dc.PART_BYTES, 200])
def test_hits(spark, rows, rng, part):
    docs, items = cases(rng)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = dc.report(dc.leaks(rows(docs), benchmark, part_bytes=part))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(docs, items), key=repr)


def test_cut_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "keep é one Two, three. Rest", "l", 5), (2, None, None, None)], "doc_id bigint, text string, leak string, n_words int")
    items = spark.createDataFrame([("i", "one two three", 1)], "item_id string, text string, name int")
    found = dc.leaks(docs, items)
    assert found.columns == docs.columns
    cut = dc.cut(found)
    assert cut.columns == ["doc_id", "text", "n_words"]
    assert sorted(map(tuple, cut.collect())) == [(1, "keep é . Rest", 5), (2, None, None)]


def test_empty_tables(spark, rows):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert [tuple(r)[:4] for r in dc.report(dc.leaks(rows([(1, "a b")]), none)).collect()] == [(1, 2, 0, 0)]
    assert dc.leaks(spark.createDataFrame([], "doc_id bigint, text string"), none).count() == 0


def test_index_finds_every_place(rng):
    import numpy as np
    text = np.array(rng.choices(range(1, 6), k=3000))
    index = dc.FMIndex(text, 5)
    phrases = np.array([[0] * (6 - k) + rng.choices(range(1, 6), k=k) for k in (1, 2, 3, 6) for _ in range(10)])
    low, high = index.search(phrases)
    for p, a, b in zip(phrases, low, high, strict=True):
        p = [x for x in p.tolist() if x]
        want = [i for i in range(3000) if text[i:i + len(p)].tolist() == p]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want
