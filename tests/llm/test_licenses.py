"""Base places against word lists; signatures, priority and containment on written texts."""

import re
from itertools import product

from pyspark.sql import functions as F

from lexmill.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def base(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for i in range(len(words)) for p, label in PHRASES.items() if tuple(words[i:i + len(p)]) == p]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_base(spark, rows, rng):
    pool = ["mit", "MIT", "license", "License,", "apache", "general", "public", "é", "日本", "x1", "gnu\n"]
    texts = [" ".join(rng.choices(pool, k=rng.randrange(60))) for _ in range(150)]
    texts += [None, "", "mit\x00license", "mitélicense", "MIT License " * 5000, "𝒳 mit license", "lİcense mit lıcense"]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    pairs = [*enumerate(texts), (None, "apache license"), (0, texts[0])]
    got = licenses.scan(rows(pairs)).collect()
    assert sorted([(r.doc_id, *tuple(r)[1:6]) for r in got], key=repr) == sorted([(i, *base(t)) for i, t in pairs], key=repr)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))


def test_signatures(rows):
    texts = {
        "SPDX-License-Identifier: Apache-2.0": ("apache-2.0", 1.0),
        "Licensed under the Apache License, Version 2.0.": ("apache,apache-2.0", 0.75),
        "This work is licensed under the GNU General Public License, version 3.": ("gpl,gpl-3.0", 0.75),
        "under GNU Lesser General Public License, version 2.1 or later": ("gpl,lgpl-2.1", 0.5),
        "Licensed under CC BY-NC 4.0.": ("cc-by-nc", 0.75),
        "license: \"BSD-3-Clause\"": ("bsd-3-clause", 0.75),
        "see https://www.mozilla.org/en-US/MPL/2.0/": ("mpl-2.0", 0.75),
        "Released under the MIT License.": ("mit", 0.75),
        "nothing of the kind is licensed here": ("", 0.0)}
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(rows(enumerate(texts))).collect()}
    assert got == dict(enumerate(texts.values()))
    assert len(licenses.signatures()) > 200


def examples(parsed):
    """Texts that a parsed expression matches: every alternative, and every optional part left out and put in."""
    texts = [""]
    for op, value in parsed:
        kind = str(op)
        if kind == "LITERAL":
            more = [chr(value)]
        elif kind == "ANY":
            more = ["x"]
        elif kind == "IN":
            first, what = value[0]
            more = [{"CATEGORY_SPACE": " ", "CATEGORY_DIGIT": "1"}[str(what)] if str(first) == "CATEGORY" else chr(what[0] if str(first) == "RANGE" else what)]
        elif kind == "SUBPATTERN":
            more = examples(value[3])
        elif kind == "BRANCH":
            more = [x for part in value[1] for x in examples(part)]
        elif kind == "MAX_REPEAT":
            least, most, part = value
            more = [y for n in {least, max(least, min(1, most))} for y in ([""] if n == 0 else examples(part))]
        else:
            assert kind in ("AT", "ASSERT_NOT"), kind
            more = [""]
        texts = [a + b for a, b in product(texts, more)]
        texts = texts[:1] + texts[1:-1:len(texts) // 40 + 1] + texts[-1:] if len(texts) > 40 else texts
    return texts


def test_every_signature_alone(rows):
    rules = [(label, re.compile(pattern, re.ASCII), priority) for label, _, pattern, priority in licenses.signatures()]
    assert len(rules) == 260
    texts = []
    for _, pattern, _ in rules:
        own = [x for x in examples(re._parser.parse(pattern.pattern)) if pattern.fullmatch(x)]
        assert own, pattern.pattern
        texts += own
    want = {i: sorted((m.start(), -m.end(), -p, label) for label, pattern, p in rules for m in pattern.finditer(x)) for i, x in enumerate(texts)}
    found = rows(enumerate(texts)).select("doc_id", F.array_sort(licenses.all_detections("text")).alias("found"))
    assert {r.doc_id: [tuple(f) for f in r.found] for r in found.collect()} == want


def test_identifiers_and_addresses_without_the_name(rows):
    texts = {
        "SPDX-License-Identifier: GPL-2.0-only": ("gpl-2.0", 1.0), "SPDX-License-Identifier: LGPL-2.1": ("lgpl-2.1", 1.0),
        "license: MS-PL": ("ms-pl", 0.75), "http://creativecommons.org/licenses/by/4.0": ("cc-by", 0.75),
        "http://creativecommons.org/publicdomain/zero/1.0": ("cc0-1.0", 0.75), "SIL Open Font License": ("ofl-1.1", 0.5),
        "released under the Apache 2.0": ("apache-2.0", 0.75), "distributed under GPL": ("gpl", 0.75)}
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(rows(enumerate(texts))).collect()}
    assert got == dict(enumerate(texts.values()))


def test_plan_and_edges(spark):
    docs = spark.createDataFrame([(1, "MIT License", "low")], "id bigint, body string, low string")
    frame = licenses.scan(docs, "id", "body")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert frame.first().labels == "mit"
    assert licenses.scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_many_matches_are_linear(rows):
    """Each in its own place, across blocks of matches, in time that grows with them."""
    import time
    took = {}
    for n in (600, 40_000):
        start = time.perf_counter()
        [r] = licenses.scan(rows([(1, "mit license " * n + "apache license, version 2.0")], 1)).collect()
        took[n] = time.perf_counter() - start
        assert (r.n_base, r.first_word, r.last_word) == (n + 1, 0, 2 * n) and {"mit", "apache"} <= set(r.base_labels.split(","))
    assert took[40_000] < 30 + 2 * took[600]
    found = rows([(1, "x mit license " * 700)], 1).select(licenses.all_detections("text").alias("found")).first().found
    assert [d.start for d in sorted(found) if d.label == found[0].label and d.priority == found[0].priority][:3] == [2, 16, 30]
    assert max(d.start for d in found) == 2 + 14 * 699
