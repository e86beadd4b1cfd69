"""Against all distances tried one by one."""

import hashlib
import zlib

import pytest

from lexmill.llm import queries, runs


def brute(words, exponent, shortest):
    best = {}
    for p in range(1, len(words) // exponent + 1):
        i = 0
        while i < len(words) - p:
            j = i
            while j < len(words) - p and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(shortest, exponent * p):
                best.setdefault((i, j + p), p)
            i = j + (j == i)
    return sorted(((s, e - s, p) for (s, e), p in best.items()), key=lambda r: (r[0], r[2]))


def text(rng):
    words = rng.choices("abcdefghijklmnopqrstuvwxyzäöü"[:rng.choice([1, 2, 3, 6, 29])], k=rng.randrange(90))
    for _ in range(rng.randrange(4) if words else 0):
        a, p = rng.randrange(len(words)), rng.randrange(1, 1 + max(1, len(words) // 3))
        for i in range(a + p, rng.randrange(a, len(words)) + 1):
            words[i] = words[i - p]
    return rng.choice([" ", "\n", " \t\x0b"]).join(words)


@pytest.mark.parametrize(("exponent", "shortest"), [(4, 6), (2, 2), (3, 9)])
def test_runs(rows, rng, exponent, shortest):
    pairs = list(enumerate(text(rng) for _ in range(300)))
    got = {r.doc_id: r for r in runs.periodic_runs(rows(pairs), exponent, shortest).collect()}
    for i, t in pairs:
        words = t.split()
        want = brute(words, exponent, shortest)
        assert [tuple(r) for r in got[i].runs] == want
        gone = {k for s, n, p in want for k in range(s + p, s + n)}
        assert got[i].collapsed == " ".join(w for k, w in enumerate(words) if k not in gone)


def test_words_of_other_scripts_stay_whole(rows):
    [r] = runs.periodic_runs(rows([(1, "x\xa0y " * 6 + "　 z")])).collect()
    assert ([tuple(x) for x in r.runs], r.collapsed) == ([(0, 6, 1)], "x\xa0y 　 z")


def test_long_texts(rows):
    fib = ["a", "ab"]
    while len(fib[-1]) < 20000:
        fib.append(fib[-1] + fib[-2])
    texts = ["w " * 50000, "a b c " * 20000 + "end", " ".join(fib[-1]), " ".join(map(str, range(60000))), "x" * 1_000_000]
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in runs.periodic_runs(rows(enumerate(texts))).collect()}
    assert got == {0: [(0, 50000, 1)], 1: [(0, 60000, 3)], 2: [], 3: [], 4: []}


def test_odd_rows(spark, rows):
    pairs = [(None, "a a a a a a"), (1, None), (2, ""), (3, " \n"), (4, "a a a a a"), (4, "a a a a a"), (5, "a a a a a a")]
    got = sorted(((r.doc_id, len(r.runs), r.collapsed) for r in runs.periodic_runs(rows(pairs)).collect()), key=repr)
    assert got == sorted([(None, 1, "a"), (1, 0, ""), (2, 0, ""), (3, 0, ""), (4, 0, "a a a a a"), (4, 0, "a a a a a"), (5, 1, "a")], key=repr)
    assert runs.periodic_runs(rows([(1, "a")]).limit(0)).count() == 0
    wide = rows([(1, "b " * 8)]).selectExpr("doc_id", "text", "1 AS runs", "2 AS collapsed", "doc_id AS start")
    assert [r.collapsed for r in runs.periodic_runs(wide).collect()] == ["b"]
    with pytest.raises(ValueError, match="two periods"):
        runs.periodic_runs(wide, exponent=1)


def test_query(spark, rows, rng, tmp_path):
    pairs = [*enumerate((text(rng) for _ in range(200)), -20), (None, "a a a a a a a"), (900, None), (12345678901, "x y " * 9)]
    rows(pairs).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op11_runs(spark, str(tmp_path)).collect()}
    for i, t in pairs:
        words = (t or "").split()
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0 and words and i is not None:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        want = brute(words, 4, 6)
        gone = {k for s, n, p in want for k in range(s + p, s + n)}
        best = max(want, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        assert tuple(got[i]) == (
            i, len(want), *best, 1000 * best[1] // best[2] if want else None,
            hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in want).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest())
