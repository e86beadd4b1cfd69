"""Against all scores sorted."""

import math

import pytest

from lexmill.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>"


def usable(row, scale):
    i, v = row
    return i is not None and v is not None and all(x is not None and math.isfinite(x) and math.isfinite(x * scale) for x in v)


def brute(rows, queries, k, scale):
    def whole(v):
        return [math.floor(x * scale) for x in v]
    out = []
    for i, v in queries:
        if usable((i, v), scale):
            scores = [(-sum(a * b for a, b in zip(whole(v), whole(w), strict=True)), j) for j, w in rows if usable((j, w), scale) and j != i and len(w) == len(v)]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def answer(spark, rows, queries, k, scale=64.0, schema=SCHEMA, **more):
    frames = [spark.createDataFrame(x, schema).repartition(4) for x in (rows, queries)]
    return sorted(map(tuple, topk.top_k(*frames, k, scale, **more).collect()))


def vectors(rng, n, width, levels):
    return [(i, [rng.choice(levels) if levels else rng.gauss(0, 1) for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize(("width", "levels", "k"), [(5, None, 20), (3, [0.0, 1.0, -1.0], 7), (1, [0.5], 3), (40, None, 400)])
def test_all_scores(spark, rng, width, levels, k):
    rows = vectors(rng, 300, width, levels)
    queries = [r for r in rows if r[0] % 20 == 0]
    assert answer(spark, rows, queries, k) == brute(rows, queries, k, 64)


def test_blocks_of_queries(spark, rng):
    rows = vectors(rng, 200, 4, None)
    queries = [r for r in rows if r[0] % 3 == 0]
    assert answer(spark, rows, queries, 5, query_bytes=400) == brute(rows, queries, 5, 64)


def test_odd_rows(spark, rng):
    rows = [*vectors(rng, 60, 3, [0.0, 2.5, -7.25]), (None, [1.0, 1.0, 1.0]), (100, None), (101, [1.0, None, 1.0]), (102, [math.nan, 0.0, 0.0]),
            (103, [math.inf, 0.0, 0.0]), (104, []), (120, []), (105, [1.0]), (20, [1.0, 2.0]), (-40, [3.0, 3.0, 3.0]), (-1, [1.0, 1.0, 1.0]), (-1, [1.0, 1.0, 1.0])]
    queries = [r for r in rows if r[0] is not None and r[0] % 20 == 0]
    assert answer(spark, rows, queries, 6) == brute(rows, queries, 6, 64)
    assert answer(spark, rows, [], 6) == answer(spark, [], queries, 6) == []


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(20, [1.0]), (20, [1.0]), (20, [-1.0]), (1, [1.0]), (1, [1.0]), (2, [0.5])]
    assert answer(spark, rows, rows[:3], 2, 2.0) == sorted(2 * [(20, 1, 1, 4), (20, 2, 1, 4)] + [(20, 1, 2, -2), (20, 2, 1, -4)])


@pytest.mark.parametrize("size", [1e4, 1e7, 1e9, 1e18])
def test_large_components(spark, rng, size):
    rows = [(i, [rng.uniform(-size, size) for _ in range(3)]) for i in range(60)]
    queries = [r for r in rows if r[0] % 20 == 0]
    top = (1 << 63) - 1
    cut = [(q, r, j, max(-top, min(top, s))) for q, r, j, s in brute(rows, queries, 60, 1.0)]
    got = answer(spark, rows, queries, 60, 1.0, "vec_id bigint, embedding array<double>")
    if size < 1e18:
        assert got == cut
    else:  # ties at the ends of a long go by id
        assert {(q, j, s) for q, _, j, s in got} == {(q, j, s) for q, _, j, s in cut}
        assert got == sorted((q, r, j, s) for q in {g[0] for g in got} for r, (_, _, j, s) in enumerate(sorted((g for g in cut if g[0] == q), key=lambda g: (-g[3], g[2])), 1))


def test_clashing_columns(spark, rng):
    rows = spark.createDataFrame(vectors(rng, 30, 2, None), SCHEMA).selectExpr("*", "1 AS query_id", "2 AS score", "3 AS rank", "4 AS n", "5 AS query")
    got = topk.top_k(rows, rows.where("vec_id % 20 = 0"), 3)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.count() == 6
