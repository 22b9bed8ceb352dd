"""Top-k search against all scores."""

from __future__ import annotations

import math
import random

import pytest
from tallyworks.llm.topk_search import search

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, k=5, every=50):
    vectors = {}
    for vec_id, vector, *_ in rows:
        if vec_id is None or vector is None or any(
                x is None or math.isnan(x) or math.isinf(x) for x in vector):
            continue
        whole = [math.floor(256 * x) for x in vector]
        vectors[vec_id] = min(vectors.get(vec_id, whole), whole)
    found = []
    for q, v in vectors.items():
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in vectors.items()
                            if c != q)[:k]
            found += [(q, rank, c, -s) for rank, (s, c) in enumerate(scores, 1)]
    return sorted(found)


def compare(spark, rows, **how):
    table = spark.createDataFrame(rows, SCHEMA)
    found = search(table, **how).collect()
    assert sorted(map(tuple, found)) == brute_force(rows, how.get("k", 5), how.get("every", 50))


def test_small_blocks_and_ties(spark):
    draw = random.Random(1)
    rows = [(i, [float(draw.randint(-3, 3)) / 8 for _ in range(6)], 0) for i in range(400)]
    rows += [(1000 + i, [0.25] * 6, 0) for i in range(60)]  # equal vectors
    compare(spark, rows, every=10, block_rows=37, block_queries=11)
    compare(spark, rows, every=25, block_rows=3, block_queries=100, k=7, lists=3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (50, None, 1), (100, [1.0, None], 1), (150, [nan, 1.0], None),
            (200, [inf, 0.0], 1), (None, [1.0, 1.0], 1), (250, [], 1), (300, [1.0, 2.0, 4.0], 1),
            (7, [-1.0, -2.0], 1), (7, [-1.0, -2.0], 1), (50, [0.001, -0.001], 1),
            (8, [2.0 ** 44, 1.0], 1)]
    compare(spark, rows)
    wide = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS block", "2 AS score", "3 AS query_id", "4 AS vector")
    assert sorted(map(tuple, search(wide).collect())) == brute_force(rows)


def test_few_rows(spark):
    compare(spark, [])
    compare(spark, [(0, [1.0], 0)])
    compare(spark, [(0, [1.0], 0), (50, [2.0], 0)])
    compare(spark, [(1, [1.0], 0), (2, [2.0], 0)])


def test_huge_components(spark):
    """Whole numbers of any size are multiplied exactly; scores must fit a long."""
    compare(spark, [(0, [2.0 ** -8, 1.0], 0), (1, [2.0 ** 40, -3.0], 0), (2, [2.0 ** 47, 0.5], 0),
                    (3, [2.0 ** 47, 0.25], 0), (4, [-(2.0 ** 47), 9.0], 0), (5, [1.0, 1.0], 0)])
    draw = random.Random(4)
    rows = [(i, [float(draw.randint(1, 2 ** 20)), draw.randint(0, 99) / 8] * 3, 0)
            for i in range(90)] + [(90, [0.0, 2.0 ** 101] * 3, 0)]
    compare(spark, [(i, v if i % 10 else [v[0], 0.0] * 3, 0) for i, v, _ in rows],
            every=30, block_rows=13, lists=4)  # products pass a long, scores are exact beside them
    for other in (3.0e30, -3.0e30):
        table = spark.createDataFrame([(0, [1.0, 1.0], 0), (8, [other, 1.0], 0)], SCHEMA)
        with pytest.raises(Exception, match="below all longs|int too (big|large)|overflow"):
            search(table).collect()
    far = [(0, [1.0, 1.0], 0), (8, [-3.0e30, 1.0], 0), *((i, [1.0, float(i)], 0) for i in range(1, 7))]
    compare(spark, far)  # out of range, but not among the best
