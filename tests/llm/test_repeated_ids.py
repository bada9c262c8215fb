"""Top-k search over tables that repeat ids, against brute force by the rule of its SQL."""

from __future__ import annotations

import random

import pytest

from tidemark.llm.maxscore import quantised, top_k


@pytest.mark.parametrize("shard, block", [(8192, 1024), (20, 3)])
def test_repeated_ids(spark, shard, block):
    rng = random.Random(4)
    rows = [(i % 50, [rng.randrange(-900, 900) / 1024 for _ in range(6)]) for i in range(120)]
    rows += [rows[7]] * 15  # equal rows
    vectors = quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = top_k(vectors, vectors.where("vec_id % 10 = 0"), 10, shard, block)
    found = sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())
    whole = [(i, [int(1024 * x) for x in v]) for i, v in rows]
    expected = []
    for q in range(0, 50, 10):
        scores = sorted((-sum(a * b for a, b in zip(u, v, strict=True)), i) for d, u in whole if d == q for i, v in whole if i != q)
        expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:10])]
    assert found == expected


def test_scores_beyond_64_bits_are_refused(spark):
    """Never a wrapped score: the largest that fit are exact, larger ones are an error."""
    rows = spark.createDataFrame([(0, [1.0e5, 1.0]), (1, [1.0e5, 2.0]), (2, [-1.0e5, 1.0])], "vec_id long, embedding array<double>")
    found = top_k(quantised(rows), quantised(rows).where("vec_id = 0"), k=2).collect()
    assert [r.score for r in sorted(found, key=lambda r: r.rank)] == [1024**2 * (10**10 + 2), 1024**2 * (1 - 10**10)]
    for value in (1.0e17, 1.0e300):
        large = spark.createDataFrame([(0, [value, 1.0]), (1, [value, 1.0])], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="may pass 64 bits"):
            top_k(quantised(large), quantised(large), k=2).collect()
