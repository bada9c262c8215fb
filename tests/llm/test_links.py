"""Fingerprints, pigeonhole links, components, near-duplicates and top-k search against brute force."""

from __future__ import annotations

import random

import llm_cases as cases
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm.components import connected
from tidemark.llm.maxscore import quantised, top_k
from tidemark.llm.simhash import close_links, fingerprint, keep_one_of_each, near_duplicates, parts

LATE = 1 << 62


def brute_fingerprint(text):
    ws = cases.words((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closed(pairs, nodes):
    """node -> smallest node of its component."""
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def close_pairs(prints, distance):
    v = np.array(sorted(prints), np.int64).view(np.uint64)
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1 :] ^ v[i]) <= distance):
            yield int(v[i].astype(np.int64)), int(v[i + 1 + j].astype(np.int64))


def clouds(seed, n_clouds=6, size=150):
    """Fingerprints around centres, a few bits off, and strangers."""
    rng, out = random.Random(seed), set()
    for _ in range(n_clouds):
        centre, loose = rng.getrandbits(64), rng.sample(range(64), 9)
        for _ in range(size):
            out.add(centre ^ sum(1 << b for b in rng.sample(loose, rng.randrange(5))))
    out |= {rng.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1, 1, 1 << 63}
    return sorted(x - (1 << 64) if x >> 63 else x for x in out)


def test_fingerprints():
    texts = [t for _, t, *_ in cases.rows()]
    assert [fingerprint((t or "").encode(), 3) for t in texts] == [brute_fingerprint(t) for t in texts]


@pytest.mark.parametrize("distance, blocks, group", [(2, 4, 2048), (2, 4, 40), (2, 6, 2048), (1, 3, 2048), (3, 5, 60)])
def test_close_links_connect_what_brute_force_connects(spark, distance, blocks, group):
    prints = clouds(distance * 7 + blocks)
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    links = [(r.a, r.b) for r in close_links(df, distance, blocks, group).collect()]
    assert all((a ^ b).bit_count() if a ^ b >= 0 else ((a ^ b) + (1 << 64)).bit_count() <= distance for a, b in links)
    assert closed(links, prints) == closed(close_pairs(prints, distance), prints)


def test_parts_are_disjoint_and_complete():
    mask = 0xF0F0_FFFF_0000_1234
    cut = parts(mask, 3)
    assert sum(cut) == mask and cut[0] & cut[1] == cut[0] & cut[2] == cut[1] & cut[2] == 0


def test_connected(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, 1000 + i) for i in range(1, 40)]
    others = [(-5, -9), (-9, -7), (7000, 7000), (8000, 8001), (8001, 8000)]
    links = chain + star + others
    found = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links for x in (a, b) if a != b}
    assert found == closed([x for x in links if x[0] != x[1]], nodes)
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_near(rows):
    prints = [brute_fingerprint(t) for _, t, *_ in rows]
    prints = [p - (1 << 64) if p >> 63 else p for p in prints]
    root = closed(close_pairs(set(prints), 2), set(prints))
    least = {}
    for (d, *_), p in zip(rows, prints, strict=True):
        at = LATE if d is None else d
        least[root[p]] = min(least.get(root[p], at), at)
    return [(d, p, None if least[root[p]] == LATE else least[root[p]]) for (d, *_), p in zip(rows, prints, strict=True)]


def test_near_duplicates(spark):
    found = near_duplicates(cases.documents(spark)).select("doc_id", "fingerprint", "component_id").collect()
    expected = brute_near(cases.rows())
    assert cases.bag(map(tuple, found)) == cases.bag(expected)
    assert len({e[2] for e in expected}) < len(expected)
    assert near_duplicates(cases.nothing(spark)).collect() == []


def test_keep_one_of_each(spark):
    kept = keep_one_of_each(cases.documents(spark))
    assert kept.columns == cases.documents(spark).columns
    found = [(r.doc_id, r.text) for r in kept.collect()]
    near = brute_near(cases.rows())
    groups = {}
    for (d, t, *_), (_, _, component) in zip(cases.rows(), near, strict=True):
        groups.setdefault(component, set()).add((d, t))
    assert len(found) == len(groups) + 1  # one row of each group; id 4 stands for two groups
    for component, members in groups.items():
        assert len([x for x in found if x in members and x[0] == component]) == (2 if component == 4 else 1)
    assert keep_one_of_each(cases.nothing(spark)).collect() == []


def vectors(seed, n, terms, zeros=0.0, copies=0):
    rng = random.Random(seed)
    out = [[0 if rng.random() < zeros else rng.randrange(-900, 900) for _ in range(terms)] for _ in range(n)]
    return [(i * 3, v) for i, v in enumerate(out + [out[5]] * copies)]


@pytest.mark.parametrize("zeros, k, shard, block", [(0.0, 10, 8192, 1024), (0.8, 10, 70, 9), (0.95, 3, 50, 1024), (0.5, 500, 100, 7)])
def test_top_k(spark, zeros, k, shard, block):
    rows = vectors(int(zeros * 100), 300, 24, zeros, copies=40) + [(9001, [0] * 24), (9003, [5, 5])]
    queries = rows[::10]  # the zero vector among them
    c, q = (spark.createDataFrame(x, "vec_id long, vector array<long>") for x in (rows, queries))
    found = [tuple(r) for r in top_k(c, q, k, shard, block).select("query_id", "rank", "vec_id", "score").collect()]
    expected = []
    for qid, qv in queries:
        scores = sorted((-sum(a * b for a, b in zip(qv, v, strict=False)), i) for i, v in rows if i != qid)
        expected += [(qid, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    assert sorted(found) == sorted(expected)


def test_top_k_of_nothing(spark):
    some = spark.createDataFrame(vectors(1, 12, 4), "vec_id long, vector array<long>")
    assert top_k(some.limit(0), some).collect() == [] and top_k(some, some.limit(0)).collect() == []


def test_quantised(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.0001]), (2, None), (None, [1.0]), (3, [1.0, None]), (4, [nan]), (5, [-inf]), (1, [0.25, 0.0]), (6, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("vector", F.lit("own"))
    found = {r.vec_id: r.vector for r in quantised(df).collect()}
    assert found == {1: [256, 0], 6: []}
