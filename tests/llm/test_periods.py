"""Periodic runs against brute force over every period of every text."""

from __future__ import annotations

import hashlib
import random
import zlib

import llm_cases as cases
import numpy as np
import pytest

from tidemark.llm.periods import cuts, intervals, periodic_runs
from tidemark.llm.queries import QUERIES
from tidemark.llm.texts import mixed


def brute_runs(words):
    """(start, period, length) of every run."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        start = None
        for i in range(len(words) - q + 1):
            if i < len(words) - q and words[i] == words[i + q]:
                start = i if start is None else start
            elif start is not None:
                length = i - start + q
                if length >= max(6, 4 * q):
                    found.setdefault((start, length), q)  # the smallest period comes first
                start = None
    return sorted((s, q, n) for (s, n), q in found.items())


def brute_collapsed(words, runs):
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts(seed=3, n=150):
    """Nested, touching, overlapping and nearly periodic stretches, up to a whole text of one word."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        words = []
        while len(words) < rng.choice([5, 40, 200]):
            kind, some = rng.randrange(5), rng.choice([2, 3, 30])
            if kind == 0:
                words += [f"x{rng.randrange(some)}" for _ in range(rng.randrange(1, 12))]
            elif kind == 1:
                words += ["a"] * rng.randrange(1, 20)
            else:
                base = [f"x{rng.randrange(some)}" for _ in range(rng.randrange(1, 14))]
                if kind == 2:
                    base = base * rng.randrange(4, 6) + ["z"]
                words += (base * rng.randrange(2, 9))[: rng.randrange(3, 120)]
        out.append(" ".join(words))
    return [*out, "one " * 500, ("a b " * 40 + "a a b ") * 6, "a a a a a", "a a a a a a", "A a A a A a A a", "", None, " \n "]


def documents(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("how", [{}, {"tile": 32, "long_text": 10}, {"tile": 16, "long_text": 300}])
def test_runs(spark, how):
    texts = periodic_texts()
    found = {r.doc_id: r for r in periodic_runs(documents(spark, texts), **how).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        words = cases.words(text)
        runs = brute_runs(words)
        assert [(r.start, r.period, r.length) for r in found[i].runs] == runs, text
        assert found[i].collapsed_text == brute_collapsed(words, runs)


def test_long_period_over_many_tiles(spark):
    rng = random.Random(1)
    base = [f"w{rng.randrange(50)}" for _ in range(700)]
    text = " ".join([*base[:100], *(base * 6)[:3900], "end", *base])
    (found,) = periodic_runs(documents(spark, [text]), tile=64, long_text=100).collect()
    runs = brute_runs(text.split())
    assert [(r.start, r.period, r.length) for r in found.runs] == runs and max(q for _, q, _ in runs) == 700


def test_octaves_and_tiles():
    assert list(cuts(5, 8)) == [] and list(cuts(6, 8)) == [(0, 6, 0, 1)]
    for n in (100, 1000, 4097):
        tiles = list(cuts(n, 16))
        assert {k for _, _, low, high in tiles for k in range(low, high)} == set(range((n // 4).bit_length()))
        for k in range((n // 4).bit_length()):
            own = sorted((s, e) for s, e, low, high in tiles if low <= k < high)
            assert own[0][0] == 0 and max(e for _, e in own) == n
            assert all(e - s2 >= min(6 << k, n - s2) for (_, e), (s2, _) in zip(own, own[1:], strict=False))


def test_one_word_is_one_interval():
    """Multiples of a known period are not followed further, so a text of one word costs its octaves, not its periods."""
    codes = np.zeros(100_000, np.uint64)
    assert intervals(codes, 0, 15) == [(1, 0, 99_999)]
    assert intervals(mixed(np.arange(5000, dtype=np.uint64)), 0, 10) == []


def test_odd_documents(spark):
    rows = cases.rows()
    found = periodic_runs(cases.documents(spark)).collect()
    expected = []
    for d, t, *_ in rows:
        words = cases.words(t)
        runs = brute_runs(words) if len(words) < 5000 else []
        expected.append((d, runs, brute_collapsed(words, runs)))
    got = [(r.doc_id, [(x.start, x.period, x.length) for x in r.runs], r.collapsed_text) for r in found]
    assert cases.bag(got) == cases.bag(expected)
    assert periodic_runs(cases.nothing(spark)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, folder).collect()}
    assert len(found) == len(docs)
    n_planted = 0
    for doc_id, text in docs:
        words = cases.words(text)
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            n_planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs, r = brute_runs(words), found[doc_id]
        assert r.n_runs == len(runs)
        best = max(runs, key=lambda x: (x[2], -x[0], -x[1])) if runs else None
        assert (r.start, r.period, r.length) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[2] // best[1] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, q, n in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
    assert n_planted and any(r.n_runs for r in found.values())
