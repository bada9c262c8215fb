"""Spelling variants against all pairs of words, and the words of documents against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import llm_cases as cases
import pytest

from tidemark.llm.queries import ORACLES, QUERIES, counted_words
from tidemark.llm.spelling import spelling_variants, trie_nodes


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    near = {w: [v for v in counts if is_near(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] and counts[best] > counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def vocabulary(seed=2, n=700):
    rng, out = random.Random(seed), {"": 3, "a": 900, "aa": 4, "aaa": 0, "aaaa": 0, "é": 7, "éé": 40, "z" * 300: 50, "z" * 301: 2, "z" * 150 + "y" + "z" * 150: 1}
    letters = "abcéÿ"
    while len(out) < n:
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 9)))
        out[word] = rng.choice([0, 1, 5, 25, 125, 625, 3000, rng.randrange(5000)])
    return out


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_variants(spark, parts):
    counts = vocabulary()
    rows = [(w, n, "own") for w, n in counts.items()]
    words = spark.createDataFrame(rows, "word string, n long, root string").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = spelling_variants(words).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert cases.bag(map(tuple, found)) == cases.bag(brute(counts))


def test_nodes_are_those_of_one_trie(spark):
    texts = sorted(vocabulary(n=300))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.createDataFrame(list(enumerate(texts)), "key long, sorted string").repartition(5)
    found = trie_nodes(rows, "test-nodes").collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    number = {}
    for r in found:
        assert len(r.nodes) == len(r.sorted) + 1
        for i, node in enumerate(r.nodes):
            assert number.setdefault(r.sorted[:i], node) == node
    assert len(set(number.values())) == len(number)
    assert [w for _, w in sorted((number[w], w) for w in texts)] == texts


def test_chains_repeated_rows_and_nothing(spark):
    chain = {f"word{'x' * i}": 5**i for i in range(12)}
    rows = [(w, n) for w, n in chain.items()] + [("single", 2), ("single", 3), (None, 9), ("lonely", None)]
    found = {r.word: tuple(r)[1:] for r in spelling_variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert found["word"] == ("wordx", f"word{'x' * 11}", 1, 1, 5)
    assert found["single"] == (None, "single", 5, 0, None) and found["lonely"] == (None, "lonely", 0, 0, None)
    assert spelling_variants(spark.createDataFrame([], "word string, n long")).collect() == []


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def test_words_of_documents(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, i]), " ".join(rng.choice(["Straße", "ÉCOLE", "letters", "LETTERS1more", "×÷abcdef", "naïveté", "abcdeſ"]) for _ in range(60)) * 3) for i in range(60)]
    docs = spark.createDataFrame([*rows, (1, None), (2, ""), (3, "x" * 100_000)], "doc_id long, text string").repartition(3)
    assert dict(map(tuple, counted_words(docs).collect())) == brute_words(rows)


def test_query_and_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = cases.bag(map(tuple, QUERIES["op13_spelling_variants"](spark, folder).collect()))
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert found == cases.bag(brute(brute_words(docs))) and any(r[1] for r in found)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
        assert found == cases.bag(db.execute(ORACLES["op13_spelling_variants"]).fetchall())
