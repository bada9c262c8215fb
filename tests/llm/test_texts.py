"""Substring dedup, quality rules and line dedup against plain Python."""

from __future__ import annotations

import hashlib

import llm_cases as cases
import pytest
from pyspark.sql import functions as F

from tidemark.llm.lines import dedup_lines
from tidemark.llm.quality import quality_rules
from tidemark.llm.substrings import dedup_substrings

LATE = 1 << 62


def brute_substrings(rows, width=13):
    first = {}
    for doc_id, text, *_ in rows:
        ws = cases.words(text)
        for i in range(len(ws) - width + 1):
            key, at = tuple(ws[i : i + width]), LATE if doc_id is None else doc_id
            first[key] = min(first.get(key, at), at)
    out = []
    for doc_id, text, *_ in rows:
        ws, gone, at = cases.words(text), set(), LATE if doc_id is None else doc_id
        for i in range(len(ws) - width + 1):
            if first[tuple(ws[i : i + width])] < at:
                gone.update(range(i, i + width))
        out.append((doc_id, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return out


@pytest.mark.parametrize("how", [{}, {"chunk_bytes": 3000, "bucket_windows": 500}])
def test_substrings(spark, how):
    found = dedup_substrings(cases.documents(spark), **how).collect()
    assert cases.bag(tuple(r)[:4] for r in found) == cases.bag(brute_substrings(cases.rows()))
    for r in found:
        assert sum(s.stop - s.start for s in r.removed) == r.n_removed
        assert all(a.stop < b.start for a, b in zip(r.removed, r.removed[1:]))  # maximal
    assert any(r.n_removed for r in found)


def test_substrings_of_nothing(spark):
    assert dedup_substrings(cases.nothing(spark)).collect() == []


def brute_measures(text):
    text = text or ""
    ws, lines = cases.words(text), [line for line in text.split("\n") if cases.words(line)]
    places = {}
    for i in range(len(ws) - 4):
        places.setdefault(tuple(ws[i : i + 5]), []).append(i)
    repeated = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    return len(ws), len("".join(ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def test_quality(spark):
    judged = quality_rules(cases.documents(spark))
    assert set(judged.columns) >= set(cases.CLASHING) | {"doc_id", "n_words", "kept"}
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = judged.select("doc_id", "text", *names, "base_failed").collect()
    expected = []
    for doc_id, text, *_ in cases.rows():
        m = brute_measures(text)
        expected.append((doc_id, text, *m, m[0] < 10 or 100 * m[4] > 20 * m[0]))
    assert cases.bag(map(tuple, found)) == cases.bag(expected)
    assert quality_rules(cases.nothing(spark)).collect() == []


def test_quality_lines(spark):
    good = "This is a plain line, with words enough to stand on its own."
    texts = {
        1: "\n".join([good, "Home | News | Sport | Weather", good.upper()]),  # navigation goes, the rest stays
        2: "\n".join([good, "All Rights Reserved."]),
        3: "\n".join([good, " ".join(f"w{i}$$$ x{i}###" for i in range(16))]),  # mostly symbols
        4: "\n".join(["Home | News | Sport | Weather"] * 2 + ["a b c d e f g h i j"]),
        5: "We write to Mrs. O'Neil (see http://example.org/a?b=c), who lives at 12, Long Lane; she replied: \"no\"!",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert found[1].kept and found[1].clean_text == good + "\n" + good.upper() and found[1].navigation_lines == 1
    assert found[2].kept and found[2].clean_text == good and found[2].boilerplate_lines == 1
    assert not found[3].kept and found[3].punctuation_lines == 1 and not found[3].base_failed
    assert not found[4].kept and found[4].lost_chars > 0
    assert found[5].kept and found[5].clean_text == texts[5]


def brute_lines(rows, width=3):
    first, windows = {}, []
    for doc_id, text, *_ in rows:
        lines = [] if text is None else text.split("\n")
        full = [i for i, line in enumerate(lines) if cases.words(line)]
        own = []
        for k in range(len(full) - width + 1):
            key, at = tuple(lines[i] for i in full[k : k + width]), (LATE if doc_id is None else doc_id, k)
            first[key] = min(first.get(key, at), at)
            own.append((key, at, full[k : k + width]))
        windows.append((doc_id, text, lines, full, own))
    out = []
    for doc_id, text, lines, full, own in windows:
        gone = sorted({i for key, at, covered in own if at > first[key] for i in covered})
        kept = None if text is None else "\n".join(line for i, line in enumerate(lines) if i not in gone)
        out.append((doc_id, kept, len(full), gone))
    return out


def test_lines(spark):
    found = dedup_lines(cases.documents(spark))
    assert set(found.columns) >= set(cases.CLASHING)
    got = found.select("doc_id", "dedup_text", "dedup_lines", "dedup_removed").collect()
    assert cases.bag(map(tuple, got)) == cases.bag(brute_lines(cases.rows()))
    assert any(r.dedup_removed for r in got)
    assert dedup_lines(cases.nothing(spark)).collect() == []


def test_lines_many_in_one_text(spark):
    text = "\n".join(f"line {i % 700}" for i in range(20_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = dedup_lines(docs).select("dedup_text", "dedup_lines").first()
    assert row.dedup_lines == 20_000 and row.dedup_text == "\n".join(f"line {i}" for i in range(700))


def test_digests_of_queries(spark):
    """The digest of a query is that of the operator's text."""
    from tidemark.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.kept_text for r in dedup_substrings(docs).collect()}
    for r in QUERIES["op1_substring_dedup"](spark, folder).where(F.col("n_removed") > 0).collect():
        assert r.kept_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
