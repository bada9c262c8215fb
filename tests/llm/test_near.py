"""Near-dedup by shingles against brute force, on edited copies and clouds."""

from __future__ import annotations

import random
from collections import Counter

import llm_cases as cases
import numpy as np
import pytest
import xxhash
from test_links import closed

import corpus_pipeline
from tidemark.llm.simhash import LAST
from tidemark.llm.near import BANDS, band_keys, keep_one_alike, shingle_sets


def shingles(text):
    ws = cases.words((text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(ws[i : i + 5]) for i in range(len(ws) - 4)) or frozenset([tuple(ws)])


def similarity(a, b):
    return len(a & b) / len(a | b)


def stays(row):
    """What decides which row of a component stays: the smallest id, nulls last, then the hash of the text."""
    unsigned = xxhash.xxh64_intdigest((row[1] or "").encode(), 42) if row[1] is not None else 42
    return LAST if row[0] is None else row[0], unsigned - (1 << 64) if unsigned >> 63 else unsigned


def brute_kept_rows(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    least = {}
    for i, root in closed(pairs, range(len(rows))).items():
        least[root] = min(least.get(root, rows[i]), rows[i], key=stays)
    return list(least.values())


def brute_kept(rows):
    return sorted(r[0] for r in brute_kept_rows(rows))


def edited(rng, words, n_edits):
    out = list(words)
    for at in rng.sample(range(len(out)), n_edits):
        out[at] = f"edit{rng.randrange(10**9)}"
    return out


def edited_copies(seed=5):
    """Originals of different lengths, each with copies of 1 to 12 edits, a clean part of them, and strangers."""
    rng, out = random.Random(seed), []
    for n in (40, 90, 200, 400, 700):
        for n_edits in range(1, 13):
            words = cases.prose(rng, n, 3000).split()
            copy = edited(rng, words, max(1, n * n_edits // 400))
            out += [words, copy, words[: n // 2] + cases.prose(rng, n // 2, 3000).split()]
    out += [cases.prose(rng, 60).split() for _ in range(40)]
    order = rng.sample(range(len(out)), len(out))
    return [(i, " ".join(out[k]), "en", "src0", 1) for i, k in enumerate(order)]


def test_stage_drops_edited_copies_and_keeps_the_rest(spark):
    rows = edited_copies()
    sets = [shingles(t) for _, t, *_ in rows]
    near = [s for i, a in enumerate(sets) for b in sets[:i] if (s := similarity(a, b)) >= 0.8]
    assert Counter(min(int(20 * s), 19) for s in near).keys() >= {16, 17, 18}  # from 0.8 to 0.95
    docs = spark.createDataFrame(rows, cases.SCHEMA).repartition(3)
    found = corpus_pipeline.near_copies(spark, docs, "")
    assert found.columns == docs.columns
    assert sorted(r.doc_id for r in found.collect()) == brute_kept(rows)


@pytest.mark.parametrize("slice_bytes", [16 << 20, 2000])
def test_cloud_in_slices(spark, slice_bytes):
    rng = random.Random(3)
    base = cases.prose(rng, 120, 3000).split()
    rows = [(i, " ".join(edited(rng, base, rng.randrange(1, 6))), "en", "src0", 1) for i in range(60)]
    rows += [(100 + i, cases.prose(rng, 80), "en", "src0", 1) for i in range(10)]
    docs = spark.createDataFrame(rows, cases.SCHEMA).repartition(3)
    assert sorted(r.doc_id for r in keep_one_alike(docs, slice_bytes=slice_bytes).collect()) == brute_kept(rows)


def test_odd_documents(spark):
    """Null and repeated ids included: every component keeps one row."""
    rows = cases.rows()
    found = keep_one_alike(cases.documents(spark, clashing=False)).collect()
    assert cases.bag(map(tuple, found)) == cases.bag(brute_kept_rows(rows))
    assert keep_one_alike(cases.nothing(spark)).collect() == []
    assert keep_one_alike(cases.documents(spark)).columns == cases.documents(spark).columns


def test_recall_of_bands():
    """Of sets at 0.8 or little more, all share a band."""
    rng, missed = np.random.default_rng(1), 0
    for _ in range(2000):
        common, a, b = (rng.integers(0, 1 << 64, n, np.uint64) for n in (160, 20, 20))
        missed += not (band_keys(np.r_[common, a]) == band_keys(np.r_[common, b])).any()
    assert missed == 0 and len(band_keys(common)) == BANDS


def test_shingle_sets():
    sets = list(shingle_sets([b"A b c d e f", b"a b C d e F", b"a b", b"", b"a b c d e a b c d e"], 5))
    assert [len(s) for s in sets] == [2, 2, 1, 0, 5] and (sets[0] == sets[1]).all()
