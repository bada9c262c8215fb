"""Mixing and the whole pipeline against plain Python."""

from __future__ import annotations

import hashlib
from collections import Counter

import llm_cases as cases
import public_tokenizers
import pytest
import sentencepiece
from test_near import brute_kept_rows
from test_texts import brute_lines, brute_measures

from tidemark.llm.mixing import mix, plan_mix
from tidemark.llm.quality import RULES, LineJudge, judged
from tidemark.llm.queries import ORACLES, QUERIES


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def targets(sizes, weights, share, repeats):
    """Words by source: shares of the open sources by weight, closing the ones that reach their cap, until none does."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        rest = budget - sum(repeats * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        new = {s for s in open_ if weight[s] * rest / sum(weight[x] for x in open_) >= repeats * sizes[s]}
        if not new:
            return {s: repeats * sizes[s] if s in full else weight[s] * rest / sum(weight[x] for x in open_) for s in names}
        full |= new


def brute_copies(rows, weights=(5, 2, 1), share=1.5, repeats=2, seed=0):
    """Copies of each (doc_id, source, text md5), which repeated rows share."""
    units = Counter((d, s, md5(t or "")) for d, t, _, s, _ in rows)
    size = {(d, s, md5(t or "")): len(cases.words(t)) for d, t, _, s, _ in rows}
    of_source = Counter()
    for u, n in units.items():
        of_source[u[1]] += n * size[u]
    wanted = targets(of_source, weights, share, repeats)
    place = {u: md5(f"{seed}:{'' if u[0] is None else u[0]}:{u[2]}") for u in units}
    queue = []
    for source in of_source:
        so_far = 0
        for u in sorted((u for u in units if u[1] == source), key=place.get):
            so_far += units[u] * size[u]
            if wanted[source] > 0:
                queue += [((turn * of_source[source] + so_far) / wanted[source], place[u], turn, u) for turn in range(repeats)]
    copies, reached = Counter(), 0
    for *_, u in sorted(queue, key=lambda x: x[:3]):
        reached += units[u] * size[u]
        if reached > share * sum(of_source.values()):
            break
        copies[u] += 1
    return units, size, of_source, wanted, copies


@pytest.mark.parametrize("how", [{}, {"slot_docs": 3, "weights": (1, 7), "share": 0.4, "seed": 9}, {"repeats": 3, "share": 2.5}])
def test_plan(spark, how):
    units, size, of_source, wanted, copies = brute_copies(cases.rows(), **{k: v for k, v in how.items() if k != "slot_docs"})
    found = plan_mix(cases.documents(spark), **how).collect()
    got = {(r.doc_id, r.source, r.text_md5): (r.n_rows, r.size, r.source_size, r.copies, r.taken) for r in found}
    assert got == {u: (n, size[u], of_source[u[1]], copies[u], copies[u] * size[u]) for u, n in units.items()}
    assert {r.source: r.target for r in found} == pytest.approx(wanted)
    assert all(r.copies <= how.get("repeats", 2) for r in found)
    taken = Counter()
    for r in found:
        taken[r.source] += r.taken * r.n_rows
    largest = max(size[u] * n for u, n in units.items())
    assert all(abs(taken[s] - wanted[s]) <= 2 * largest for s in wanted)
    assert cases.bag(map(tuple, found)) == cases.bag(map(tuple, plan_mix(cases.documents(spark), **how).collect()))


def test_mix_repeats_rows(spark):
    docs = cases.documents(spark)
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    units, _, _, _, copies = brute_copies(cases.rows())
    found = Counter((r.doc_id, r.source, md5(r.text or "")) for r in mixed.collect())
    assert found == Counter({u: copies[u] * n for u, n in units.items() if copies[u]})


def test_mix_of_nothing(spark):
    assert plan_mix(cases.nothing(spark)).collect() == [] and mix(cases.nothing(spark)).collect() == []
    empty = spark.createDataFrame([(1, None, "en", "a", 0), (2, " ", "en", "a", 0)], cases.SCHEMA)
    assert [(r.target, r.taken) for r in plan_mix(empty).collect()] == [(0.0, 0)] * 2


# -- the pipeline ----------------------------------------------------------------------------------------------------


def brute_pipeline(rows):
    cleaned = []
    for d, t, lang, source, _ in rows:
        m = brute_measures(t)
        verdict = judged([(t or "").encode()], LineJudge(RULES))
        if verdict[-2][0].as_py() and m[0] >= 10:
            text = verdict[-1][0].as_py()
            cleaned.append((d, text, lang, source, len(text)))
    lined = [(d, kept, lang, source, len(kept)) for (d, _, lang, source, _), (_, kept, _, _) in zip(cleaned, brute_lines(cleaned), strict=True) if cases.words(kept)]
    kept = brute_kept_rows(lined)
    _, _, _, _, copies = brute_copies(kept)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = Counter()
    for d, t, _, source, _ in kept:
        if n := copies[(d, source, md5(t))]:
            out[(d, source, tuple(library.encode(t)))] += n
    return out


def by_stages(spark, docs, folder):
    import corpus_pipeline

    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(folder))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        docs.write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return Counter((r.doc_id, r.source, tuple(r.piece_ids)) for r in docs.collect())


def test_pipeline_over_odd_documents(spark, tmp_path):
    found = by_stages(spark, cases.documents(spark, clashing=False), tmp_path)
    assert found == brute_pipeline(cases.rows()) and found


def test_pipeline_over_nothing_and_odd_columns(spark, tmp_path):
    assert by_stages(spark, cases.nothing(spark), tmp_path / "none") == Counter()
    assert by_stages(spark, cases.documents(spark), tmp_path / "odd")


def test_pipeline_over_the_test_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    import corpus_pipeline

    found = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.source, tuple(r.piece_ids)) for r in found) == brute_pipeline(rows)
    assert all(r.n_tokens == len(r.piece_ids) and len(r.piece_offsets) == r.n_tokens + 1 for r in found)


def test_registered():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert numbers == set(range(1, 14)) and set(ORACLES) <= set(QUERIES)
