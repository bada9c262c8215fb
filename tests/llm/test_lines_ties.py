"""Line dedup where rows share an id or have none."""

from __future__ import annotations

import llm_cases as cases

from tidemark.llm.lines import dedup_lines


def block(name, n=4):
    return "\n".join(f"{name} line {i}" for i in range(n))


def test_copies_without_an_id_keep_one_occurrence(spark):
    texts = [block("a")] * 5 + [block("b")] + [block("b") + "\n" + block("c")] * 2
    rows = [(None, t) for t in texts] + [(7, block("d"))] * 3 + [(7, block("d") + "\nmore"), (9, block("d"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = dedup_lines(docs).select("doc_id", "dedup_text").collect()
    left = [line for r in found for line in r.dedup_text.split("\n")]
    for name in "abcd":
        assert [left.count(line) for line in block(name).split("\n")] == [1] * 4
    assert len(found) == len(rows)


def test_order_of_rows_changes_nothing(spark):
    texts = [block("a"), block("a"), block("x", 2) + "\n" + block("a"), block("a") + "\n" + block("y", 3)]
    rows = [(i, t) for i in (None, 5) for t in texts]
    bags = []
    for n, given in ((1, rows), (3, rows[::-1]), (5, rows[4:] + rows[:4])):
        docs = spark.createDataFrame(given, "doc_id long, text string").repartition(n)
        bags.append(cases.bag(map(tuple, dedup_lines(docs).select("doc_id", "text", "dedup_text").collect())))
    assert bags[0] == bags[1] == bags[2]
