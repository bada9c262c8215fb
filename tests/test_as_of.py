"""Joins as of an instant against plain Python, and the shape of their plan."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from tidemark.operators.changes import as_of_periods

START = datetime(2020, 1, 1)


def made(seed):
    rng = random.Random(seed)
    periods, facts = [], []
    for key in (1, 2, 3, 7):
        at = START + timedelta(days=rng.randrange(30))
        for i in range(rng.randrange(0, 6)):
            until = at + timedelta(microseconds=rng.randrange(1, 10**13))
            periods.append((key, f"s{i}", at, None if i == 5 else until))
            at = until + timedelta(days=rng.choice([0, 0, 9]))
    for i in range(300):
        edge = rng.choice(periods)[2] if rng.random() < 0.3 else START + timedelta(microseconds=rng.randrange(2 * 10**13))
        facts.append((i, rng.choice([1, 1, 1, 2, 3, 4, None]), None if rng.random() < 0.05 else edge))
    return facts, periods


@pytest.mark.parametrize("bins", [1, 7, 64])
def test_every_fact_gets_its_period(spark, bins):
    facts, periods = made(bins)
    found = as_of_periods(
        spark.createDataFrame(facts, "id long, k long, at timestamp"), "k", "at",
        spark.createDataFrame(periods, "key long, status string, valid_from timestamp, valid_to timestamp"), "key", {"status": "then"}, bins,
    ).collect()
    expected = []
    for i, k, at in facts:
        held = [s for key, s, a, b in periods if key == k and at is not None and a <= at and (b is None or at < b)]
        expected.append((i, held[0] if held else None))
    assert Counter((r.id, r.then) for r in found) == Counter(expected) and any(x for _, x in expected)


def test_plan_has_no_cross_join_and_splits_by_bin(spark):
    facts, periods = made(1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = as_of_periods(
            spark.createDataFrame(facts, "id long, k long, at timestamp"), "k", "at",
            spark.createDataFrame(periods, "key long, status string, valid_from timestamp, valid_to timestamp"), "key", {"status": "then"},
        )
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "hashpartitioning(k" in plan and "fact_bin" in plan


def test_no_facts(spark):
    none = spark.createDataFrame([], "id long, k long, at timestamp")
    periods = spark.createDataFrame(made(1)[1], "key long, status string, valid_from timestamp, valid_to timestamp")
    assert as_of_periods(none, "k", "at", periods, "key", {"status": "then"}).collect() == []
