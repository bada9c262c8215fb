"""Presence masks and localised comparison, with planted losses."""

from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tidemark.plans.completeness import differences, incomplete_records, presence, range_digests, unequal_ranges
from tidemark.session import materialise


def layer(spark, keys):
    return spark.createDataFrame([("B-1", k) for k in keys], "migration_batch_id string, source_record_key string")


def test_every_kind_of_loss_is_named(spark):
    sets = {
        "source": ["ok", "rejected", "lost", "open", "gone", "twice", "both", None],
        "raw": ["ok", "rejected", "extra", "open", "gone", "twice", "twice", "both", None],
        "quarantine": ["rejected", "rejected", "both"],
        "staging": ["ok", "gone", "twice", "both", "stray", None],
        "core": ["ok", "twice", "both", "stray", "odd", None, None],
    }
    found = incomplete_records({n: layer(spark, ks) for n, ks in sets.items()}, by=["migration_batch_id"]).collect()
    assert sorted(((r.source_record_key or "-"), r.finding) for r in found) == sorted([
        ("lost", "LOST_BEFORE_RAW"), ("extra", "NOT_IN_SOURCE"), ("extra", "UNACCOUNTED"), ("open", "UNACCOUNTED"),
        ("gone", "LOST_BEFORE_CORE"), ("twice", "DOUBLED_IN_RAW"), ("both", "VALID_AND_REJECTED"), ("stray", "NOT_FROM_RAW"),
        ("odd", "NOT_FROM_STAGING"), ("-", "DOUBLED_IN_CORE"),
    ])
    masks = {r.source_record_key: r.mask for r in presence({n: layer(spark, ks) for n, ks in sets.items()}).collect()}
    assert masks["ok"] == 0b11011 and masks["rejected"] == 0b00111
    nothing = {n: layer(spark, []) for n in sets}
    assert incomplete_records(nothing).collect() == []


def test_hot_key_is_folded_before_the_shuffle(spark):
    hot = spark.range(0, 30_000, 1, 8).selectExpr("IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS source_record_key")
    plan = presence({"source": hot, "raw": hot})._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "partial_bit_or" in plan


def brute(left, right):
    a, b = Counter(left), Counter(right)
    out = {}
    for k in {r[0] for r in [*left, *right]}:
        mine, theirs = ({r: n for r, n in c.items() if r[0] == k} for c in (a, b))
        if mine != theirs:
            out[k] = "ONLY_LEFT" if not theirs else "ONLY_RIGHT" if not mine else "CHANGED"
    return out


def test_differences_against_brute_force(spark):
    rng = random.Random(1)
    schema = "id long, a string, b string"
    for _ in range(3):
        left = [(rng.choice([None, rng.randrange(60)]), rng.choice(["x", None, "y"]), rng.choice([None, "x"])) for _ in range(150)]
        right = [r if rng.random() < 0.95 else (r[0], r[2], r[1]) for r in left if rng.random() < 0.97]
        right += [(rng.randrange(60, 70), "new", None)]
        found = differences(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["id"], ["a", "b"], 4, 4).collect()
        assert {r.id: r.difference for r in found} == brute(left, right) and len(found) == len({r.id for r in found})


def test_one_changed_row_among_many(spark):
    left = spark.range(0, 200_000, 1, 8).select("id", (F.col("id") * 7).alias("v"))
    right = left.withColumn("v", F.when(F.col("id") == 77_777, F.lit(0)).otherwise(F.col("v")))
    digests = [materialise(range_digests(df, ["id"], ["v"]), "digests") for df in (left, right)]
    assert unequal_ranges(*digests).count() == 1 and unequal_ranges(digests[0], digests[0]).count() == 0
    found = differences(left, right, ["id"], ["v"])
    assert [tuple(r) for r in found.collect()] == [(77_777, "CHANGED")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"LeftSemi", plan)) >= 2 and "FullOuter" not in plan
    compared = found._jdf.queryExecution().analyzed().toString()
    assert compared.count("unequal") <= 2  # the ranges are a settled table
    halves = left.where("id < 100000"), left.where("id >= 100000")
    parts = [range_digests(h, ["id"], ["v"]) for h in halves]
    assert unequal_ranges(parts[0].unionByName(parts[1]), digests[0]).count() == 0  # digests add up
