"""Overlay, insert-if-absent, versions, change detection, status history and incremental slices."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fixtures import RUN, customer, frame, hand_made
from tidemark.operators import changes as chg
from tidemark.operators.lineage import with_lineage
from tidemark.plans import ledger, profile
from tidemark.schemas import CUSTOMER
from tidemark.session import scratch_path
from tidemark.streaming import incremental as inc


def stamped(df, batch="B-1", at="2026-01-01 00:00:00"):
    return with_lineage(df, CUSTOMER, batch, F.lit(at).cast("timestamp"))


def test_overlay_changes_only_patched_columns(spark):
    base = hand_made(spark)["customer"]
    patch = spark.createDataFrame([(2, "new@x.org"), (99, "z")], "customer_id BIGINT, email STRING")
    after = {r.customer_id: r for r in chg.overlay(base, patch, "customer_id").collect()}
    before = {r.customer_id: r for r in base.collect()}
    assert after[2].email == "new@x.org" and after[2].full_name == before[2].full_name
    assert {k: v for k, v in after.items() if k != 2} == {k: v for k, v in before.items() if k != 2}
    twice = chg.overlay(base, patch.unionByName(patch), "customer_id")
    assert twice.count() == base.count()


def test_insert_missing_is_idempotent(spark):
    rows = hand_made(spark)["customer"]
    stored = rows.where("customer_id <= 8")
    added = chg.insert_missing(stored, rows.unionByName(rows), "customer_id")
    assert sorted(r.customer_id for r in added.collect()) == [9, 10]
    assert chg.insert_missing(stored.unionByName(added), rows, "customer_id").count() == 0


def test_latest_with_many_copies_of_one_record(spark):
    many = [customer(1, full_name=f"v{i % 50}", updated_at=datetime(2020, 1, 1) + timedelta(days=i % 50)) for i in range(3000)]
    df = stamped(frame(spark, "customer", many + [customer(i) for i in range(2, 6000)]))
    kept = chg.latest(df)
    assert kept.count() == 5999
    assert kept.where("customer_id = 1").first().full_name == "v49"


def test_change_kinds(spark):
    old = stamped(frame(spark, "customer", [customer(1), customer(2), customer(3)]))
    new = stamped(frame(spark, "customer", [customer(1), customer(2, full_name="other"), customer(4)]), "B-2")
    found = {r.source_record_key: r.change for r in chg.changes(old, new).collect()}
    assert found == {"1": "UNCHANGED", "2": "CHANGED", "3": "MISSING", "4": "NEW"}


def brute_history(rows):
    by_key = {}
    for key, at, state in sorted(set(rows), key=lambda r: r[:2]):
        by_key.setdefault(key, []).append((at, state))
    result = set()
    for key, points in by_key.items():
        starts = [p for i, p in enumerate(points) if i == 0 or points[i - 1][1] != p[1]]
        for i, (at, state) in enumerate(starts):
            result.add((key, state, at, starts[i + 1][0] if i + 1 < len(starts) else None))
    return result


def test_status_history_equals_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for key in range(20):
        for _ in range(400 if key == 3 else 15):  # one key has far more versions
            rows.append((key, datetime(2020, 1, 1) + timedelta(minutes=rng.randrange(60 * 24 * 10)), rng.choice(["A", "B", "C", None])))
    rows = list({(k, at): (k, at, s) for k, at, s in rows}.values())
    df = spark.createDataFrame(rows + rows, "account_id BIGINT, source_updated_at TIMESTAMP, status STRING")
    got = chg.status_history(df, "account_id", "status").collect()
    assert {(r.account_id, r.status, r.valid_from, r.valid_to) for r in got} == brute_history(rows)
    assert all(r.is_current == (r.valid_to is None) for r in got)


def test_status_history_takes_null_for_a_state(spark):
    day = [datetime(2020, 1, 1, h) for h in range(5)]
    rows = [(1, day[0], "A"), (1, day[1], None), (1, day[2], "A"), (2, day[0], None), (2, day[1], None), (2, day[2], "B")]
    df = spark.createDataFrame(rows, "account_id BIGINT, source_updated_at TIMESTAMP, status STRING")
    history = chg.status_history(df, "account_id", "status")
    got = {(r.account_id, r.status, r.valid_from, r.valid_to) for r in history.collect()}
    assert got == {(1, "A", day[0], day[1]), (1, None, day[1], day[2]), (1, "A", day[2], None),
                   (2, None, day[0], day[2]), (2, "B", day[2], None)}
    assert history._jdf.queryExecution().sparkPlan().toString().count("Exchange") <= 2


def test_slices_partition_rows_that_share_a_timestamp(spark):
    at = datetime(2020, 1, 1)
    rows = [(i, at + timedelta(days=i // 10)) for i in range(100)]
    df = spark.createDataFrame(rows, "k BIGINT, changed TIMESTAMP")
    seen, checkpoint = [], None
    for _ in range(40):
        piece = inc.after(df, "changed", "k", checkpoint).orderBy("changed", "k").limit(7)
        following = inc.next_checkpoint(piece, "changed", "k")
        if following is None:
            break
        seen += [r.k for r in piece.collect()]
        checkpoint = following
        assert inc.upto(df, "changed", "k", checkpoint).count() == len(seen)
    assert seen == list(range(100))


def test_stored_positions_keep_microseconds_and_types(spark):
    control = ledger.Ledgers(spark, scratch_path(spark, "control"))
    at = datetime(2024, 1, 1, 12, 0, 0, 123457)
    schema = spark.createDataFrame([], "a BIGINT, d DATE").schema
    assert inc.stored_checkpoint(control.positions(), "t", schema, ("a", "d")) is None
    for number, key in ((1, "9|2020-01-01"), (2, "10|2020-02-03")):
        control.append("source_extract_control", "t", at, key, f"B-{number}", datetime(2024, 1, number))
    assert inc.stored_checkpoint(control.positions(), "t", schema, ("a", "d")) == inc.Checkpoint(at, (10, datetime(2020, 2, 3).date()))
    control.append("rolled_back_batch", "B-2", at, "")
    assert inc.stored_checkpoint(control.positions(), "t", schema, "a").key == 9
    rows = spark.createDataFrame([(10, datetime(2020, 2, 3), at), (10, datetime(2020, 2, 4), at)], "a BIGINT, d DATE, u TIMESTAMP")
    assert inc.after(rows, "u", ("a", "d"), inc.Checkpoint(at, (10, datetime(2020, 2, 3).date()))).count() == 1


def test_checkpoint_filter_reaches_the_scan(spark):
    path = scratch_path(spark, "pushdown")
    spark.range(10).selectExpr("id AS k", "timestamp_seconds(id) AS changed").write.parquet(path)
    df = spark.read.parquet(path)
    plan = inc.after(df, "changed", "k", inc.Checkpoint(datetime(1970, 1, 1, 0, 0, 5), 5))._jdf.queryExecution()
    assert "GreaterThanOrEqual(changed" in plan.executedPlan().toString()


def test_stream_replay_is_exactly_once(spark):
    source, target, progress = (scratch_path(spark, x) for x in ("in", "out", "progress"))
    spark.range(50).write.parquet(source)
    schema = spark.read.parquet(source).schema

    def stamp(rows, batch_id):
        return rows.withColumn("migration_batch_id", F.lit(batch_id))

    inc.stream_to_raw(spark, source, schema, target, progress, stamp)
    inc.stream_to_raw(spark, source, schema, target, progress, stamp)
    assert spark.read.parquet(target).count() == 50
    with pytest.raises(Exception, match="written by another query"):
        inc.stream_to_raw(spark, source, schema, target, scratch_path(spark, "lost-progress"), stamp)
    assert spark.read.parquet(target).count() == 50
    spark.range(50, 60).write.mode("append").parquet(source)
    inc.stream_to_raw(spark, source, schema, target, progress, stamp)
    assert spark.read.parquet(target).count() == 60
    assert inc.rows_per_stream_batch(spark, target).count() == 2


def test_ledger_and_restart(spark):
    rows = hand_made(spark)
    names = ("branch", "customer")
    tables = {n: rows[n] for n in names}
    none = {n: spark.createDataFrame([], "source_record_key STRING") for n in names}
    lost = {**tables, "customer": rows["customer"].limit(3)}
    when = RUN.instant("ingested_at")
    runs = ledger.table_runs("B-1", tables, tables, lost, none, when, when)
    status = {r.table_name: r.status for r in runs.collect()}
    assert status == {"core.branch": "SUCCEEDED", "core.customer": "FAILED"}
    planned = runs.select("batch_id", "table_name")
    assert [r.table_name for r in ledger.pending(planned, runs).collect()] == ["core.customer"]
    assert ledger.batch_ledger(runs, "HISTORICAL", "x").first().status == "FAILED"


def test_defect_coverage(spark):
    manifest = spark.createDataFrame(
        [("D1", "t", "1", "R"), ("D2", "t", "2", "R")],
        "defect_id STRING, source_table STRING, source_record_key STRING, rule_id STRING",
    )
    quarantined = spark.createDataFrame([("t", "1", "R"), ("t", "1", "R"), ("t", "2", "Q")],
                                        "source_table STRING, source_record_key STRING, rule_id STRING")
    found = {r.defect_id: r.outcome for r in profile.defect_coverage(manifest, quarantined).collect()}
    assert found == {"D1": "FOUND", "D2": "MISSED"}
