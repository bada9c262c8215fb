"""The bucket store: increments that rewrite their buckets only, snapshots under racing writers, and taking back."""

from __future__ import annotations

import threading
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fixtures import RUN, account, frame, hand_made, txn
from tidemark.functions.verdict import GateFailure
from tidemark.operators.lineage import with_lineage
from tidemark.plans.migration import ORDER
from tidemark.plans.snapshots import LostRace, Snapshots, with_folder
from tidemark.plans.store import CORE, EVALUATED, QUARANTINE, Store, advance, bucket_of, take_back
from tidemark.schemas import ENTITIES
from tidemark.session import scratch_path

WHEN = {"rejected_at"}


SHORT = ("branch", "customer", "account")


def some(spark):
    """The dimensions alone, for what the facts add nothing to."""
    return {n: t for n, t in hand_made(spark).items() if n in SHORT}


def contents(store, snapshot=None, names=SHORT):
    snapshot = snapshot or store.snapshots.newest()
    out = {}
    for layer in (EVALUATED, CORE, QUARANTINE):
        for name in names:
            rows = store.read(snapshot, layer, name)
            out[layer, name] = sorted(map(repr, rows.drop(*WHEN).collect()))
    return out


def stamped(tables, run=RUN):
    return {n: with_lineage(tables[n], ENTITIES[n], run.batch_id, run.instant("ingested_at")) for n in tables}


def late_customer(tables):
    """Customer 1 with a valid birth date and a later time of change; accounts that were rejected for it become valid."""
    first = F.col("customer_id") == 1
    changed = tables["customer"].where(first).withColumn("updated_at", F.lit(datetime(2020, 1, 2)))
    return {"customer": changed.withColumn("date_of_birth", F.lit("1990-01-01").cast("date"))}


def test_increment_equals_a_full_rebuild_and_rewrites_its_buckets(spark):
    tables, second = hand_made(spark), replace(RUN, batch_id="B-2", ingested_at="2026-08-27 00:00:00")
    store = Store(spark, scratch_path(spark, "store"), buckets=16)
    first = store.merge(stamped(tables), RUN)
    new = stamped(late_customer(tables), second)
    now = store.merge(new, second)

    whole = Store(spark, scratch_path(spark, "store"), buckets=16)
    both = stamped(tables)
    both["customer"] = both["customer"].unionByName(new["customer"])
    whole.merge(both, second)
    assert contents(store, names=ORDER) == contents(whole, names=ORDER)
    assert store.read(now, CORE, "customer").count() == store.read(first, CORE, "customer").count() + 1
    assert store.read(now, CORE, "account").count() > store.read(first, CORE, "account").count()

    def rewritten(name):
        (old,) = first.files[f"{CORE}/{name}"]
        return {b for folder, held in now.files[f"{CORE}/{name}"].items() if folder != old for b in held}

    assert rewritten("branch") == set() and now.files["core/branch"] == first.files["core/branch"]
    own = tables["customer"].where("customer_id = 1").select(bucket_of("customer", 16)).first()[0]
    assert rewritten("customer") == {own}
    touched = {r[0] for r in tables["account"].where("customer_id = 1").select(bucket_of("account", 16)).collect()}
    assert rewritten("account") == touched and len(touched) < 16
    (folder,) = [f for f in now.files["core/customer"] if f not in first.files["core/customer"]]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    assert files.count() == 1  # one bucket, one file


def test_every_split_into_increments_ends_alike(spark):
    tables = some(spark)
    whole = Store(spark, scratch_path(spark, "store"), buckets=8)
    rows = stamped(tables)
    whole.merge(rows, RUN)
    parts = Store(spark, scratch_path(spark, "store"), buckets=8)
    for i in range(2):  # children may come before their parents
        parts.merge({n: r.where(F.pmod(F.xxhash64("source_record_key", F.lit(n)), F.lit(2)) == i) for n, r in rows.items()}, RUN)
    assert contents(parts) == contents(whole)


def test_readers_keep_their_snapshot_and_a_failed_increment_shows_nothing(spark):
    tables = some(spark)
    store = Store(spark, scratch_path(spark, "store"), buckets=4)
    first = store.merge(stamped(tables), RUN)
    before = contents(store, first)
    broken = frame(spark, "transaction", [txn(900, amount=None)])  # neither valid nor rejected
    with pytest.raises(GateFailure, match="transaction: raw"):
        store.merge(stamped({**late_customer(tables), "transaction": broken}), RUN)
    assert store.snapshots.newest() == first and contents(store) == before
    store.merge(stamped(late_customer(tables)), RUN)
    assert contents(store, first) == before != contents(store)


def test_two_writers_one_loses(spark):
    folder = scratch_path(spark, "snapshots")
    book = Snapshots(spark, folder)
    base = book.commit(None, "base", {"core/a": {"x": [0]}})
    won, lost, gate = [], [], threading.Barrier(4)

    def write(i):
        gate.wait()
        try:
            won.append(Snapshots(spark, folder).commit(base, f"w{i}", {"core/a": {f"y{i}": [0]}, "core/b": {f"z{i}": [0]}}))
        except LostRace:
            lost.append(i)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and len(lost) == 3
    newest = book.newest()
    assert newest == won[0] and newest.number == 1
    assert next(iter(newest.files["core/a"]))[1:] == next(iter(newest.files["core/b"]))[1:]  # of one writer
    with pytest.raises(LostRace):
        book.commit(base, "late", {})


def test_claim_of_a_dead_writer_is_released(spark):
    book = Snapshots(spark, scratch_path(spark, "snapshots"))
    assert book.newest() is None and book._claim(0) and not book._claim(0)
    with pytest.raises(LostRace):
        book.commit(None, "x", {})
    book.release(0)
    assert book.commit(None, "x", {}).number == 0
    book.release(0)  # in place: stays
    assert book.newest().label == "x"


def test_sweep_removes_what_no_snapshot_names(spark):
    tables = some(spark)
    store = Store(spark, scratch_path(spark, "store"), buckets=4)
    first = store.merge(stamped(tables), RUN)
    for i in range(2):
        again = late_customer(tables)["customer"].withColumn("updated_at", F.lit(datetime(2021, 1, 1 + i)))
        store.merge(stamped({"customer": again}), RUN)
    data, now = f"{store.root}/data", contents(store)
    assert store.snapshots.sweep(2, data, reading=[first.number]) == []
    old = contents(store, first)
    removed = store.snapshots.sweep(1, data, reading=[first.number])
    assert removed and contents(store, first) == old and contents(store) == now
    assert store.snapshots.numbers() == [0, 2]
    store.snapshots.sweep(1, data)
    assert contents(store) == now and store.snapshots.numbers() == [2]
    assert with_folder({"t": {"a": [0, 1], "b": [2]}}, "t", "c", [2, 1]) == {"t": {"a": [0], "c": [1, 2]}}


def test_advance_and_take_back(spark):
    root, tables = scratch_path(spark, "migration"), some(spark)
    second = replace(RUN, batch_id="B-2", ingested_at="2026-08-27 00:00:00")
    third = replace(RUN, batch_id="B-3", ingested_at="2026-09-27 00:00:00")
    store = advance(tables, RUN, root, buckets=8)
    before = contents(store)
    late = late_customer(tables)["customer"]
    newer = {**tables, "customer": tables["customer"].where("customer_id <> 1").unionByName(late)}
    advance(newer, second, root, buckets=8)
    with_late = contents(store)
    assert with_late != before
    added = frame(spark, "account", [account(77, updated_at=datetime(2020, 2, 2))])
    newest = {**newer, "account": newer["account"].unionByName(added)}
    advance(newest, third, root, buckets=8)
    take_back(spark, second, root, "B-2", "wrong birth date", buckets=8)
    assert store.current(CORE, "account").where("account_id = 77").count() == 1  # the batch after it stays
    assert contents(store)[CORE, "customer"] == before[CORE, "customer"]
    # the rows that only the hidden batch held are extracted again
    advance(newest, replace(third, batch_id="B-4"), root, buckets=8)
    keys = {r.customer_id for r in store.current(CORE, "customer").collect()}
    assert 1 in keys and store.current(CORE, "account").where("account_id = 77").count() == 1
