"""Rows without a place, manifests in other zones and file systems, and rollbacks in the middle."""

from __future__ import annotations

import hashlib
import os
import time
from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fixtures import RUN, customer, frame, hand_made
from tidemark.plans import ledger, profile
from tidemark.plans.migration import Migration, migrate, roll_back
from tidemark.schemas import BRANCH, CUSTOMER
from tidemark.session import scratch_path
from tidemark.sources import landing, raw
from tidemark.sources.readers import path_exists
from tidemark.streaming import incremental as inc


def job(spark, tables, root, batch):
    run = replace(RUN, batch_id=batch)
    return Migration(tables, run, root, ledger.Ledgers(spark, root), True)


def remember(spark, root, work, batch):
    own = work.visible_raw("customer").where(F.col(raw.PARTITION) == batch)
    now = datetime.now()
    row = inc.extract_control(own, CUSTOMER.source_table, "updated_at", CUSTOMER.key, batch, F.lit(now)).first()
    if row.last_watermark_ts is not None:
        ledger.Ledgers(spark, root).append("source_extract_control", *row)
    time.sleep(0.01)


def keys_of(spark, root, batch):
    rows = spark.read.parquet(f"{root}/raw/customer").where(F.col(raw.PARTITION) == batch)
    return sorted(r.customer_id if r.customer_id is not None else -1 for r in rows.collect())


def rows_at(spark, *pairs):
    return frame(spark, "customer", [customer(i, updated_at=at) for i, at in pairs])


DAY = [datetime(2020, 1, d) for d in range(1, 10)]


def test_rows_without_a_place_are_extracted_once(spark):
    root = scratch_path(spark, "migration")
    table = rows_at(spark, (1, DAY[0]), (2, DAY[1]), (3, None), (None, DAY[1]))
    work = job(spark, {"customer": table}, root, "B-1")
    assert work.load("customer", True, False) == 4
    remember(spark, root, work, "B-1")
    grown = table.unionByName(rows_at(spark, (4, None), (5, DAY[2]), (None, DAY[2])))
    work = job(spark, {"customer": grown}, root, "B-2")
    assert work.load("customer", True, False) == 3 and keys_of(spark, root, "B-2") == [-1, 4, 5]
    remember(spark, root, work, "B-2")
    only_new = grown.unionByName(rows_at(spark, (6, None)))
    work = job(spark, {"customer": only_new}, root, "B-3")
    assert work.load("customer", True, False) == 1 and keys_of(spark, root, "B-3") == [6]
    remember(spark, root, work, "B-3")  # nothing with a time: the position of B-2 holds
    assert job(spark, {"customer": only_new}, root, "B-4").load("customer", True, False) == 0
    changed = only_new.withColumn("full_name", F.when(F.col("customer_id") == 3, F.lit("Other")).otherwise(F.col("full_name")))
    work = job(spark, {"customer": changed}, root, "B-5")
    assert work.load("customer", True, False) == 1 and keys_of(spark, root, "B-5") == [3]


def test_slices_and_unplaced_rows_are_the_whole(spark):
    table = rows_at(spark, *[(i if i % 4 else None, None if i % 5 == 0 else DAY[i % 3]) for i in range(40)])
    at = inc.Checkpoint(DAY[1], 17)
    parts = [f(table, "updated_at", "customer_id", at) for f in (inc.after, inc.upto, inc.unplaced)]
    assert sum(p.count() for p in parts) + table.where("customer_id IS NULL AND updated_at < '2020-01-02'").count() * 0 == 40
    assert parts[2].where("updated_at IS NOT NULL AND customer_id IS NOT NULL").count() == 0


def test_rollback_in_the_middle_extracts_again(spark):
    root = scratch_path(spark, "migration")
    table = rows_at(spark, (1, DAY[0]))
    for batch, i in (("B-1", 0), ("B-2", 1), ("B-3", 2)):
        table = table if i == 0 else table.unionByName(rows_at(spark, (i + 1, DAY[i])))
        work = job(spark, {"customer": table}, root, batch)
        work.load("customer", True, False)
        remember(spark, root, work, batch)
    books = ledger.Ledgers(spark, root)
    books.append("rolled_back_batch", "B-2", datetime.now(), "")
    assert books.positions().first().last_successful_batch_id == "B-1"
    work = job(spark, {"customer": table}, root, "B-4")
    work.load("customer", True, False)
    assert 2 in keys_of(spark, root, "B-4")  # only the hidden batch held it
    remember(spark, root, work, "B-4")
    assert books.positions().first().last_successful_batch_id == "B-4"  # positions after the rollback count


@pytest.fixture()
def another_zone():
    before = os.environ.get("TZ")
    os.environ["TZ"] = "Asia/Kolkata"
    time.tzset()
    yield
    os.environ["TZ"] = before or "UTC"
    time.tzset()


def test_manifest_in_another_zone_and_without_ranges(spark, another_zone):
    root = scratch_path(spark, "landing")
    rows = hand_made(spark)["branch"].withColumn("updated_at", F.lit("2015-01-01 00:00:00").cast("timestamp"))
    row = landing.land(rows, BRANCH, root, "B-1", RUN.instant("ingested_at")).first()
    assert row.min_updated_at == row.max_updated_at == "2015-01-01 00:00:00"
    blank = rows.withColumn("updated_at", F.lit(None).cast("timestamp"))
    row = landing.land(blank, BRANCH, root, "B-2", RUN.instant("ingested_at")).first()
    assert row.min_updated_at is None and row.max_updated_at is None and row.min_source_key is not None
    assert landing.verify_landing(spark, BRANCH, root, "B-2").first().status == "PASS"


def test_checksums_through_another_file_system(spark):
    """A path that only Hadoop's file systems can open, as object stores are."""
    root = scratch_path(spark, "landing")
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.elsewhere.link./data", root if ":" in root else f"file://{root}")
    landing.land(hand_made(spark)["customer"], CUSTOMER, "viewfs://elsewhere/data", "B-1", RUN.instant("ingested_at"))
    files = landing.read_manifest(spark, CUSTOMER, "viewfs://elsewhere/data", "B-1").collect()
    for r in files:
        content = (Path(root.removeprefix("file:")) / "customer" / "B-1" / r.file_name).read_bytes()
        assert r.sha256 == hashlib.sha256(content).hexdigest() and r.file_bytes == len(content)
    assert landing.verify_landing(spark, CUSTOMER, "viewfs://elsewhere/data", "B-1").first().status == "PASS"
    opened = landing.file_checksums(spark, f"{root}/customer/B-1", opener=landing.fs.FileSystem.from_uri)
    assert {r.sha256 for r in opened.collect()} == {r.sha256 for r in files}


def test_counts_against_manifests_notice_a_loss(spark):
    root, rows = scratch_path(spark, "landing"), hand_made(spark)["customer"]
    promised = landing.land(rows, CUSTOMER, root, "B-1", RUN.instant("ingested_at")).select("source_table", "row_count")
    for table, status in ((rows, "PASS"), (rows.where("customer_id <> 4"), "FAIL")):
        (check,) = profile.verify_counts({"customer": table}, promised, F.current_timestamp()).collect()
        assert check.status == status and check.source_value == "10"


def test_rollback_with_its_options(spark):
    """Without the newest-version option an older rejected version stays in quarantine; reconciliations follow."""
    root, tables = scratch_path(spark, "migration"), hand_made(spark)
    migrate(tables, RUN, root)
    before = spark.read.parquet(f"{root}/quarantine/customer").count()
    back = roll_back(spark, RUN, root, "B-9", "never loaded", sources=tables)
    assert back["customer"].count() == 4 and spark.read.parquet(f"{root}/quarantine/customer").count() == before
    assert spark.read.parquet(f"{root}/reconciliation/transaction_reconciliation").count() == 7
    roll_back(spark, RUN, root, "B-9", "again")
    assert not path_exists(spark, f"{root}/reconciliation/transaction_reconciliation")
