"""Landing, manifests, raw loads, idempotency and sinks."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fixtures import RUN, customer, frame, hand_made
from tidemark.operators.lineage import with_lineage
from tidemark.schemas import ACCOUNT, BALANCE, CUSTOMER, TRANSACTION
from tidemark.session import scratch_path
from tidemark.sources import landing, raw, sinks
from tidemark.sources.readers import EmptyExtract, jdbc_options, read_csv


def local(path: str) -> Path:
    return Path(path.removeprefix("file:"))


def ingested():
    return RUN.instant("ingested_at")


def test_manifest_matches_the_files(spark):
    root = scratch_path(spark, "landing")
    rows = landing.land(hand_made(spark)["customer"], CUSTOMER, root, "B-1", ingested()).collect()
    assert {r.row_count for r in rows} == {10}
    assert {(r.min_source_key, r.max_source_key) for r in rows} == {("1", "10")}
    for r in rows:
        content = (local(landing.batch_path(root, CUSTOMER, "B-1")) / r.file_name).read_bytes()
        assert r.file_row_count <= 10
        assert hashlib.sha256(content).hexdigest() == r.sha256
    assert landing.verify_landing(spark, CUSTOMER, root, "B-1").first().status == "PASS"


def test_composite_key_manifest(spark):
    root = scratch_path(spark, "landing")
    row = landing.land(hand_made(spark)["daily_balance"], BALANCE, root, "B-1", ingested()).first()
    assert (row.min_account_id, row.max_account_id) == ("1", "3")
    assert (row.min_business_date, row.max_business_date) == ("2020-01-01", "2020-01-09")


def test_a_batch_lands_once_and_never_empty(spark):
    root = scratch_path(spark, "landing")
    customers = hand_made(spark)["customer"]
    landing.land(customers, CUSTOMER, root, "B-1", ingested())
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        landing.land(customers, CUSTOMER, root, "B-1", ingested())
    with pytest.raises(EmptyExtract):
        landing.land(customers.where("FALSE"), CUSTOMER, root, "B-2", ingested())
    landing.land(customers, CUSTOMER, root, "B-2", ingested())  # the failed extract does not block the id


def test_missing_landing_raises(spark):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        landing.read_batch(spark, CUSTOMER, scratch_path(spark, "nothing"), "B-1").count()


def test_verification_notices_a_changed_file(spark):
    root = scratch_path(spark, "landing")
    landing.land(hand_made(spark)["account"].coalesce(1), ACCOUNT, root, "B-1", ingested())
    folder = landing.batch_path(root, ACCOUNT, "B-1")
    hand_made(spark)["account"].limit(2).coalesce(1).write.mode("append").parquet(folder)
    result = landing.verify_landing(spark, ACCOUNT, root, "B-1").first()
    assert (result.status, result.file_mismatches) == ("FAIL", 1)
    assert result.landed_rows == result.manifest_rows + 2


def test_same_batch_twice_is_an_error(spark):
    path = scratch_path(spark, "raw")
    accounts = hand_made(spark)["account"]
    raw.load_raw(accounts, ACCOUNT, path, "B-1", ingested())
    with pytest.raises(raw.BatchAlreadyLoaded):
        raw.load_raw(accounts, ACCOUNT, path, "B-1", ingested())
    counts = raw.load_raw(accounts, ACCOUNT, path, "B-2", ingested())
    assert {tuple(r) for r in counts.collect()} == {("B-1", 11), ("B-2", 11)}


def test_replayed_batch_changes_nothing(spark):
    path = scratch_path(spark, "raw")
    stamped = with_lineage(hand_made(spark)["account"], ACCOUNT, "B-1", ingested())
    raw.append_batch(with_lineage(hand_made(spark)["account"], ACCOUNT, "B-0", ingested()), path)
    for _ in range(2):
        raw.replace_batch(stamped, path)
    assert raw.read_raw(spark, ACCOUNT, path).groupBy("migration_batch_id").count().count() == 2
    assert raw.read_raw(spark, ACCOUNT, path).count() == 22


def test_unseen_keeps_only_new_versions(spark):
    rows = hand_made(spark)["customer"]
    stored = with_lineage(rows, CUSTOMER, "B-1", ingested())
    changed = rows.withColumn("full_name", F.expr("IF(customer_id = 3, 'Other', full_name)"))
    again = with_lineage(changed.unionByName(changed), CUSTOMER, "B-2", ingested())
    assert [r.customer_id for r in raw.unseen(again, stored).collect()] == [3]


def test_rollback_hides_a_batch(spark):
    accounts = hand_made(spark)["account"]
    stored = with_lineage(accounts, ACCOUNT, "B-1", ingested()).unionByName(
        with_lineage(accounts, ACCOUNT, "B-2", ingested())
    )
    assert {r[0] for r in raw.without_batches(stored, ["B-2"]).select("migration_batch_id").collect()} == {"B-1"}


def test_dropping_a_catalog_partition(spark):
    path = scratch_path(spark, "raw-table")
    accounts = hand_made(spark)["account"]
    for batch in ("B-1", "B-2"):
        with_lineage(accounts, ACCOUNT, batch, ingested()).write.mode("append").partitionBy(raw.PARTITION).option(
            "path", path
        ).saveAsTable("raw_account_test")
    raw.drop_batch(spark, "raw_account_test", "B-2")
    assert spark.table("raw_account_test").count() == 11


def test_hash_recipe_and_null_positions(spark):
    rows = [customer(1, email=None, phone="x"), customer(1, email="", phone="x"), customer(1, email="x", phone=None)]
    hashes = [r.record_hash for r in with_lineage(frame(spark, "customer", rows), CUSTOMER, "B", ingested()).collect()]
    assert hashes[0] == hashes[1] != hashes[2]
    text = "1|CN-1|Name 1|1980-01-01||x|IN|VERIFIED|ACTIVE"
    assert hashes[0] == hashlib.sha256(text.encode()).hexdigest()


def test_hash_does_not_depend_on_partitioning(spark):
    rows = hand_made(spark)["transaction"]

    def hashes(df):
        stamped = with_lineage(df, TRANSACTION, "B", ingested())
        return {(r.source_record_key, r.record_hash) for r in stamped.collect()}

    assert hashes(rows.repartition(1)) == hashes(rows.repartition(7))


def test_csv_round_trip(spark):
    path = scratch_path(spark, "csv")
    rows = hand_made(spark)["transaction"]
    sinks.write_csv(rows, path)
    text = "\n".join(p.read_text() for p in local(path).glob("part-*.csv"))
    assert "True" in text and "False" in text and text.startswith("transaction_id,")
    assert sorted(read_csv(spark, TRANSACTION, path).collect()) == sorted(rows.collect())


def test_csv_empty_field_is_null(spark):
    path = scratch_path(spark, "csv")
    sinks.write_csv(frame(spark, "customer", [customer(1, email=None, address_line_1="")]), path)
    row = read_csv(spark, CUSTOMER, path).first()
    assert row.email is None and row.address_line_1 is None


def test_json_lines_have_sorted_keys(spark):
    path = scratch_path(spark, "jsonl")
    sinks.write_json_lines(hand_made(spark)["account"], path)
    lines = [line for p in local(path).glob("part-*.json") for line in p.read_text().splitlines()]
    assert len(lines) == 11
    keys = list(json.loads(lines[0]))
    assert keys == sorted(keys) and isinstance(json.loads(lines[0])["opened_date"], str)


def test_jdbc_options_cover_the_key_range():
    options = jdbc_options("jdbc:x", "core.account", "account_id", 0, 99, 4)
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("0", "100", "4")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "k", 5, 1, 4)
