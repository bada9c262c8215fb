"""Merged profiles against the exact ones over all batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures import hand_made
from tidemark.plans.summaries import DISTINCT_ERROR, RANK_ERROR, merged_profile, store_summary
from tidemark.schemas import CUSTOMER, TRANSACTION
from tidemark.session import scratch_path

COLUMNS = ["transaction_id", "source_account_id", "transaction_ts", "transaction_type", "amount"]


def test_merged_batches_profile_like_the_whole(spark):
    root = scratch_path(spark, "landing")
    rows = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id"), F.lit(7000))).alias("source_account_id"),
        F.timestamp_seconds(F.col("id") * 1000).alias("transaction_ts"),
        F.concat(F.lit("T"), (F.col("id") % 4).cast("string")).alias("transaction_type"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**6)) / 100 - 50).cast("decimal(18,2)").alias("amount"),
    )
    for i in range(3):
        store_summary(rows.where(F.col("transaction_id") % 3 == i), TRANSACTION, root, f"B-{i}", COLUMNS)
    found = {r.column_name: r for r in merged_profile(spark, TRANSACTION, root, ["B-0", "B-1", "B-2"], (0.1, 0.5, 0.99)).collect()}
    assert found.keys() == set(COLUMNS)
    for c in COLUMNS:
        n, nulls, least, greatest, distinct = rows.agg(F.count("*"), F.count_if(F.col(c).isNull()), F.min(c), F.max(c), F.count_distinct(c)).first()
        r = found[c]
        assert (r.row_count, r.nulls) == (n, nulls)
        assert least in (r.least.number, r.least.instant, r.least.text) and greatest in (r.greatest.number, r.greatest.instant, r.greatest.text)
        assert abs(r.distinct_values - distinct) <= DISTINCT_ERROR * distinct + 1
    values = sorted(float(r.amount) for r in rows.select("amount").collect())
    for q, name in ((0.1, "p10"), (0.5, "p50"), (0.99, "p99")):
        below = sum(v <= found["amount"][name] for v in values) / len(values)
        assert abs(below - q) <= RANK_ERROR + 0.001
    assert found["transaction_type"].p50 is None and found["transaction_ts"].p50 is None
    part = {r.column_name: r.row_count for r in merged_profile(spark, TRANSACTION, root, ["B-1"]).collect()}
    assert set(part.values()) == {20_000}


def test_every_column_of_a_table_and_empty_batches(spark):
    root, customers = scratch_path(spark, "landing"), hand_made(spark)["customer"]
    store_summary(customers, CUSTOMER, root, "B-1")
    store_summary(customers.limit(0), CUSTOMER, root, "B-2")
    found = {r.column_name: r for r in merged_profile(spark, CUSTOMER, root, ["B-1", "B-2"]).collect()}
    assert found.keys() == set(CUSTOMER.columns) and {r.row_count for r in found.values()} == {10}
    empty = merged_profile(spark, CUSTOMER, root, ["B-2"]).where("column_name = 'customer_id'").first()
    assert (empty.row_count, empty.nulls, empty.least.number, empty.p50) == (0, 0, None, None)
