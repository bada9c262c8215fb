"""Core gates, migration end to end, reconciliation and the shape of the physical plans."""

from __future__ import annotations

import re
from dataclasses import replace
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import RUN, frame, hand_made, layers, txn
from tidemark.checks.queries import QUERIES
from tidemark.functions.verdict import Check, GateFailure, check_rows, metrics, row_count
from tidemark.operators import constraints, keys
from tidemark.operators.balances import with_previous_closing
from tidemark.operators.rules import Lookup, attach, staging_gate
from tidemark.plans import core, migration, profile, reconcile
from tidemark.plans.migration import ORDER, migrate, roll_back
from tidemark.session import materialise, scratch_path
from tidemark.plans.ledger import Ledgers
from tidemark.sources import bank_views
from tidemark.sources.sinks import read_published

SMALL = "/root/testdata/sf0.001"


def statuses(checks):
    return {r.check_name: r.status for r in checks.collect()}


def test_migration_end_to_end(spark):
    root = scratch_path(spark, "migration")
    tables = migrate(hand_made(spark), RUN, root)
    assert {n: tables[n].count() for n in ORDER} == {
        "branch": 1, "customer": 4, "account": 5, "transaction": 4, "daily_balance": 2
    }
    assert spark.read.parquet(f"{root}/quarantine/transaction").count() == 10
    assert spark.read.parquet(f"{root}/raw/transaction").count() == 13
    checks = spark.read.parquet(f"{root}/reconciliation/transaction_reconciliation")
    assert checks.count() == 7 and checks.where("status = 'FAIL'").count() == 0
    assert spark.read.parquet(f"{root}/reconciliation/financial_reconciliation").count() == 12
    assert spark.read.parquet(f"{root}/reconciliation/constraint_audit").where("violations > 0").count() > 0
    positions = {r.source_table: r.last_watermark_key for r in Ledgers(spark, root).positions().collect()}
    assert positions["core.account"] == "11" and positions["finance.daily_account_balance"] == "3|2020-01-01"
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        migrate(hand_made(spark), RUN, root)


def test_interrupted_migration_resumes_without_repeating_finished_tables(spark, monkeypatch):
    root = scratch_path(spark, "migration")
    real = migration.publish

    def breaks(name, *rest, **more):
        if name == "transaction":
            raise OSError("lost connection")
        return real(name, *rest, **more)

    monkeypatch.setattr(migration, "publish", breaks)
    with pytest.raises(OSError):
        migrate(hand_made(spark), RUN, root)
    published = []
    monkeypatch.setattr(migration, "publish", lambda name, *rest, **more: published.append(name) or real(name, *rest, **more))
    tables = migrate(hand_made(spark), RUN, root, resume=True)
    assert published == ["transaction", "daily_balance"]
    assert tables["transaction"].count() == 4 and tables["account"].count() == 5
    assert spark.read.parquet(f"{root}/raw/transaction").count() == 13
    runs = Ledgers(spark, root).read("table_run")
    assert runs.count() == 6
    broken = runs.where("status = 'FAILED'").first()
    assert broken.table_name == "payments.bank_transaction" and broken.error_message == "OSError: lost connection"
    got = {r.table_name: (r.loaded_rows, r.rejected_rows) for r in runs.where("status = 'SUCCEEDED'").collect()}
    assert got["payments.bank_transaction"] == (13, 9)
    batches = Ledgers(spark, root)
    assert batches.batches().first().status == "SUCCEEDED"
    assert {r.status for r in batches.read("migration_batch").collect()} == {"RUNNING", "FAILED", "SUCCEEDED"}


def test_increments_and_rollback_rebuild_core(spark):
    root = scratch_path(spark, "migration")
    tables = hand_made(spark)
    migrate(tables, RUN, root)
    late = datetime(2020, 1, 2)
    changed = tables["customer"].withColumn("updated_at", F.when(F.col("customer_id") == 1, F.lit(late)).otherwise(F.col("updated_at")))
    changed = changed.withColumn("date_of_birth", F.when(F.col("customer_id") == 1, F.lit("1990-01-01").cast("date")).otherwise(F.col("date_of_birth")))
    second = replace(RUN, batch_id="B-2", ingested_at="2026-08-27 00:00:00")
    built = migrate({**tables, "customer": changed}, second, root, incremental=True)
    raw_rows = spark.read.parquet(f"{root}/raw/customer").groupBy("migration_batch_id").count().collect()
    assert {tuple(r) for r in raw_rows} == {("B-1", 10), ("B-2", 1)}  # one new version, nothing else
    assert built["customer"].count() == 5 and built["account"].count() == 6  # the customer and the account are valid now
    plan = migration.Migration({}, RUN, root, Ledgers(spark, root), True)
    back = roll_back(spark, RUN, root, "B-2", "wrong birth date")
    assert back["customer"].count() == 4 and back["account"].count() == 5
    assert read_published(spark, f"{root}/core/dim_customer").count() == 4
    shown = plan.visible_raw("customer")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*NOT \(migration_batch_id", shown)
    assert Ledgers(spark, root).positions().where("source_table = 'core.customer'").first().last_successful_batch_id == "B-1"


def test_second_full_batch_needs_the_newest_version_option(spark):
    root = scratch_path(spark, "migration")
    tables = hand_made(spark)
    migrate(tables, RUN, root)
    later = replace(RUN, batch_id="B-2", ingested_at="2026-08-27 00:00:00")
    with pytest.raises(GateFailure, match="duplicate_keys: 1"):
        migrate(tables, later, root)
    core_tables = migrate(tables, replace(later, batch_id="B-3"), root, newest_only=True)
    assert core_tables["transaction"].count() == 4
    assert core_tables["daily_balance"].count() == 2


def test_migration_stops_at_an_unaccounted_transaction(spark):
    tables = {**hand_made(spark), "transaction": frame(spark, "transaction", [txn(1, amount=None)])}
    with pytest.raises(GateFailure, match="raw=1, valid=0, rejected=0"):
        migrate(tables, RUN, scratch_path(spark, "migration"))


def test_failing_gate_leaves_the_published_table(spark):
    path = scratch_path(spark, "core")
    built = layers(spark)
    good = built.core("account")
    dims = {"customer": built.core("customer")}
    core.publish("account", good, good, dims, path)
    doubled = good.unionByName(good)
    with pytest.raises(GateFailure, match="duplicate_keys: 5"):
        core.publish("account", doubled, doubled, dims, path)
    assert read_published(spark, path).count() == 5


def test_a_writer_that_loses_a_row_or_breaks_leaves_the_published_table(spark):
    path = scratch_path(spark, "core")
    facts = materialise(layers(spark).core("transaction"), "facts")
    dims = {"account": layers(spark).core("account")}
    core.publish("transaction", facts, facts, dims, path)

    def loses(df, folder):
        df.where("transaction_id <> 12").write.parquet(folder)

    def breaks(df, folder):
        df.limit(1).write.parquet(folder)
        raise OSError("disk full")

    with pytest.raises(GateFailure, match="staging_core_difference: 1"):
        core.publish("transaction", facts, facts, dims, path, write=loses)
    with pytest.raises(OSError):
        core.publish("transaction", facts, facts, dims, path, write=breaks)
    assert read_published(spark, path).count() == facts.count() == 4


def test_core_gates_count_every_violation(spark):
    built = layers(spark)
    facts = built.core("transaction")
    none = built.core("account").where("FALSE")
    found = dict(core.core_gates("transaction", facts, facts.limit(1), {"account": none}).collect())
    assert found == {
        "duplicate_keys": 0,
        "missing_source_accounts": 4,
        "missing_destination_accounts": 4,
        "staging_core_difference": -3,
    }


def test_transaction_reconciliation_passes_and_notices_a_lost_row(spark):
    built = layers(spark)
    parts = [built.sources["transaction"], built.raw("transaction"), built.staging("transaction"),
             built.core("transaction"), built.rejected("transaction")]
    assert set(statuses(reconcile.reconcile_transactions(*parts, F.current_timestamp())).values()) == {"PASS"}
    parts[3] = parts[3].where("transaction_id <> 12")
    broken = statuses(reconcile.reconcile_transactions(*parts, F.current_timestamp()))
    assert {n for n, s in broken.items() if s == "FAIL"} == {
        "staging_vs_core_row_count", "staging_vs_core_amount", "raw_vs_core_plus_rejected_amount"
    }


def test_financial_reconciliation_has_twelve_checks(spark):
    built = layers(spark)
    checks = reconcile.reconcile_financials(
        built.sources["transaction"], built.sources["daily_balance"], built.raw("transaction"),
        built.raw("daily_balance"), built.core("daily_balance"), built.rejected("daily_balance"),
        F.current_timestamp(),
    )
    result = statuses(checks)
    assert len(result) == 12
    assert result["raw_balance_rows_vs_core_plus_rejected"] == "PASS"
    assert result["source_transaction_vs_debits"] == "FAIL"


def test_check_values_are_text_and_exact(spark):
    df = spark.createDataFrame([(Decimal("0.10"),), (Decimal("0.20"),)], "x decimal(18,2)")
    measured = metrics(df, n=row_count(), s=F.sum("x"))
    rows = check_rows(measured, [Check("count", ("n",), (2,)), Check("amount", ("s",), (), True)], F.lit(None))
    got = {r.check_name: (r.source_value, r.target_value, r.variance, r.status) for r in rows.collect()}
    assert got == {"count": ("2", "2", "0", "PASS"), "amount": ("0.30", "0.00", "0.30", "FAIL")}


def test_empty_tables_reconcile_to_zero(spark):
    built = layers(spark, transaction=frame(spark, "transaction", []))
    checks = reconcile.reconcile_transactions(
        built.sources["transaction"], built.raw("transaction"), built.staging("transaction"),
        built.core("transaction"), built.rejected("transaction"), F.current_timestamp(),
    )
    assert set(statuses(checks).values()) == {"PASS"}
    assert built.evaluated("transaction").transform(staging_gate).first().status == "PASS"
    assert profile.transaction_range(built.sources["transaction"]).first().transaction_total is None


def test_type_absent_from_core_counts_zero(spark):
    built = layers(spark)
    rows = {r.transaction_type: r for r in reconcile.compare_by_type(
        built.sources["transaction"], built.core("transaction")).collect()}
    assert (rows["GIFT"].source_rows, rows["GIFT"].core_rows, rows["GIFT"].core_amount) == (1, 0, Decimal("0.00"))


def test_constraint_audit(spark):
    tables = hand_made(spark)
    found = {(r.table_name, r.constraint_name): r.violations for r in constraints.audit_constraints(tables).collect()}
    assert found["core.branch", "status_enumeration"] == 1  # NULL passes a check
    assert found["core.branch", "status_not_null"] == 1
    assert found["core.branch", "primary_key"] == 1  # the NULL key
    assert found["core.account", "account_branch"] == 1
    assert found["core.account", "closed_after_opened"] == 1
    assert found["payments.bank_transaction", "transaction_destination_account"] == 1
    assert found["payments.bank_transaction", "accounts_differ"] == 1
    assert found["finance.daily_account_balance", "balance_equation"] == 1


def test_table_contract_reports_missing_and_changed_columns(spark):
    tables = hand_made(spark)
    tables["account"] = tables["account"].drop("status").withColumn("branch_id", F.col("branch_id").cast("int"))
    del tables["branch"]
    found = {(r.table_name, r.column_name): r.status for r in constraints.table_contract(tables).collect()}
    assert found["core.account", "status"] == "MISSING"
    assert found["core.account", "branch_id"] == "TYPE_MISMATCH"
    assert found["core.branch", "branch_id"] == "MISSING"
    assert found["core.customer", "email"] == "OK"


def test_key_operators_with_a_hot_key(spark):
    rows = [(7,)] * 3000 + [(i,) for i in range(6000)] + [(None,)] * 5
    child = spark.createDataFrame(rows, "k BIGINT")
    parent = spark.createDataFrame([(i,) for i in range(1, 6000) if i != 7], "id BIGINT")
    assert keys.orphan_count(child, "k", parent, "id").first()[0] == 3000 + 1 + 1 + 5
    assert tuple(keys.key_profile(child, "k").first()) == (9005, 6000, 5)
    assert keys.duplicate_key_count(child, "k").first()[0] == 2  # 7 and NULL group


def test_event_ledger_matches_the_published_probe(spark):
    folder = "/root/testdata/sf0.01"
    from tidemark.operators import balances as bal

    clean = bal.running_balances(bal.daily_movements(bank_views.event_transactions(spark, folder)))
    assert tuple(bal.failure_counts(clean).first()) == (4588, 0, 0)
    totals = profile.movement_totals(clean).first()
    assert totals.debit_total == totals.credit_total == Decimal("496306.57")
    assert tuple(bal.failure_counts(bank_views.with_broken_closings(clean)).first()) == (4588, 89, 86)
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    assert keys.duplicate_key_count(lines, "l_orderkey", "l_linenumber").first()[0] == 11785


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_transaction_rules_scan_raw_once(spark):
    """Besides passes over single keys, whose results are settled before."""
    plan = plan_of(QUERIES["rj13_20_pr8_quarantine_transaction"](spark, SMALL))
    assert len(re.findall(r"FileScan parquet .*lineitem\.parquet", plan)) == 1
    assert "Window" not in plan


def test_few_failing_keys_cost_the_wide_rows_no_exchange(spark):
    plan = plan_of(QUERIES["rj13_20_pr8_quarantine_transaction"](spark, SMALL))
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    assert not re.search(r"Exchange hashpartitioning\((source|destination)_account_id", plan)


@pytest.mark.parametrize("name", ["rj13_20_pr8_quarantine_transaction", "rj21_25_pr8_quarantine_daily_balance",
                                  "cp1_disposition_account", "ag12_double_entry_rollup", "jn8_transactions_missing_either_account"])
def test_plans_have_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    for unwanted in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_large_dimensions_are_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["rj13_20_pr8_quarantine_transaction"](spark, SMALL))
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def executed(df) -> str:
    """The final adaptive plan after running the query."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def eager_skew_splitting(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_foreign_key_is_split_over_tasks(spark, eager_skew_splitting):
    hot = spark.range(0, 60_000, 1, 8).selectExpr(
        "id AS transaction_id", "IF(id % 3 = 0, 1, id) AS source_account_id", "sha2(CAST(id AS STRING), 256) AS filler"
    )
    accounts = spark.range(2, 60_000, 1, 4).selectExpr("id AS account_id", "'ACTIVE' AS account_status")
    lookup = Lookup("source_account", "source_account_id", "account", "account_id")
    joined = attach(hot, lookup, accounts, materialise)  # the hot key is the one that is missing
    plan = executed(joined)
    assert "SortMergeJoin(skew=true)" in plan
    assert joined.where("source_account_found").count() == 39_999
    everyone = accounts.unionByName(accounts.limit(1).withColumn("account_id", F.lit(1).cast("bigint")))
    assert attach(hot, lookup, everyone, materialise).where("source_account_found").count() == 60_000


def test_hot_balance_day_is_split_over_tasks(spark, eager_skew_splitting):
    rows = spark.range(0, 60_000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 1, id % 20000) AS account_id",
        "date_add(DATE '2020-01-02', CAST(id % 2 AS INT)) AS business_date",
        "CAST(1 AS DECIMAL(18, 2)) AS opening_balance", "CAST(1 AS DECIMAL(18, 2)) AS closing_balance",
        "sha2(CAST(id AS STRING), 256) AS filler",
    )
    assert "SortMergeJoin(skew=true)" in executed(with_previous_closing(rows))


def test_copies_are_limited_before_the_shuffle(spark):
    rows = spark.range(0, 9_000, 1, 4).selectExpr("IF(id % 3 = 0, 1, id) AS k", "id AS v")
    kept = keys.first_per_key(rows, ["k"], F.col("v").desc())
    plan = plan_of(kept)
    assert plan.index("Final") < plan.index("Exchange") < plan.rindex("Partial")
    assert kept.where("k = 1").first().v == 8997
