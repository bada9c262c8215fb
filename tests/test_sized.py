"""Steps that must not grow faster than their input: what travels, what is written, and how tasks are cut."""

from __future__ import annotations

import re
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from fixtures import RUN, balance, frame, hand_made, layers
from tidemark.checks import queries
from tidemark.checks.queries import QUERIES
from tidemark.operators import balances as bal
from tidemark.operators.rulebook import BOOKS
from tidemark.operators.rules import accepted, evaluate, is_rejected, quarantine, quarantine_keys
from tidemark.plans import core, migration, profile, reconcile
from tidemark.plans.ledger import table_runs
from tidemark.plans.store import Store
from tidemark.session import INITIAL_PARTITIONS, SIZED_SETTINGS, materialise, scratch_path, sized_for
from tidemark.sources import bank_views, landing

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def unsized(spark):
    yield
    for key in (INITIAL_PARTITIONS, *SIZED_SETTINGS):
        spark.conf.unset(key)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reduce_tasks_grow_with_the_files(spark):
    path = scratch_path(spark, "large")
    spark.range(1_500_000).selectExpr("uuid() AS u").write.option("compression", "none").parquet(path)
    sized_for(spark, [f"{SMALL}/nation.parquet", f"{SMALL}/missing.parquet"])
    assert int(spark.conf.get(INITIAL_PARTITIONS)) == 4  # the session's own number
    sized_for(spark, [path])
    assert 20 <= int(spark.conf.get(INITIAL_PARTITIONS)) <= 60


def test_grouped_balances_are_chained_without_a_join(spark):
    plan = planned(QUERIES["pr6_vf5_staging_daily_balance"](spark, SMALL))
    assert "p_date" not in plan and not re.search(r"Join[^\n]*business_date", plan)


@pytest.mark.parametrize("name", ["wn2_roll_forward_failures", "ag12_double_entry_rollup", "rj21_25_pr8_quarantine_daily_balance"])
def test_legs_travel_once_and_by_account_alone(spark, name):
    plan = planned(QUERIES[name](spark, SMALL))
    by_account = re.findall(r"Exchange hashpartitioning\(([^\n]*), \d+\), (\w+)", plan.split("Initial Plan")[-1])
    dimension = ["ENSURE_REQUIREMENTS"] if "quarantine" in name else []
    assert sorted(kind for keys, kind in by_account if keys.startswith("account_id")) == [*dimension, "REPARTITION_BY_COL"]
    assert not [keys for keys, _ in by_account if "business_date" in keys]


@pytest.mark.parametrize("name", ["rj21_25_pr8_quarantine_daily_balance", "wn2_core_roll_forward_failures", "so3_ordered_balances"])
def test_legs_are_sorted_once_and_summed_as_they_pass(spark, name):
    plan = planned(QUERIES[name](spark, SMALL)).split("Initial Plan")[-1]
    assert len(re.findall(r"SortAggregate\(key=\[account_id#\w+, business_date#\w+\]", plan)) == 1
    assert not re.search(r"HashAggregate\(key[^\n]*business_date", plan)
    assert len(re.findall(r"Sort \[account_id#\w+ ASC NULLS FIRST, business_date#\w+ ASC NULLS FIRST\], false", plan)) == 1


def test_sorted_and_hashed_sums_of_days_agree(spark):
    rows = spark.range(0, 20_000, 1, 5).selectExpr(
        "IF(id % 11 = 0, NULL, id % 300) AS source_account_id", "IF(id % 3 = 1, 1, id % 700) AS destination_account_id",
        "IF(id % 13 = 0, NULL, timestampadd(HOUR, CAST(id % 500 AS INT), TIMESTAMP '2020-01-01 10:00:00')) AS transaction_ts",
        "IF(id % 30 = 0, NULL, CAST(id % 1000 - 300.25 AS DECIMAL(18, 2))) AS amount",
    )
    hashed = sorted(map(str, bal.daily_balances(rows).collect()))
    sized_for(spark, [])
    assert "SortAggregate" in planned(bal.daily_balances(rows))
    assert sorted(map(str, bal.daily_balances(rows).collect())) == hashed


def test_days_of_a_hot_account_are_summed(spark):
    rows = spark.range(0, 90_000, 1, 6).selectExpr(
        "IF(id % 3 = 0, 1, id + 2) AS source_account_id", "IF(id % 3 = 1, 1, NULL) AS destination_account_id",
        "timestampadd(DAY, CAST(id % 5 AS INT), TIMESTAMP '2020-01-01 10:00:00') AS transaction_ts",
        "IF(id % 30 = 0, NULL, CAST(0.25 AS DECIMAL(18, 2))) AS amount",
    )
    moved = bal.daily_movements(rows)
    hot = moved.where("account_id = 1").orderBy("business_date").selectExpr("CAST(debit_total AS STRING)", "CAST(credit_total AS STRING)")
    assert [tuple(r) for r in hot.collect()] == [("750.00", "1500.00"), *[("1500.00", "1500.00")] * 4]
    assert moved.where("account_id IS NULL").selectExpr("sum(credit_total)").first()[0] == 14250
    assert moved.where("debit_total IS NULL").count() == 0


def test_a_day_of_unknown_amounts_has_no_total(spark):
    day = spark.sql("SELECT 1L AS source_account_id, 2L AS destination_account_id, TIMESTAMP '2020-01-01 10:00:00' AS transaction_ts, "
                    "CAST(NULL AS DECIMAL(18, 2)) AS amount")  # fmt: skip
    found = {r.account_id: (r.debit_total, r.credit_total) for r in bal.daily_movements(day).collect()}
    assert found == {1: (None, 0), 2: (0, None)}


@pytest.mark.parametrize("name", ["pr5_vf4_staging_transaction", "pr6_vf5_staging_daily_balance"])
def test_hashes_are_made_after_the_joins(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = planned(QUERIES[name](spark, SMALL)).split("Initial Plan")[-1].splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    hashes = [i for i, line in enumerate(lines) if re.search(r"sha2?\(", line)]
    assert hashes and exchanges and max(hashes) < min(exchanges)


def test_chain_by_key_equals_the_general_one_on_unique_keys(spark):
    rows = [balance(a, date(2020, 1, d), "5.00", "0.00", "0.00", f"{(a or 3) + d}.00") for a in (1, 2, None) for d in (1, 2, 5)]
    df = frame(spark, "daily_balance", [*rows, balance(1, None, "5.00", "0.00", "0.00", "9.00")])
    chained = [sorted(map(str, f(df).collect())) for f in (bal.with_previous_closing, bal.with_previous_closing_by_key)]
    assert chained[0] == chained[1]


def joins(node):
    found = [node] if node.nodeName() == "Join" else []
    for i in range(node.children().size()):
        found += joins(node.children().apply(i))
    return found


def test_what_a_row_tells_alone_is_judged_before_the_lookups(spark):
    """Reports on verdicts send no texts through the joins, and rows that cannot be accepted do not reach them."""
    rows = bank_views.transactions(spark, SMALL)
    accounts = layers(spark).core("account")
    evaluated = evaluate(rows, BOOKS["transaction"], {"account": accounts}, RUN.today())
    keys = quarantine_keys(evaluated.withColumn("source_record_key", F.col("transaction_id")), BOOKS["transaction"])
    wide = [j.left() for j in joins(keys._jdf.queryExecution().optimizedPlan()) if "early_failed" in j.left().output().mkString(",")]
    sent = {re.sub(r"#.*", "", a) for w in wide for a in w.output().mkString(",").split(",")}
    assert wide and not sent & {"transaction_type", "payment_channel", "currency_code"}
    few = accepted(evaluated).select("transaction_id")._jdf.queryExecution().optimizedPlan()
    below = [j.left().toString() for j in joins(few) if "transaction_id" in j.left().output().mkString(",")]
    assert below and all("MOBILE" in b and "Filter" in b for b in below)


def test_early_and_late_rules_make_the_mask_of_one_pass(spark):
    evaluated = layers(spark).evaluated("transaction")
    bits = {r.rule_id: 1 << i for i, r in enumerate(BOOKS["transaction"].rules)}
    alone = {k: v for k, v in bits.items() if k in ("TRANSACTION_AMOUNT_POSITIVE", "TRANSACTION_CURRENCY_REFERENCE", "TRANSACTION_ACCOUNTS_DIFFER")}
    for row in evaluated.collect():
        expected = {
            "TRANSACTION_AMOUNT_POSITIVE": row.amount is not None and row.amount <= 0,
            "TRANSACTION_CURRENCY_REFERENCE": row.currency_code is not None and row.currency_code != "INR",
            "TRANSACTION_ACCOUNTS_DIFFER": row.source_account_id is not None and row.source_account_id == row.destination_account_id,
        }
        assert {k: bool(row.failed_rules & bit) for k, bit in alone.items()} == expected


def test_source_balances_are_derived_once(spark, monkeypatch):
    """The ledger and the reconciliation count them while they pass into the verdicts; the checks find what a table tells."""
    derived = []
    real = bank_views.daily_balances
    monkeypatch.setattr(bank_views, "daily_balances", lambda rows: derived.append(rows) or real(rows))
    for name in ("rp5_reconcile_financials", "in5_table_run_ledger"):
        result = QUERIES[name](spark, SMALL)
        assert "REPARTITION_BY_COL" not in planned(result)
    assert len(derived) == 2


def test_a_profile_reads_the_balances_in_one_pass(spark, monkeypatch):
    derived, kept = [], []
    real = bank_views.daily_balances
    monkeypatch.setattr(bank_views, "daily_balances", lambda rows: derived.append(rows) or real(rows))
    monkeypatch.setattr(bank_views, "materialise", lambda *a: kept.append(a) or materialise(*a))
    plan = planned(QUERIES["rp1_source_profile"](spark, SMALL)).split("Initial Plan")[-1]
    assert len(derived) == 1 and not kept and plan.count("REPARTITION_BY_COL") == 1


def test_profiles_of_keyed_and_other_balances_agree(spark):
    tables = hand_made(spark)
    lines = [sorted(map(str, profile.source_profile(tables, keyed).collect())) for keyed in (True, False)]
    assert lines[0] == lines[1] and len(lines[0]) == 17


def test_whole_verdicts_send_no_texts_through_the_lookups(spark):
    rows = bank_views.transactions(spark, SMALL)
    evaluated = evaluate(rows, BOOKS["transaction"], {"account": layers(spark).core("account")}, RUN.today())
    plan = evaluated.select("transaction_id", "is_valid", "failed_rules")._jdf.queryExecution().optimizedPlan()
    wide = [j.left() for j in joins(plan) if "early_failed" in j.left().output().mkString(",")]
    sent = {re.sub(r"#.*", "", a) for w in wide for a in w.output().mkString(",").split(",")}
    assert wide and "early_valid" in sent and not sent & {"transaction_type", "payment_channel", "currency_code"}


def test_early_and_late_conditions_make_the_verdict_of_one_pass(spark):
    built = layers(spark)
    for name in ("account", "transaction"):
        book = BOOKS[name]
        at_once = replace(book, prepare=lambda rows: rows)  # judges nothing before the lookups
        dimensions = {k.dimension: built.core(k.dimension) for k in book.lookups}
        found = [
            sorted(map(str, evaluate(built.raw(name), b, dimensions, RUN.today()).select("source_record_key", "is_valid", "failed_rules").collect()))
            for b in (book, at_once)
        ]
        assert found[0] == found[1] and "is_valid=True" in str(found[0]) and "is_valid=False" in str(found[0])


def test_gates_keep_only_what_is_looked_up_of_their_parents(spark, monkeypatch):
    kept = []
    for module in (migration, queries):
        monkeypatch.setattr(module, "materialise", lambda df, *a: kept.append(df.columns) or materialise(df, *a))
    QUERIES["gt2_core_gates_transaction"](spark, SMALL)
    parents = [sorted(c) for c in kept if "account_id" in c and "transaction_id" not in c]
    assert parents == [["account_id", "account_status", "closed_date"]]


def test_rejected_records_from_verdicts_are_those_of_a_quarantine(spark):
    """Copies of a rejected key count with all their rows, and rows without an id are one record."""
    rows = [(1, "5.00", 1), (1, "7.00", 0), (2, "1.00", 0), (3, None, 4), (None, "2.00", 1), (None, "3.00", 0)]
    judged = spark.createDataFrame(rows, "transaction_id LONG, amount STRING, failed_rules LONG").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    found = reconcile.rejected_by_key(judged, "transaction_id").first()
    assert (found.rejected_records, str(found.rejected_amount)) == (3, "17.00")
    none = reconcile.rejected_by_key(judged.where("failed_rules = 0"), "transaction_id").first()
    assert (none.rejected_records, none.rejected_amount) == (0, 0)


def test_rejected_transactions_travel_once(spark):
    plan = planned(QUERIES["rp2_fn15_reconcile_transactions"](spark, SMALL)).split("Initial Plan")[-1]
    assert "Join" not in plan and len(re.findall(r"Exchange hashpartitioning\(transaction_id", plan)) == 1


@pytest.mark.parametrize("name", ["io3_empty_extract_guard", "gt3_verify_source", "gt3_counts_against_the_manifest"])
def test_balances_are_written_once_for_a_landing(spark, monkeypatch, name):
    derived, kept = [], []
    real = bank_views.daily_balances
    monkeypatch.setattr(bank_views, "daily_balances", lambda rows: derived.append(rows) or real(rows))
    monkeypatch.setattr(bank_views, "materialise", lambda *a: kept.append(a) or materialise(*a))
    plan = planned(QUERIES[name](spark, SMALL))
    assert len(derived) == 1 and not kept and "REPARTITION_BY_COL" not in plan


def test_observed_totals_stand_for_the_source_balances(spark):
    tables, built = hand_made(spark), layers(spark)
    figures = tables["daily_balance"].agg(*reconcile.balance_totals().values()).first().asDict()
    rest = (built.raw("transaction"), built.raw("daily_balance"), built.core("daily_balance"), built.rejected("daily_balance"))
    results = [
        reconcile.reconcile_financials(tables["transaction"], told, *rest, F.lit(None)).collect()
        for told in (tables["daily_balance"], figures, figures | {"source_balances": figures["source_balances"] + 1})
    ]
    assert results[0] == results[1]
    changed = {a.check_name for a, b in zip(results[1], results[2], strict=True) if a != b}
    assert changed == {"source_vs_raw_balance_count"}


def test_a_ledger_takes_numbers_of_rows(spark):
    tables = {"branch": hand_made(spark)["branch"]}
    rows, none = tables["branch"].count(), {"branch": spark.createDataFrame([], "source_record_key STRING")}
    at = F.lit("2020-01-01 00:00:00")
    found = [table_runs("B-1", t, t, tables, none, at, at).collect() for t in (tables, {"branch": rows}, {"branch": rows + 1})]
    assert found[0] == found[1] and [r.status for runs in found for r in runs] == ["SUCCEEDED", "SUCCEEDED", "FAILED"]


def test_gates_take_the_number_of_staged_rows(spark):
    built = layers(spark)
    rows = built.core("transaction")
    found = core.core_gates("transaction", rows.select(*core.gate_columns("transaction")), rows.count() + 1, {"account": built.core("account")})
    assert {r.gate: r.violations for r in found.collect()}["staging_core_difference"] == 1


@pytest.mark.parametrize("name", ["branch", "customer", "account", "transaction", "daily_balance"])
def test_quarantine_keys_are_those_of_the_quarantine(spark, name):
    evaluated = layers(spark).evaluated(name)
    whole = quarantine(evaluated, BOOKS[name], F.current_timestamp()).select("source_record_key", "rule_id")
    few = evaluated.select("source_record_key", "is_valid", "failed_rules")
    assert sorted(quarantine_keys(few, BOOKS[name]).collect()) == sorted(whole.collect())
    assert evaluated.where(is_rejected()).count() > 0 or name == "daily_balance"


def test_names_of_files_are_made_per_file(spark):
    path = scratch_path(spark, "landed")
    spark.range(0, 1000, 1, 3).write.parquet(path)
    counted = landing.file_rows(spark.read.parquet(path), path)
    assert "substring_index" not in planned(counted)  # no projection of rows makes it; results of groups are not shown
    names = {r.file_name for r in landing.file_checksums(spark, path).collect()}
    rows = counted.collect()
    assert {r.file_name for r in rows} == names and len(rows) == 3 and sum(r.file_row_count for r in rows) == 1000


def test_checksums_do_not_depend_on_the_cores_that_are_up(spark, monkeypatch):
    folder = scratch_path(spark, "orders")
    spark.read.parquet(f"{SMALL}/orders.parquet").repartition(6).write.parquet(f"{folder}/orders.parquet")
    real = landing.land

    def land(*args, **more):
        manifest = real(*args, **more)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")  # later scans are cut in another way
        return manifest

    monkeypatch.setattr(landing, "land", land)
    try:
        assert QUERIES["io6_file_checksums"](spark, folder).first().changed_files == 1
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_large_bucket_is_dealt_over_several_files(spark):
    store = Store(spark, scratch_path(spark, "store"), buckets=1)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2000")
    try:
        rows = layers(spark).evaluated("account").drop("is_valid", "failed_rules")
        many = rows.crossJoin(spark.range(2000)).withColumn("account_id", F.col("account_id") * 10000 + F.col("id")).drop("id")
        folder, _ = store._write(many.repartition(8), "evaluated", "account", F.lit(0))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.read.parquet(folder).select("_metadata.file_path").distinct().count() > 1
