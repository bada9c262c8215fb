"""Hand-made rows against the expected verdicts, including the three-valued corner cases."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fixtures import RUN, frame, hand_made, layers, txn
from tidemark.operators.rulebook import SOURCE_CUSTOMER_BOOK, SOURCE_TRANSACTION_BOOK
from tidemark.operators.rules import (
    disposition,
    disposition_summary,
    evaluate,
    rule_summary,
    staging_gate,
    table_summary,
)


def rejected(built, name):
    rows = built.rejected(name).select("source_record_key", "rule_id").collect()
    return sorted((r.source_record_key, r.rule_id) for r in rows)


def valid(built, name, key):
    return sorted((r[0] for r in built.staging(name).select(key).collect()), key=str)


def test_branch_rules(spark):
    built = layers(spark)
    assert rejected(built, "branch") == [
        ("2", "BRANCH_CODE_REQUIRED"),
        ("3", "BRANCH_NAME_REQUIRED"),
        ("4", "BRANCH_OPENED_DATE_REQUIRED"),
        ("5", "BRANCH_STATUS_REFERENCE"),
    ]
    assert valid(built, "branch", "branch_id") == [1]


def test_customer_rules(spark):
    built = layers(spark)
    assert rejected(built, "customer") == [
        ("1", "CUSTOMER_DOB_NOT_FUTURE"),
        ("2", "CUSTOMER_EMAIL_FORMAT"),
        ("3", "CUSTOMER_EMAIL_FORMAT"),
        ("4", "CUSTOMER_EMAIL_FORMAT"),
        ("9", "CUSTOMER_DOB_NOT_FUTURE"),
        ("9", "CUSTOMER_EMAIL_FORMAT"),
    ]
    assert valid(built, "customer", "customer_id") == [10, 5, 6, 8]


def test_account_rules_and_overlap(spark):
    built = layers(spark)
    assert rejected(built, "account") == [
        ("3", "ACCOUNT_CUSTOMER_REFERENCE"),
        ("4", "ACCOUNT_CURRENCY_REFERENCE"),
        ("5", "ACCOUNT_DATE_RANGE"),
        ("6", "ACCOUNT_TYPE_REFERENCE"),
        ("7", "ACCOUNT_STATUS_REFERENCE"),
        ("8", "ACCOUNT_BRANCH_REFERENCE"),
    ]
    assert valid(built, "account", "account_id") == [1, 10, 2, 8, 9]
    kinds = dict(built.evaluated("account").select("account_id", disposition()).collect())
    assert kinds[8] == "BOTH" and kinds[11] == "UNACCOUNTED" and kinds[1] == "VALID" and kinds[4] == "REJECTED"


def test_transaction_rules(spark):
    built = layers(spark)
    assert rejected(built, "transaction") == [
        ("1", "TRANSACTION_CURRENCY_REFERENCE"),
        ("10", "TRANSACTION_CHANNEL_REFERENCE"),
        ("11", "TRANSACTION_DESTINATION_ACCOUNT_REFERENCE"),
        ("2", "CLOSED_ACCOUNT_TRANSACTION"),
        ("5", "TRANSACTION_SOURCE_ACCOUNT_REFERENCE"),
        ("6", "TRANSACTION_CURRENCY_REFERENCE"),
        ("6", "TRANSACTION_TYPE_REFERENCE"),
        ("7", "TRANSACTION_TYPE_REFERENCE"),
        ("8", "TRANSACTION_AMOUNT_POSITIVE"),
        ("9", "TRANSACTION_ACCOUNTS_DIFFER"),
    ]
    assert valid(built, "transaction", "transaction_id") == [12, 13, 3, 4]
    gate = built.evaluated("transaction").transform(staging_gate).first()
    assert tuple(gate) == (13, 4, 9, 10, "PASS")


def test_balance_rules(spark):
    built = layers(spark)
    assert rejected(built, "daily_balance") == [
        ("1|2020-01-02", "BALANCE_EQUATION"),
        ("1|2020-01-03", "BALANCE_ROLL_FORWARD"),
        ("2|2020-01-01", "BALANCE_DEBIT_NON_NEGATIVE"),
        ("2|2020-01-02", "BALANCE_CREDIT_NON_NEGATIVE"),
        ("3|2020-01-01", "BALANCE_ACCOUNT_REFERENCE"),
    ]


@pytest.mark.parametrize("column", ["amount", "currency_code", "transaction_type", "payment_channel"])
def test_null_in_a_compared_column_is_unaccounted_and_fails_the_gate(spark, column):
    row = txn(1, **{column: None}) if column != "amount" else txn(1, amount=None)
    built = layers(spark, transaction=frame(spark, "transaction", [row]))
    assert built.rejected("transaction").count() == 0
    assert built.staging("transaction").count() == 0
    assert built.evaluated("transaction").transform(staging_gate).first().status == "FAIL"
    assert built.evaluated("transaction").transform(disposition_summary).first().disposition == "UNACCOUNTED"


def test_duplicate_dimension_keys_do_not_multiply_transactions(spark):
    tables = hand_made(spark)
    doubled = tables["account"].unionByName(tables["account"])
    assert rejected(layers(spark, account=doubled), "transaction") == rejected(layers(spark), "transaction")


def test_quarantine_layout_and_payload(spark):
    built = layers(spark)
    row = built.rejected("transaction").where("rule_id = 'CLOSED_ACCOUNT_TRANSACTION'").first()
    assert built.rejected("transaction").columns == [
        "migration_batch_id", "source_system", "source_table", "source_record_key", "rule_id", "severity",
        "error_message", "raw_payload", "rejected_at", "resolution_status",
    ]
    assert (row.severity, row.resolution_status) == ("HIGH", "OPEN")
    payload = json.loads(row.raw_payload)
    assert list(payload) == [
        "transaction_id", "source_account_id", "destination_account_id", "transaction_ts", "transaction_type",
        "amount", "currency_code", "payment_channel", "aml_flag",
    ]
    assert payload["transaction_ts"] == "2020-05-05 12:00:00+00"
    null_kept = built.rejected("account").where("source_record_key = '4'").first()
    assert json.loads(null_kept.raw_payload)["closed_date"] is None


def test_rule_rows_equal_the_sum_of_rule_counts(spark):
    for name in ("branch", "customer", "account", "transaction", "daily_balance"):
        quarantined = layers(spark).rejected(name)
        assert quarantined.transform(rule_summary).agg(F.sum("failures")).first()[0] == quarantined.count()


def test_source_side_rules(spark):
    tables = hand_made(spark)
    customers = evaluate(tables["customer"], SOURCE_CUSTOMER_BOOK, {}, RUN.today())
    assert customers.where("failed_rules <> 0").count() == 5
    checked = evaluate(
        tables["transaction"], SOURCE_TRANSACTION_BOOK, {"account": tables["account"]}, RUN.today()
    )
    late = [r.transaction_id for r in checked.where("failed_rules & 2 <> 0").collect()]
    assert late == [2]
    assert layers(spark).rejected("branch").transform(table_summary).count() == 2
