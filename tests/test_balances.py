"""Derived balances and roll-forward against brute force, including hot accounts and repeated days."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

from fixtures import balance, frame, txn
from tidemark.operators import balances as bal


def random_transactions(n: int, hot: int = 7) -> list[dict]:
    rng = random.Random(5)
    rows = []
    for i in range(n):
        source = hot if i % 3 == 0 else rng.randrange(40)  # one account takes part in a third of all rows
        other = (source + 1 + rng.randrange(30)) % 41
        at = datetime(2020, 1, 1) + timedelta(hours=rng.randrange(24 * 60))
        rows.append(txn(i, source, other, f"{rng.randrange(1, 10_000) / 100:.2f}", transaction_ts=at))
    return rows


def brute_force(rows: list[dict]) -> dict:
    moves = defaultdict(lambda: [Decimal(0), Decimal(0)])
    for r in rows:
        day = r["transaction_ts"].date()
        moves[r["source_account_id"], day][0] += r["amount"]
        moves[r["destination_account_id"], day][1] += r["amount"]
    result = {}
    for account in {a for a, _ in moves}:
        opening = Decimal(10000 + 100 * account)
        for day in sorted(d for a, d in moves if a == account):
            debit, credit = moves[account, day]
            closing = opening + credit - debit
            result[account, day] = (opening, debit, credit, closing)
            opening = closing
    return result


def test_daily_balances_equal_brute_force_with_a_hot_account(spark):
    rows = random_transactions(2000)
    derived = bal.daily_balances(frame(spark, "transaction", rows)).collect()
    got = {
        (r.account_id, r.business_date): (r.opening_balance, r.debit_total, r.credit_total, r.closing_balance)
        for r in derived
    }
    assert got == brute_force(rows)
    assert derived[0].created_at.strftime("%H:%M") == "23:59"


def test_derived_balances_hold_both_identities(spark):
    derived = bal.daily_balances(frame(spark, "transaction", random_transactions(500)))
    counts = bal.failure_counts(derived).first()
    assert (counts.equation_failures, counts.roll_forward_failures) == (0, 0)
    assert bal.failure_counts(derived, unique=True).first() == counts


def test_previous_closing_equals_lag_on_unique_keys(spark):
    rng = random.Random(3)
    days = [date(2020, 1, 1) + timedelta(days=i) for i in range(60)]
    rows = [
        balance(a, d, f"{rng.randrange(9)}.00", "0.00", "0.00", f"{rng.randrange(9)}.00")
        for a in range(8) for d in days if rng.random() < 0.7
    ]
    df = frame(spark, "daily_balance", rows)

    def keyed(chained):
        return {(r.account_id, r.business_date): r.previous_closing_balance for r in chained.collect()}

    expected, last = {}, {}
    for r in sorted(rows, key=lambda r: (r["account_id"], r["business_date"])):
        expected[r["account_id"], r["business_date"]] = last.get(r["account_id"])
        last[r["account_id"]] = r["closing_balance"]
    assert keyed(bal.with_previous_closing(df)) == expected
    assert keyed(bal.with_previous_closing_unique(df)) == expected


def test_repeated_days_take_the_latest_version_and_keep_every_row(spark):
    versions = [
        (date(2020, 1, 1), "10.00", datetime(2020, 2, 1)),
        (date(2020, 1, 1), "20.00", datetime(2020, 3, 1)),
        (date(2020, 1, 2), "30.00", datetime(2020, 2, 1)),
        (date(2020, 1, 2), "30.00", datetime(2020, 2, 1)),
    ]
    rows = [balance(1, d, "0.00", "0.00", "0.00", c, updated_at=u) for d, c, u in versions]
    df = frame(spark, "daily_balance", rows).selectExpr(
        "*", "updated_at AS source_updated_at", "updated_at AS ingested_at", "'h' AS record_hash"
    )
    previous = [r.previous_closing_balance for r in bal.with_previous_closing(df).orderBy("business_date").collect()]
    assert previous == [None, None, Decimal("20.00"), Decimal("20.00")]


def test_one_account_with_a_third_of_all_rows_on_one_day(spark):
    copies = [balance(1, date(2020, 1, 2), "5.00", "0.00", "0.00", "5.00") for _ in range(3000)]
    others = [balance(a, date(2020, 1, 1), "5.00", "0.00", "0.00", "5.00") for a in range(1, 6001)]
    df = frame(spark, "daily_balance", copies + others)
    counts = bal.failure_counts(df).first()
    assert (counts.balance_rows, counts.roll_forward_failures) == (9000, 0)
    assert bal.with_previous_closing(df).where("previous_closing_balance IS NOT NULL").count() == 3000
