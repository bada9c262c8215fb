"""Hand-made bank rows; each comment says what the row is there for."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.plans.migration import Layers, Run
from tidemark.schemas import ENTITIES

RUN = Run("B-1", "2026-07-27 00:00:00", "2026-07-28 00:00:00", "2026-07-26")
AT = datetime(2020, 1, 1)
OPENED = date(2019, 1, 1)


def frame(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    """Rows of one entity; columns that are not given are NULL, the stamps default to a fixed instant."""
    fields = ENTITIES[name].schema.fields
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
    filled = [
        tuple(r.get(f.name, AT if f.name in ("created_at", "updated_at") else None) for f in fields) for r in rows
    ]
    return spark.createDataFrame(filled, schema)


def branch(i, **k):
    base = dict(branch_id=i, branch_code=f"NB-{i}", branch_name=f"Branch {i}", city="c", state="s",
                operating_region="north", opened_date=OPENED, status="ACTIVE")
    return base | k


def customer(i, **k):
    base = dict(customer_id=i, customer_number=f"CN-{i}", full_name=f"Name {i}", date_of_birth=date(1980, 1, 1),
                email=f"a_{i}@b.com", phone="1", country_code="IN", kyc_status="VERIFIED", customer_status="ACTIVE")
    return base | k


def account(i, customer_id=10, **k):
    base = dict(account_id=i, account_number=f"AC-{i}", customer_id=customer_id, branch_id=1, account_type="SAVINGS",
                currency_code="INR", opened_date=OPENED, status="ACTIVE")
    return base | k


def txn(i, source=1, destination=2, amount="10.00", **k):
    base = dict(transaction_id=i, source_account_id=source, destination_account_id=destination,
                transaction_ts=datetime(2020, 5, 5, 12), transaction_type="TRANSFER",
                amount=None if amount is None else Decimal(amount), currency_code="INR", payment_channel="ATM",
                aml_flag=False)
    return base | k


def balance(account_id, day, opening, debit, credit, closing, **k):
    base = dict(account_id=account_id, business_date=day, opening_balance=Decimal(opening), debit_total=Decimal(debit),
                credit_total=Decimal(credit), closing_balance=Decimal(closing))
    return base | k


def hand_made(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "branch": frame(spark, "branch", [
            branch(1),
            branch(2, branch_code="  "),
            branch(3, branch_name=None),
            branch(4, opened_date=None),
            branch(5, status="SUSPENDED"),
            branch(6, status=None),  # neither valid nor rejected
            branch(None),  # neither valid nor rejected
        ]),
        "customer": frame(spark, "customer", [
            customer(1, date_of_birth=date(2027, 7, 26)),  # born after the run
            customer(2, email="invalid-email"),
            customer(3, email="@b.c"),  # no local part
            customer(4, email="a@b."),  # nothing behind the dot
            customer(5, email="a_b@c.d"),
            customer(6, email=None),
            customer(7, date_of_birth=None),  # neither valid nor rejected
            customer(8, date_of_birth=date(2026, 7, 26)),  # born on the day of the run
            customer(9, date_of_birth=date(2030, 1, 1), email="x"),  # fails both rules
            customer(10),
        ]),
        "account": frame(spark, "account", [
            account(1), account(2),
            account(3, customer_id=1),  # its customer was rejected
            account(4, currency_code="USD"),
            account(5, status="CLOSED", closed_date=date(2018, 1, 1)),
            account(6, account_type="savings"),
            account(7, status="PENDING"),
            account(8, branch_id=99),  # unknown branch: both valid and quarantined
            account(9, status="CLOSED", closed_date=date(2020, 5, 4)),
            account(10, status="CLOSED", closed_date=date(2020, 5, 5)),
            account(11, currency_code=None),  # neither valid nor rejected
        ]),
        "transaction": frame(spark, "transaction", [
            txn(1, currency_code="ZZZ"),
            txn(2, source=9),  # the day after closing
            txn(3, source=10),  # on the closing day
            txn(4, source=1, destination=9),  # into a closed account
            txn(5, source=3),  # account of a rejected customer
            txn(6, currency_code="ZZZ", transaction_type="GIFT"),  # two rules, one record
            txn(7, transaction_type="transfer"),
            txn(8, amount="0.00"),
            txn(9, destination=1),  # same account
            txn(10, payment_channel="KIOSK"),
            txn(11, destination=99),
            txn(12, aml_flag=True),
            txn(13, source=8),  # account with an unknown branch is valid
        ]),
        "daily_balance": frame(spark, "daily_balance", [
            balance(1, date(2020, 1, 1), "77.00", "1.00", "2.00", "78.00"),  # first row, any opening
            balance(1, date(2020, 1, 2), "78.00", "0.00", "2.00", "99.00"),  # wrong closing
            balance(1, date(2020, 1, 3), "80.00", "0.00", "0.00", "80.00"),  # does not continue 99.00
            balance(1, date(2020, 1, 9), "80.00", "0.00", "0.00", "80.00"),
            balance(2, date(2020, 1, 1), "5.00", "-1.00", "0.00", "6.00"),
            balance(2, date(2020, 1, 2), "6.00", "0.00", "-1.00", "5.00"),
            balance(3, date(2020, 1, 1), "5.00", "0.00", "0.00", "5.00"),  # account not in core
        ]),
    }


def layers(spark: SparkSession, **replaced: DataFrame) -> Layers:
    return Layers({**hand_made(spark), **replaced}, RUN)
