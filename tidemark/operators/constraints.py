"""Table constraints as audits: every constraint reports how many rows violate it.

A check passes on NULL, so a violation is ``coalesce(NOT condition, false)``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.verdict import union_all
from tidemark.operators.balances import BALANCE_EQUATION
from tidemark.operators.keys import duplicate_keys, orphans
from tidemark.schemas import (
    ACCOUNT,
    ACCOUNT_STATUSES,
    ACCOUNT_TYPES,
    BALANCE,
    BRANCH,
    BRANCH_STATUSES,
    CUSTOMER,
    CUSTOMER_STATUSES,
    ENTITIES,
    KYC_STATUSES,
    PAYMENT_CHANNELS,
    TRANSACTION,
    TRANSACTION_TYPES,
    Entity,
    one_of,
)


@dataclass(frozen=True)
class RowCheck:
    """CHECK constraint: a SQL condition on one row."""

    name: str
    holds: str


@dataclass(frozen=True)
class ForeignKey:
    name: str
    column: str
    parent: str
    key: str


_STAMP_ORDER = RowCheck("timestamps_ordered", "updated_at >= created_at")
_CURRENCY = RowCheck("currency_code_format", "currency_code = upper(currency_code) AND length(currency_code) = 3")

ENUMERATIONS = {
    BRANCH.name: (RowCheck("status_enumeration", one_of("status", BRANCH_STATUSES)),),
    CUSTOMER.name: (
        RowCheck("kyc_status_enumeration", one_of("kyc_status", KYC_STATUSES)),
        RowCheck("customer_status_enumeration", one_of("customer_status", CUSTOMER_STATUSES)),
    ),
    ACCOUNT.name: (
        RowCheck("account_type_enumeration", one_of("account_type", ACCOUNT_TYPES)),
        RowCheck("status_enumeration", one_of("status", ACCOUNT_STATUSES)),
    ),
    TRANSACTION.name: (
        RowCheck("transaction_type_enumeration", one_of("transaction_type", TRANSACTION_TYPES)),
        RowCheck("payment_channel_enumeration", one_of("payment_channel", PAYMENT_CHANNELS)),
    ),
}

CODES = {
    CUSTOMER.name: (RowCheck("country_code_upper", "country_code = upper(country_code)"),),
    ACCOUNT.name: (_CURRENCY,),
    TRANSACTION.name: (_CURRENCY,),
}

ORDERINGS = {
    BRANCH.name: (_STAMP_ORDER,),
    CUSTOMER.name: (_STAMP_ORDER,),
    ACCOUNT.name: (_STAMP_ORDER, RowCheck("closed_after_opened", "closed_date >= opened_date")),
    TRANSACTION.name: (
        RowCheck("timestamps_ordered", "updated_at >= created_at AND created_at >= transaction_ts"),
    ),
    BALANCE.name: (_STAMP_ORDER,),
}

AMOUNTS = {
    TRANSACTION.name: (
        RowCheck("amount_positive", "amount > 0"),
        RowCheck("accounts_differ", "source_account_id <> destination_account_id"),
    ),
    BALANCE.name: (
        RowCheck("debit_non_negative", "debit_total >= 0"),
        RowCheck("credit_non_negative", "credit_total >= 0"),
    ),
}

EQUATIONS = {BALANCE.name: (RowCheck("balance_equation", BALANCE_EQUATION),)}

FOREIGN_KEYS = {
    ACCOUNT.name: (
        ForeignKey("account_customer", "customer_id", CUSTOMER.name, "customer_id"),
        ForeignKey("account_branch", "branch_id", BRANCH.name, "branch_id"),
    ),
    TRANSACTION.name: (
        ForeignKey("transaction_source_account", "source_account_id", ACCOUNT.name, "account_id"),
        ForeignKey("transaction_destination_account", "destination_account_id", ACCOUNT.name, "account_id"),
    ),
    BALANCE.name: (ForeignKey("balance_account", "account_id", ACCOUNT.name, "account_id"),),
}

Tables = Mapping[str, DataFrame]


def _labelled(df: DataFrame, table: str, constraint: str) -> DataFrame:
    return df.select(
        F.lit(ENTITIES[table].source_table).alias("table_name"),
        F.lit(constraint).alias("constraint_name"),
        F.col("violations").cast("bigint").alias("violations"),
    )


def _conditions(df: DataFrame, table: str, counts: dict[str, Column]) -> DataFrame:
    """All row-level counts of one table in a single aggregation, unfolded to rows."""
    one_row = df.agg(*[c.alias(n) for n, c in counts.items()])
    pairs = [F.struct(F.lit(n).alias("constraint_name"), F.col(n).alias("violations")) for n in counts]
    return one_row.select(
        F.lit(ENTITIES[table].source_table).alias("table_name"), F.inline(F.array(*pairs))
    )


def _check_counts(checks: Iterable[RowCheck]) -> dict[str, Column]:
    return {c.name: F.expr(f"count_if(NOT ({c.holds}))") for c in checks}


def _null_counts(entity: Entity) -> dict[str, Column]:
    return {f"{c}_not_null": F.expr(f"count_if({c} IS NULL)") for c in entity.required}


def audit_rows(tables: Tables, groups: dict[str, tuple[RowCheck, ...]]) -> DataFrame:
    """Row checks of a group, one scan per table."""
    return union_all(
        [
            _conditions(tables[table], table, _check_counts(checks))
            for table, checks in groups.items()
        ]
    )


def audit_not_null(tables: Tables) -> DataFrame:
    """NULLs per required column, one scan per table."""
    return union_all(
        [
            _conditions(tables[e.name], e.name, _null_counts(e))
            for e in ENTITIES.values()
        ]
    )


def primary_key_violations(df: DataFrame, entity: Entity) -> DataFrame:
    """Duplicated keys plus rows with a NULL key part, from one aggregation by key."""
    any_null = F.lit(False)
    for column in entity.key:
        any_null = any_null | F.col(column).isNull()
    per_key = df.groupBy(*entity.key).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(
            F.sum(F.when(any_null, F.col("copies")).otherwise((F.col("copies") > 1).cast("bigint"))), F.lit(0)
        ).alias("violations")
    )


def audit_primary_keys(tables: Tables) -> DataFrame:
    return union_all(
        [
            _labelled(primary_key_violations(tables[e.name], e), e.name, "primary_key")
            for e in ENTITIES.values()
            if e.name in tables
        ]
    )


def audit_unique(tables: Tables) -> DataFrame:
    """UNIQUE columns; NULLs never clash."""
    parts = []
    for entity in ENTITIES.values():
        for column in entity.unique:
            filled = tables[entity.name].where(F.col(column).isNotNull())
            clashes = duplicate_keys(filled, column).agg(F.count(F.lit(1)).alias("violations"))
            parts.append(_labelled(clashes, entity.name, f"{column}_unique"))
    return union_all(parts)


def audit_foreign_keys(tables: Tables) -> DataFrame:
    """Child rows without a parent; a NULL foreign key satisfies the constraint."""
    parts = []
    for child, keys in FOREIGN_KEYS.items():
        for fk in keys:
            filled = tables[child].where(F.col(fk.column).isNotNull())
            lost = orphans(filled, fk.column, tables[fk.parent], fk.key)
            count = lost.agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("violations"))
            parts.append(_labelled(count, child, fk.name))
    return union_all(parts)


def audit_constraints(tables: Tables) -> DataFrame:
    """Every constraint of every table: (table_name, constraint_name, violations)."""
    one_scan = []
    for name, entity in ENTITIES.items():
        checks = [c for group in (ENUMERATIONS, CODES, ORDERINGS, AMOUNTS, EQUATIONS) for c in group.get(name, ())]
        counts = {**_null_counts(entity), **_check_counts(checks)}
        one_scan.append(_conditions(tables[name], name, counts))
    return union_all(
        [audit_primary_keys(tables), audit_unique(tables), audit_foreign_keys(tables), *one_scan]
    )


def table_contract(tables: Tables) -> DataFrame:
    """Expected against actual columns, with the filled rows of each column that exists.

    Reports (table_name, column_name, expected_type, actual_type, filled_rows, status).
    """
    parts = []
    for entity in ENTITIES.values():
        df = tables.get(entity.name)
        actual = {} if df is None else {f.name: f.dataType.simpleString() for f in df.schema.fields}
        filled = None
        if df is not None:
            present = [c for c in entity.columns if c in actual]
            filled = df.agg(*[F.count(c).alias(c) for c in present])
        for_each = []
        for column in entity.schema.fields:
            wanted, got = column.dataType.simpleString(), actual.get(column.name)
            status = "MISSING" if got is None else "OK" if got == wanted else "TYPE_MISMATCH"
            for_each.append(
                F.struct(
                    F.lit(entity.source_table).alias("table_name"),
                    F.lit(column.name).alias("column_name"),
                    F.lit(wanted).alias("expected_type"),
                    F.lit(got).cast("string").alias("actual_type"),
                    (F.col(column.name) if got else F.lit(None).cast("bigint")).alias("filled_rows"),
                    F.lit(status).alias("status"),
                )
            )
        if filled is not None:
            parts.append(filled.select(F.inline(F.array(*for_each))))
        else:
            some = next(iter(tables.values()))
            parts.append(some.agg(F.lit(1)).select(F.inline(F.array(*for_each))))
    return union_all(parts)
