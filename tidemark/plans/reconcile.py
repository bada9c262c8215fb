"""Count and amount reconciliation between the layers. Tolerance is zero."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.verdict import VALUE_TYPE, Check, check_rows, count_where, metrics, row_count, total, union_all
from tidemark.operators.balances import balance_equation_holds, roll_forward_failures
from tidemark.operators.keys import distinct_count, rows_with_listed_key
from tidemark.operators.rules import is_rejected
from tidemark.schemas import TRANSACTION

# The names of the checks in both lists, which readers of the results rely on.
TRANSACTION_CHECKS = [
    Check("source_vs_raw_row_count", ("source_rows",), ("raw_rows",)),
    Check("raw_vs_valid_plus_rejected", ("raw_rows",), ("staging_rows", "rejected_records")),
    Check("staging_vs_core_row_count", ("staging_rows",), ("core_rows",)),
    Check("source_vs_raw_amount", ("source_amount",), ("raw_amount",), True),
    Check("raw_vs_core_plus_rejected_amount", ("raw_amount",), ("core_amount", "rejected_amount"), True),
    Check("staging_vs_core_amount", ("staging_amount",), ("core_amount",), True),
    Check("source_vs_raw_aml_count", ("source_aml",), ("raw_aml",)),
]

FINANCIAL_CHECKS = [
    Check("source_transaction_vs_debits", ("source_amount",), ("source_debits",), True),
    Check("source_transaction_vs_credits", ("source_amount",), ("source_credits",), True),
    Check("source_vs_raw_transaction_count", ("source_rows",), ("raw_rows",)),
    Check("source_vs_raw_transaction_amount", ("source_amount",), ("raw_amount",), True),
    Check("source_vs_raw_balance_count", ("source_balances",), ("raw_balances",)),
    Check("source_vs_raw_debit_total", ("source_debits",), ("raw_debits",), True),
    Check("source_vs_raw_credit_total", ("source_credits",), ("raw_credits",), True),
    Check("raw_transaction_vs_debits", ("raw_amount",), ("raw_debits",), True),
    Check("raw_transaction_vs_credits", ("raw_amount",), ("raw_credits",), True),
    Check("raw_balance_rows_vs_core_plus_rejected", ("raw_balances",), ("core_balances", "rejected_balances")),
    Check("core_balance_equation_failures", (), ("equation_failures",)),
    Check("core_roll_forward_failures", (), ("roll_forward_failures",)),
]


def _transactions(df: DataFrame, layer: str, amount: str, aml: str | None = None) -> DataFrame:
    wanted = {f"{layer}_rows": row_count(), f"{layer}_amount": total(amount)}
    if aml:
        wanted[f"{layer}_aml"] = count_where(F.col(aml))
    return metrics(df, **wanted)


def _balances(df: DataFrame, layer: str, **more: Column) -> DataFrame:
    return metrics(
        df,
        **{
            f"{layer}_balances": row_count(),
            f"{layer}_debits": total("debit_total"),
            f"{layer}_credits": total("credit_total"),
            **more,
        },
    )


def balance_totals() -> dict[str, Column]:
    """What ``reconcile_financials`` wants to know of the source balances, as aggregates to observe while they pass."""
    figures = {"balances": row_count(), "debits": total("debit_total"), "credits": total("credit_total")}
    return {f"source_{n}": f.cast(VALUE_TYPE).alias(f"source_{n}") for n, f in figures.items()}


def _told(like: DataFrame, figures: Mapping[str, object]) -> DataFrame:
    """Figures at hand as (metric, value) rows."""
    pairs = [F.struct(F.lit(n).alias("metric"), F.lit(v).cast(VALUE_TYPE).alias("value")) for n, v in figures.items()]
    return like.sparkSession.range(1).select(F.inline(F.array(*pairs)))


def _distinct_records(quarantined: DataFrame, name: str) -> DataFrame:
    return metrics(distinct_count(quarantined, "source_record_key", "n"), **{name: F.sum("n")})


def rejected_amount(raw: DataFrame, quarantined: DataFrame) -> DataFrame:
    """One row: summed amount of the raw transactions that are quarantined, each record once."""
    hit = rows_with_listed_key(raw, "transaction_id", quarantined, "source_record_key")
    return hit.agg(row_count().alias("rejected_rows"), total("amount").cast("decimal(38,2)").alias("rejected_amount"))


def rejected_amount_of(evaluated: DataFrame) -> DataFrame:
    """The same from evaluated rows, whose verdict is at hand: no join and no second scan.

    A key counts with all its rows once one of them is rejected, so rows are folded by key first.
    """
    per_key = evaluated.groupBy("source_record_key").agg(
        F.bool_or(is_rejected()).alias("hit"), row_count().alias("copies"), F.sum("amount").alias("amount")
    )
    return per_key.where("hit").agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rejected_rows"),
        total("amount").cast("decimal(38,2)").alias("rejected_amount"),
    )


def rejected_by_key(evaluated: DataFrame, *key: str) -> DataFrame:
    """One row: distinct rejected keys and the summed amount of all rows that have one of them.

    Keys of a record seldom repeat, so rows are not summed before they travel; they travel once, as key, amount and verdict.
    The rows of a repeated key stream through one task, which holds a row for it.
    """
    rows = evaluated.select(*key, "amount", is_rejected().alias("hit")).repartition(*key)
    per_key = rows.groupBy(*key).agg(F.bool_or("hit").alias("hit"), F.sum("amount").alias("amount"))
    return per_key.where("hit").agg(row_count().alias("rejected_records"), total("amount").alias("rejected_amount"))


def transaction_metrics(
    source: DataFrame, raw: DataFrame, staging: DataFrame, core: DataFrame, quarantined: DataFrame | None
) -> DataFrame:
    if quarantined is None:
        known = rejected_by_key(raw, *TRANSACTION.key)
        rejected = [metrics(known, **{n: F.max(n) for n in known.columns})]
    else:
        rejected = [
            _distinct_records(quarantined, "rejected_records"),
            metrics(rejected_amount(raw, quarantined), rejected_amount=F.max("rejected_amount")),
        ]
    return union_all(
        [
            _transactions(source, "source", "amount", "aml_flag"),
            _transactions(raw, "raw", "amount", "aml_flag"),
            _transactions(staging, "staging", "transaction_amount"),
            _transactions(core, "core", "transaction_amount", "is_aml_flagged"),
            *rejected,
        ]
    )


def reconcile_transactions(
    source: DataFrame, raw: DataFrame, staging: DataFrame, core: DataFrame, quarantined: DataFrame | None, run_at: Column
) -> DataFrame:
    """The seven transaction checks. Without a quarantine, raw rows carry their verdicts and tell what is rejected."""
    return check_rows(transaction_metrics(source, raw, staging, core, quarantined), TRANSACTION_CHECKS, run_at)


def by_type(df: DataFrame, amount: str) -> DataFrame:
    """Rows and amount per transaction type."""
    return df.groupBy("transaction_type").agg(
        row_count().alias("rows"), total(amount).cast("decimal(38,2)").alias("amount")
    )


def compare_by_type(source: DataFrame, core: DataFrame) -> DataFrame:
    """Every source type with its source and core figures; a type absent from core counts 0."""
    left = by_type(source, "amount").select(
        "transaction_type", F.col("rows").alias("source_rows"), F.col("amount").alias("source_amount")
    )
    right = by_type(core, "transaction_amount").select(
        "transaction_type", F.col("rows").alias("core_rows"), F.col("amount").alias("core_amount")
    )
    nothing = F.lit(0).cast("decimal(38,2)")
    return left.join(right, "transaction_type", "left").select(
        "transaction_type",
        "source_rows",
        "source_amount",
        F.coalesce("core_rows", F.lit(0)).alias("core_rows"),
        F.coalesce("core_amount", nothing).alias("core_amount"),
    )


def financial_metrics(
    source_transactions: DataFrame,
    source_balances: DataFrame | Mapping[str, object],
    raw_transactions: DataFrame,
    raw_balances: DataFrame,
    core_balances: DataFrame,
    rejected_balances: DataFrame,
) -> DataFrame:
    # Behind the core gate (account, date) is unique, so the chain needs a single shuffle.
    broken_chain = roll_forward_failures(core_balances, unique=True)
    return union_all(
        [
            _transactions(source_transactions, "source", "amount"),
            _told(raw_balances, source_balances) if isinstance(source_balances, Mapping) else _balances(source_balances, "source"),
            _transactions(raw_transactions, "raw", "amount"),
            _balances(raw_balances, "raw"),
            _balances(core_balances, "core", equation_failures=count_where(~balance_equation_holds())),
            metrics(broken_chain, roll_forward_failures=row_count()),
            _distinct_records(rejected_balances, "rejected_balances"),
        ]
    )


def reconcile_financials(
    source_transactions: DataFrame,
    source_balances: DataFrame | Mapping[str, object],
    raw_transactions: DataFrame,
    raw_balances: DataFrame,
    core_balances: DataFrame,
    rejected_balances: DataFrame,
    run_at: Column,
) -> DataFrame:
    """The twelve financial checks. Of the source balances their observed ``balance_totals`` are enough."""
    measured = financial_metrics(
        source_transactions, source_balances, raw_transactions, raw_balances, core_balances, rejected_balances
    )
    return check_rows(measured, FINANCIAL_CHECKS, run_at)


def cross_fact_variance(core_transactions: DataFrame, core_balances: DataFrame) -> DataFrame:
    """Core debits and credits minus the core transaction amount. Informational: rejecting a transaction does
    not remove it from the daily totals, so a difference is expected."""
    measured = union_all(
        [_transactions(core_transactions, "core", "transaction_amount"), _balances(core_balances, "core")]
    )

    def value(name: str) -> Column:
        return F.max(F.when(F.col("metric") == name, F.col("value")))

    return measured.agg(
        (value("core_debits") - value("core_amount")).cast("decimal(38,2)").alias("debit_variance"),
        (value("core_credits") - value("core_amount")).cast("decimal(38,2)").alias("credit_variance"),
    )
