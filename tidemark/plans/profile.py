"""Source profiling and verification reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import canonical_text, instant_text
from tidemark.functions.verdict import VALUE_TYPE, Check, check_rows, count_where, metrics, row_count, total, union_all
from tidemark.operators.balances import failure_counts
from tidemark.operators.keys import duplicate_key_count, either_orphan_count, orphan_count
from tidemark.schemas import EMAIL_PATTERN, ENTITIES

Tables = Mapping[str, DataFrame]


def _lines(one_row: DataFrame, section: str, **elsewhere: str) -> DataFrame:
    """Unfold a one-row aggregate into (section, metric, value) text lines; some columns may belong to other sections."""
    lines = [
        F.struct(
            F.lit(elsewhere.get(c, section)).alias("section"), F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")
        )
        for c in one_row.columns
    ]
    return one_row.select(F.inline(F.array(*lines)))


def table_counts(tables: Tables) -> DataFrame:
    """(table_name, rows) of every table."""
    return union_all(
        [
            df.agg(row_count().alias("rows")).select(
                F.lit(ENTITIES[name].source_table).alias("table_name"), "rows"
            )
            for name, df in tables.items()
        ]
    )


def transaction_range(transactions: DataFrame) -> DataFrame:
    """Earliest and latest instant and the total, NULL on an empty table."""
    return transactions.agg(
        F.expr(instant_text("min(transaction_ts)")).alias("earliest_transaction"),
        F.expr(instant_text("max(transaction_ts)")).alias("latest_transaction"),
        F.sum("amount").cast("decimal(38,2)").alias("transaction_total"),
    )


def movement_sums() -> list[Column]:
    return [F.sum(c).cast("decimal(38,2)").alias(c) for c in ("debit_total", "credit_total")]


def movement_totals(balances: DataFrame) -> DataFrame:
    return balances.agg(*movement_sums())


def balance_profile(balances: DataFrame, keyed: bool) -> DataFrame:
    """One row: everything a profile wants to know of the balances, from one chained pass.

    Balances derived from transactions are laid out by account already; so they need neither files nor a further exchange.
    """
    figures = failure_counts(balances, keyed, *movement_sums())
    return figures.withColumnRenamed("balance_rows", "daily_balance_rows")


def source_profile(tables: Tables, keyed_balances: bool = False) -> DataFrame:
    """The profile as (section, metric, value) lines. ``keyed_balances``: balances are known to hold every key once."""
    parts = [
        _lines(df.agg(row_count().alias(f"{name}_rows")), "counts") for name, df in tables.items() if name != "daily_balance"
    ]
    for name in ("customer", "account", "transaction"):
        found = duplicate_key_count(tables[name], *ENTITIES[name].key)
        parts.append(_lines(found.withColumnRenamed("duplicate_keys", f"duplicate_{name}_ids"), "uniqueness"))
    lost = orphan_count(tables["account"], "customer_id", tables["customer"], "customer_id")
    parts.append(_lines(lost.withColumnRenamed("orphan_rows", "accounts_without_customer"), "relationships"))
    lost = either_orphan_count(
        tables["transaction"], "source_account_id", "destination_account_id", tables["account"], "account_id"
    )
    parts.append(_lines(lost.withColumnRenamed("orphan_rows", "transactions_without_account"), "relationships"))
    parts.append(_lines(transaction_range(tables["transaction"]), "transactions"))
    parts.append(
        _lines(balance_profile(tables["daily_balance"], keyed_balances), "balances", daily_balance_rows="counts")
    )
    return union_all(parts)


def verify_source(
    tables: Tables, expected_rows: dict[str, int], run_at: Column, keyed_balances: bool = False
) -> DataFrame:
    """Verification suite as check rows: expected counts, orphans, amounts, balances and totals.

    ``keyed_balances``: balances are known to hold every key once.
    """
    transactions, balances, accounts = tables["transaction"], tables["daily_balance"], tables["account"]
    found = [metrics(tables[n], **{f"{n}_rows": row_count()}) for n in expected_rows]

    def lost(child: DataFrame, column: str, parent: str, key: str, name: str) -> DataFrame:
        return metrics(orphan_count(child, column, tables[parent], key), **{name: F.sum("orphan_rows")})

    measured = union_all(
        [
            *found,
            lost(accounts, "customer_id", "customer", "customer_id", "orphan_customers"),
            lost(accounts, "branch_id", "branch", "branch_id", "orphan_branches"),
            lost(transactions, "source_account_id", "account", "account_id", "missing_sources"),
            lost(transactions, "destination_account_id", "account", "account_id", "missing_destinations"),
            lost(balances, "account_id", "account", "account_id", "orphan_balances"),
            metrics(
                transactions,
                same_account=count_where(F.col("source_account_id") == F.col("destination_account_id")),
                invalid_amounts=count_where(F.col("amount") <= 0),
                transaction_total=total("amount"),
            ),
            metrics(
                failure_counts(balances, keyed_balances),
                equation_failures=F.max("equation_failures"),
                roll_forward_failures=F.max("roll_forward_failures"),
            ),
            metrics(balances, debit_total=total("debit_total"), credit_total=total("credit_total")),
        ]
    )
    # fixed values: the names of the checks
    checks = [
        *[Check(f"{n}_expected_rows", (v,), (f"{n}_rows",)) for n, v in expected_rows.items()],
        Check("accounts_with_missing_customers", (), ("orphan_customers",)),
        Check("accounts_with_missing_branches", (), ("orphan_branches",)),
        Check("transactions_with_missing_source_accounts", (), ("missing_sources",)),
        Check("transactions_with_missing_destination_accounts", (), ("missing_destinations",)),
        Check("transactions_with_identical_accounts", (), ("same_account",)),
        Check("transactions_with_invalid_amounts", (), ("invalid_amounts",)),
        Check("balance_equation_failures", (), ("equation_failures",)),
        Check("balance_roll_forward_failures", (), ("roll_forward_failures",)),
        Check("balances_with_missing_accounts", (), ("orphan_balances",)),
        Check("transaction_total_vs_debits", ("transaction_total",), ("debit_total",), True),
        Check("transaction_total_vs_credits", ("transaction_total",), ("credit_total",), True),
    ]
    return check_rows(measured, checks, run_at)


def verify_counts(tables: Tables, promised: DataFrame, run_at: Column) -> DataFrame:
    """Check rows: the rows of every table against what the manifests of an earlier landing hold.

    ``promised`` has rows (source_table, row_count), read from stored manifests and not counted again.
    """
    names = F.create_map(*[x for n in tables for x in (F.lit(ENTITIES[n].source_table), F.lit(f"promised_{n}"))])
    told = promised.groupBy(names[F.col("source_table")].alias("metric")).agg(F.max("row_count").alias("row_count"))
    expected = told.select("metric", F.col("row_count").cast(VALUE_TYPE).alias("value"))
    found = [metrics(df, **{f"{name}_rows": row_count()}) for name, df in tables.items()]
    checks = [Check(f"{n}_expected_rows", (f"promised_{n}",), (f"{n}_rows",)) for n in tables]
    return check_rows(union_all([expected, *found]), checks, run_at)


def closed_account_transactions(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Transactions dated after the closing of their source account: inner join with a date residual."""
    closed = accounts.where(F.col("status") == "CLOSED").select(F.col("account_id").alias("closed_id"), "closed_date")
    late = F.col("closed_date") < F.to_date("transaction_ts")
    same = F.col("source_account_id") == F.col("closed_id")
    return transactions.join(closed, same & late, "inner").drop("closed_id", "closed_date")


def verify_defects(tables: Tables, manifest: DataFrame, as_of: Column, expected_manifest: int = 4) -> DataFrame:
    """(check_name, found, status): the manifest has its rows and every defect class occurs at least once."""
    customers = tables["customer"].agg(
        count_where(F.col("date_of_birth") > as_of).alias("future_birth_dates"),
        count_where(F.col("email").isNotNull() & ~F.col("email").like(EMAIL_PATTERN)).alias("invalid_emails"),
    )
    currency = tables["transaction"].agg(count_where(F.col("currency_code") == "ZZZ").alias("unsupported_currencies"))
    late = closed_account_transactions(tables["transaction"], tables["account"]).agg(
        row_count().alias("closed_account_transactions")
    )
    listed = manifest.agg(row_count().alias("manifest_records"))
    lines = union_all([_lines(part, "defects") for part in (listed, customers, currency, late)])
    found = F.col("value").cast("bigint")
    enough = F.when(F.col("metric") == "manifest_records", found == expected_manifest).otherwise(found >= 1)
    return lines.select(
        F.col("metric").alias("check_name"),
        found.alias("found"),
        F.when(enough, "PASS").otherwise("FAIL").alias("status"),
    )


def defect_coverage(manifest: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Every manifest defect with FOUND or MISSED, by (table, key, rule).

    Quarantine is first reduced to the records the manifest asks for, so only those are shuffled on.
    """
    on = ["source_table", "source_record_key", "rule_id"]
    wanted = manifest.select(*on).distinct()
    hits = quarantined.select(*on).join(wanted, on, "left_semi").distinct().withColumn("hit", F.lit(True))
    return manifest.join(hits, on, "left").select(
        "defect_id", *on, F.when(F.col("hit"), "FOUND").otherwise("MISSED").alias("outcome")
    )


# The critical data elements, as (table, column).
CRITICAL_ELEMENTS = (
    ("customer", "customer_id"),
    ("account", "account_id"),
    ("transaction", "transaction_id"),
    ("transaction", "transaction_ts"),
    ("transaction", "amount"),
    ("transaction", "currency_code"),
    ("daily_balance", "opening_balance"),
    ("daily_balance", "debit_total"),
    ("daily_balance", "credit_total"),
    ("daily_balance", "closing_balance"),
    ("transaction", "updated_at"),
)


def critical_elements(tables: Tables) -> DataFrame:
    """NULLs, distinct values, minimum and maximum of every critical data element.

    Each column is grouped by value first, which combines repeated values on the map side and keeps the distinct
    counts exact without an expand of the whole row.
    """
    parts = []
    for table, column in CRITICAL_ELEMENTS:
        text = F.expr(canonical_text(ENTITIES[table].schema[column]))
        values = tables[table].groupBy(column).agg(row_count().alias("copies"))
        parts.append(
            values.agg(
                F.coalesce(F.sum(F.when(F.col(column).isNull(), F.col("copies"))), F.lit(0)).alias("nulls"),
                F.count(column).alias("distinct_values"),
                F.min(column).alias(column),
                F.max(column).alias("greatest"),
            ).select(
                F.lit(ENTITIES[table].source_table).alias("table_name"),
                F.lit(column).alias("column_name"),
                "nulls",
                "distinct_values",
                text.alias("min_value"),
                (
                    F.expr(instant_text("greatest"))
                    if column in ("transaction_ts", "updated_at")
                    else F.col("greatest").cast("string")
                ).alias("max_value"),
            )
        )
    return union_all(parts)
