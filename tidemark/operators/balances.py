"""Daily balances: double-entry rollup, running balance, balance equation and roll-forward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.verdict import row_count
from tidemark.schemas import MONEY
from tidemark.session import SORTED_SUMS

# An account opens with 10000.00 plus 100 per unit of its id.
OPENING_BASE = 10000
OPENING_PER_ID = 100

BALANCE_EQUATION = "(opening_balance + credit_total - debit_total = closing_balance)"

# Decides between several rows of one account and day: the latest version counts.
VERSION_ORDER = ("source_updated_at", "ingested_at", "record_hash")


def daily_movements(transactions: DataFrame) -> DataFrame:
    """Debit and credit totals per (account, business date).

    One scan: every transaction is unfolded into its debit and its credit leg, four narrow columns. Legs seldom meet on
    one account and day within a map task, so they are not summed there; they travel once, by account, and both the sums
    and windows by account over them need no further exchange. The legs of a hot account stream through one task, which
    holds a row per day of it. In a session that sums sorted rows (``sized_for``) the narrow legs are sorted instead of the
    sums, once for all windows over them, and a day is summed as it passes.
    """
    legs = transactions.selectExpr(
        """inline(array(
            named_struct('account_id', source_account_id, 'business_date', to_date(transaction_ts),
                         'is_debit', TRUE, 'amount', amount),
            named_struct('account_id', destination_account_id, 'business_date', to_date(transaction_ts),
                         'is_debit', FALSE, 'amount', amount)))"""
    )
    legs, nothing = legs.repartition("account_id"), F.lit(0).cast(MONEY)
    if legs.sparkSession.conf.get(SORTED_SUMS) == "true":
        # sums do not depend on an order, so the optimiser would drop the sort; it keeps one below such a condition
        legs = legs.sortWithinPartitions("account_id", "business_date").where(F.spark_partition_id() >= 0)
    return legs.groupBy("account_id", "business_date").agg(
        F.sum(F.when(F.col("is_debit"), F.col("amount")).otherwise(nothing)).cast(MONEY).alias("debit_total"),
        F.sum(F.when(F.col("is_debit"), nothing).otherwise(F.col("amount"))).cast(MONEY).alias("credit_total"),
    )


def default_opening() -> Column:
    return (F.lit(OPENING_BASE) + F.col("account_id") * F.lit(OPENING_PER_ID)).cast(MONEY)


def running_balances(movements: DataFrame, opening: Column | None = None) -> DataFrame:
    """Opening and closing balance per (account, business date) from the account's first opening.

    The input is unique per account and day, so a window group is bounded by the number of calendar days.
    """
    start = default_opening() if opening is None else opening
    so_far = Window.partitionBy("account_id").orderBy("business_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    net = F.col("credit_total") - F.col("debit_total")
    closing = (start + F.sum(net).over(so_far)).cast(MONEY)
    return movements.withColumn("closing_balance", closing).select(
        "account_id",
        "business_date",
        (F.col("closing_balance") - net).cast(MONEY).alias("opening_balance"),
        "debit_total",
        "credit_total",
        "closing_balance",
    )


def daily_balances(transactions: DataFrame, opening: Column | None = None) -> DataFrame:
    """Balance rows of every account with movements, stamped 23:59 of their business date."""
    stamp = F.col("business_date").cast("timestamp") + F.expr("INTERVAL '23:59' HOUR TO MINUTE")
    return running_balances(daily_movements(transactions), opening).select(
        "*", stamp.alias("created_at"), stamp.alias("updated_at")
    )


def balance_equation_holds() -> Column:
    return F.expr(BALANCE_EQUATION)


def with_previous_closing(balances: DataFrame) -> DataFrame:
    """Add ``previous_closing_balance``: the closing of the account's preceding business date.

    The key (account, business date) is not enforced on raw data, so the rows are first folded to one closing
    per day (the latest version). The window then runs over calendar days only, whatever the number of copies
    one account or one day has, and the result is joined back on the key. On unique keys this equals LAG over
    the raw rows.
    """
    order = [c for c in VERSION_ORDER if c in balances.columns]
    pick = F.max_by("closing_balance", F.struct(*order)) if order else F.max("closing_balance")
    days = balances.groupBy("account_id", "business_date").agg(pick.alias("day_closing"))
    by_account = Window.partitionBy("account_id").orderBy("business_date")
    previous = days.select(
        F.col("account_id").alias("p_account"),
        F.col("business_date").alias("p_date"),
        F.lag("day_closing").over(by_account).alias("previous_closing_balance"),
    ).where("previous_closing_balance IS NOT NULL")
    on = F.expr("account_id = p_account AND business_date = p_date")
    return balances.join(previous, on, "left").drop("p_account", "p_date")


def with_previous_closing_unique(balances: DataFrame) -> DataFrame:
    """Same column for a table whose (account, business date) is known to be unique, e.g. behind the core gate."""
    by_account = Window.partitionBy("account_id").orderBy("business_date")
    return balances.withColumn("previous_closing_balance", F.lag("closing_balance").over(by_account))


def with_previous_closing_by_key(balances: DataFrame) -> DataFrame:
    """``with_previous_closing`` for a table known to hold every (account, business date) once: no copy has to be chosen.

    A group of the window is bounded by the calendar as it is, so the rows need neither folding nor a join.
    """
    chained = with_previous_closing_unique(balances)
    keyed = F.col("account_id").isNotNull() & F.col("business_date").isNotNull()
    return chained.withColumn("previous_closing_balance", F.when(keyed, F.col("previous_closing_balance")))


def roll_forward_failures(balances: DataFrame, unique: bool = False) -> DataFrame:
    """Rows whose opening differs from the previous closing."""
    chained = with_previous_closing_unique(balances) if unique else with_previous_closing(balances)
    return chained.where(F.col("opening_balance") != F.col("previous_closing_balance"))


def equation_failures(balances: DataFrame) -> DataFrame:
    return balances.where(~balance_equation_holds())


def failure_counts(balances: DataFrame, unique: bool = False, *more: Column) -> DataFrame:
    """One row: equation failures and roll-forward failures, from one chained pass, and further aggregates of the rows."""
    chained = with_previous_closing_unique(balances) if unique else with_previous_closing(balances)
    return chained.agg(
        row_count().alias("balance_rows"),
        F.count(F.when(~balance_equation_holds(), 1)).alias("equation_failures"),
        F.count(F.when(F.col("opening_balance") != F.col("previous_closing_balance"), 1)).alias(
            "roll_forward_failures"
        ),
        *more,
    )
