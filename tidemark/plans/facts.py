"""Facts derived from core: flagged-transaction alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.verdict import row_count, total


def flagged_transactions(core_transactions: DataFrame) -> DataFrame:
    """Projection of the flagged facts."""
    return core_transactions.where("is_aml_flagged").select(
        "transaction_id",
        "source_account_id",
        "destination_account_id",
        "transaction_timestamp_utc",
        "transaction_amount",
    )


def alerts_by_account_day(core_transactions: DataFrame) -> DataFrame:
    """Count and amount of flagged transactions per source account and day."""
    return (
        flagged_transactions(core_transactions)
        .groupBy(
            F.col("source_account_id").alias("account_id"),
            F.to_date("transaction_timestamp_utc").alias("business_date"),
        )
        .agg(
            row_count().alias("flagged_transactions"),
            total("transaction_amount").cast("decimal(38,2)").alias("flagged_amount"),
        )
    )
