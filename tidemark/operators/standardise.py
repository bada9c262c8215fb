"""Column clean-up and renaming between the raw and the staging layer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.schemas import LINEAGE_COLUMNS

# Staging column -> expression over the raw row.
PROJECTIONS = {
    "branch": {
        "branch_id": "branch_id",
        "branch_code": "trim(branch_code)",
        "branch_name": "trim(branch_name)",
        "city": "trim(city)",
        "state": "trim(state)",
        "operating_region": "upper(trim(operating_region))",
        "opened_date": "opened_date",
        "branch_status": "upper(status)",
    },
    "customer": {
        "customer_id": "customer_id",
        "customer_number": "trim(customer_number)",
        "customer_name": "trim(full_name)",
        "date_of_birth": "date_of_birth",
        "email_normalised": "lower(trim(email))",
        "phone": "phone",
        "country_code": "country_code",
        "kyc_status": "kyc_status",
        "customer_status": "customer_status",
    },
    "account": {
        "account_id": "account_id",
        "account_number": "trim(account_number)",
        "customer_id": "customer_id",
        "branch_id": "branch_id",
        "account_type": "upper(account_type)",
        "currency_code": "upper(currency_code)",
        "opened_date": "opened_date",
        "closed_date": "closed_date",
        "account_status": "upper(status)",
    },
    "transaction": {
        "transaction_id": "transaction_id",
        "source_account_id": "source_account_id",
        "destination_account_id": "destination_account_id",
        "transaction_timestamp_utc": "transaction_ts",
        "transaction_type": "upper(transaction_type)",
        "transaction_amount": "amount",
        "currency_code": "upper(currency_code)",
        "payment_channel": "upper(payment_channel)",
        "is_aml_flagged": "aml_flag",
    },
    "daily_balance": {
        "account_id": "account_id",
        "business_date": "business_date",
        "opening_balance": "opening_balance",
        "debit_total": "debit_total",
        "credit_total": "credit_total",
        "closing_balance": "closing_balance",
    },
}


def standardise(raw: DataFrame, entity_name: str) -> DataFrame:
    """Business columns cleaned and renamed, lineage columns carried along."""
    business = [f"{text} AS {name}" for name, text in PROJECTIONS[entity_name].items()]
    return raw.selectExpr(*business, *LINEAGE_COLUMNS)
