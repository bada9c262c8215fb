"""Declared schemas, keys, hash recipes and payload fields of the five banking entities."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Allowed members of each enumeration.
BRANCH_STATUSES = ("ACTIVE", "INACTIVE", "CLOSED")
KYC_STATUSES = ("PENDING", "VERIFIED", "REVIEW_REQUIRED", "REJECTED")
CUSTOMER_STATUSES = ("ACTIVE", "INACTIVE", "BLOCKED", "CLOSED")
ACCOUNT_TYPES = ("SAVINGS", "CURRENT", "LOAN", "CREDIT_CARD")
ACCOUNT_STATUSES = ("ACTIVE", "DORMANT", "FROZEN", "CLOSED")
TRANSACTION_TYPES = ("TRANSFER", "CARD_PAYMENT", "CASH_WITHDRAWAL", "DIRECT_DEBIT")
PAYMENT_CHANNELS = ("MOBILE", "ONLINE", "ATM", "BRANCH", "CARD")
APPROVED_CURRENCY = "INR"
EMAIL_PATTERN = "%_@_%._%"

# Lineage constants.
SOURCE_SYSTEM = "neon_postgresql"
SCHEMA_VERSION = "1.0"
OPEN_STATUS = "OPEN"

LINEAGE_COLUMNS = (
    "migration_batch_id",
    "source_system",
    "source_table",
    "source_record_key",
    "source_updated_at",
    "ingested_at",
    "record_hash",
    "schema_version",
    "is_deleted",
)


def one_of(column: str, allowed: tuple[str, ...]) -> str:
    """SQL membership test against an enumeration; NULL stays NULL."""
    members = ", ".join(f"'{v}'" for v in allowed)
    return f"({column} IN ({members}))"


def struct_of(ddl: dict[str, str], required: tuple[str, ...]) -> T.StructType:
    """Build a schema from ``name -> type name``; columns in ``required`` are NOT NULL."""
    kinds = {
        "long": T.LongType(),
        "text": T.StringType(),
        "date": T.DateType(),
        "instant": T.TimestampType(),
        "money": MONEY,
        "flag": T.BooleanType(),
        "whole": T.LongType(),
    }
    return T.StructType([T.StructField(n, kinds[k], n not in required) for n, k in ddl.items()])


@dataclass(frozen=True)
class Entity:
    """What the engine has to know about one migrated table."""

    name: str
    source_table: str
    schema: T.StructType
    key: tuple[str, ...]
    payload: tuple[str, ...]
    blank_when_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema.fields)

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema.fields if not f.nullable)


def _entity(name, source_table, ddl, key, payload, optional=(), **more) -> Entity:
    required = tuple(c for c in ddl if c not in optional)
    return Entity(name, source_table, struct_of(ddl, required), key, payload, **more)


_STAMPS = {"created_at": "instant", "updated_at": "instant"}

BRANCH = _entity(
    "branch",
    "core.branch",
    {
        "branch_id": "long",
        "branch_code": "text",
        "branch_name": "text",
        "city": "text",
        "state": "text",
        "operating_region": "text",
        "opened_date": "date",
        "status": "text",
        **_STAMPS,
    },
    key=("branch_id",),
    payload=(
        "branch_id", "branch_code", "branch_name", "city",
        "state", "operating_region", "opened_date", "status",
    ),
    unique=("branch_code",),
)

CUSTOMER = _entity(
    "customer",
    "core.customer",
    {
        "customer_id": "long",
        "customer_number": "text",
        "full_name": "text",
        "date_of_birth": "date",
        "email": "text",
        "phone": "text",
        "address_line_1": "text",
        "address_line_2": "text",
        "city": "text",
        "state": "text",
        "postal_code": "text",
        "country_code": "text",
        "kyc_status": "text",
        "customer_status": "text",
        **_STAMPS,
    },
    key=("customer_id",),
    payload=(
        "customer_id", "customer_number", "full_name", "date_of_birth", "email",
        "phone", "country_code", "kyc_status", "customer_status",
    ),
    optional=("email", "phone", "address_line_1", "address_line_2", "city", "state", "postal_code"),
    blank_when_null=("email", "phone"),
    unique=("customer_number",),
)

ACCOUNT = _entity(
    "account",
    "core.account",
    {
        "account_id": "long",
        "account_number": "text",
        "customer_id": "long",
        "branch_id": "long",
        "account_type": "text",
        "currency_code": "text",
        "opened_date": "date",
        "closed_date": "date",
        "status": "text",
        **_STAMPS,
    },
    key=("account_id",),
    payload=(
        "account_id", "account_number", "customer_id", "branch_id", "account_type",
        "currency_code", "opened_date", "closed_date", "status",
    ),
    optional=("closed_date",),
    blank_when_null=("closed_date",),
    unique=("account_number",),
)

TRANSACTION = _entity(
    "transaction",
    "payments.bank_transaction",
    {
        "transaction_id": "long",
        "source_account_id": "long",
        "destination_account_id": "long",
        "transaction_ts": "instant",
        "transaction_type": "text",
        "amount": "money",
        "currency_code": "text",
        "payment_channel": "text",
        "aml_flag": "flag",
        **_STAMPS,
    },
    key=("transaction_id",),
    payload=(
        "transaction_id", "source_account_id", "destination_account_id", "transaction_ts",
        "transaction_type", "amount", "currency_code", "payment_channel", "aml_flag",
    ),
)

BALANCE = _entity(
    "daily_balance",
    "finance.daily_account_balance",
    {
        "account_id": "long",
        "business_date": "date",
        "opening_balance": "money",
        "debit_total": "money",
        "credit_total": "money",
        "closing_balance": "money",
        **_STAMPS,
    },
    key=("account_id", "business_date"),
    payload=(
        "account_id", "business_date", "opening_balance",
        "debit_total", "credit_total", "closing_balance",
    ),
)

ENTITIES = {e.name: e for e in (BRANCH, CUSTOMER, ACCOUNT, TRANSACTION, BALANCE)}

DEFECT_MANIFEST = struct_of(
    {
        "defect_id": "text",
        "source_table": "text",
        "source_record_key": "text",
        "rule_id": "text",
        "defect_description": "text",
        "expected_handling": "text",
        "injected_at": "instant",
    },
    required=("defect_id",),
)

MIGRATION_BATCH = struct_of(
    {
        "batch_id": "text",
        "migration_type": "text",
        "lower_watermark": "instant",
        "upper_watermark": "instant",
        "started_at": "instant",
        "completed_at": "instant",
        "status": "text",
        "initiated_by": "text",
        "error_message": "text",
    },
    required=("batch_id", "migration_type", "started_at", "status"),
)

TABLE_RUN = struct_of(
    {
        "batch_id": "text",
        "table_name": "text",
        "source_rows": "whole",
        "extracted_rows": "whole",
        "loaded_rows": "whole",
        "rejected_rows": "whole",
        "started_at": "instant",
        "completed_at": "instant",
        "status": "text",
        "error_message": "text",
    },
    required=("batch_id", "table_name", "status"),
)

EXTRACT_CONTROL = struct_of(
    {
        "source_table": "text",
        "last_watermark_ts": "instant",
        "last_watermark_key": "text",
        "last_successful_batch_id": "text",
        "updated_at": "instant",
    },
    required=("source_table", "updated_at"),
)

ROLLED_BACK = struct_of({"batch_id": "text", "rolled_back_at": "instant", "reason": "text"}, required=("batch_id",))
