"""The validity conditions and rejection rules of the five entities, and the source-side rules."""

from __future__ import annotations

from dataclasses import replace

from tidemark.operators.balances import BALANCE_EQUATION, with_previous_closing, with_previous_closing_by_key
from tidemark.operators.rules import Lookup, Rule, RuleBook
from tidemark.schemas import (
    ACCOUNT,
    ACCOUNT_STATUSES,
    ACCOUNT_TYPES,
    APPROVED_CURRENCY,
    BALANCE,
    BRANCH,
    BRANCH_STATUSES,
    CUSTOMER,
    EMAIL_PATTERN,
    PAYMENT_CHANNELS,
    TRANSACTION,
    TRANSACTION_TYPES,
    one_of,
)

# The severities here, and the ids and messages of the rules below, which readers of the quarantine rely on.
HIGH, CRITICAL = "HIGH", "CRITICAL"

GOOD_EMAIL = f"email LIKE '{EMAIL_PATTERN}'"
APPROVED = f"currency_code = '{APPROVED_CURRENCY}'"
# The earliest closing date among the CLOSED rows of an account; NULL while it is open.
CLOSED_ON = "source_account_closed_on"
CLOSED_BEFORE_USE = f"{CLOSED_ON} < to_date(transaction_ts)"


def filled(column: str) -> str:
    return f"({column} IS NOT NULL AND trim({column}) <> '')"


def earliest_closure(status: str) -> dict[str, str]:
    return {CLOSED_ON: f"min(CASE WHEN {status} = 'CLOSED' THEN closed_date END)"}


BRANCH_BOOK = RuleBook(
    entity=BRANCH,
    accepts=(
        f"branch_id IS NOT NULL AND {filled('branch_code')} AND {filled('branch_name')} "
        f"AND opened_date IS NOT NULL AND {one_of('status', BRANCH_STATUSES)}"
    ),
    rules=(
        Rule("BRANCH_CODE_REQUIRED", HIGH, "Branch code is missing or blank.", f"NOT {filled('branch_code')}"),
        Rule("BRANCH_NAME_REQUIRED", HIGH, "Branch name is missing or blank.", f"NOT {filled('branch_name')}"),
        Rule("BRANCH_OPENED_DATE_REQUIRED", HIGH, "Branch opened_date is missing.", "opened_date IS NULL"),
        Rule(
            "BRANCH_STATUS_REFERENCE", HIGH, "Branch status is not approved.",
            f"NOT {one_of('status', BRANCH_STATUSES)}",
        ),
    ),
)

CUSTOMER_BOOK = RuleBook(
    entity=CUSTOMER,
    accepts=f"date_of_birth <= as_of AND (email IS NULL OR {GOOD_EMAIL})",
    rules=(
        Rule(
            "CUSTOMER_DOB_NOT_FUTURE", HIGH, "Customer date of birth is in the future.", "date_of_birth > as_of"
        ),
        Rule("CUSTOMER_EMAIL_FORMAT", HIGH, "Customer email format is invalid.", f"NOT ({GOOD_EMAIL})"),
    ),
)

ACCOUNT_BOOK = RuleBook(
    entity=ACCOUNT,
    lookups=(
        Lookup("customer", "customer_id", "customer", "customer_id"),
        Lookup("branch", "branch_id", "branch", "branch_id"),
    ),
    # The branch is deliberately absent here: an unknown branch is quarantined and still accepted.
    accepts=(
        "customer_found", APPROVED, "closed_date IS NULL OR closed_date >= opened_date",
        one_of("account_type", ACCOUNT_TYPES), one_of("status", ACCOUNT_STATUSES),
    ),
    rules=(
        Rule(
            "ACCOUNT_CUSTOMER_REFERENCE", CRITICAL, "Account customer_id does not resolve to a valid customer.",
            "NOT customer_found",
        ),
        Rule(
            "ACCOUNT_CURRENCY_REFERENCE", HIGH, "Account currency is not in the approved currency list.",
            f"NOT ({APPROVED})",
        ),
        Rule(
            "ACCOUNT_DATE_RANGE", HIGH, "Account closed_date is earlier than opened_date.",
            "closed_date < opened_date",
        ),
        Rule(
            "ACCOUNT_TYPE_REFERENCE", HIGH, "Account type is not approved.",
            f"NOT {one_of('account_type', ACCOUNT_TYPES)}",
        ),
        Rule(
            "ACCOUNT_STATUS_REFERENCE", HIGH, "Account status is not approved.",
            f"NOT {one_of('status', ACCOUNT_STATUSES)}",
        ),
        Rule(
            "ACCOUNT_BRANCH_REFERENCE", HIGH, "Account branch_id does not resolve to a valid branch.",
            "NOT branch_found",
        ),
    ),
)

TRANSACTION_BOOK = RuleBook(
    entity=TRANSACTION,
    lookups=(
        Lookup("source_account", "source_account_id", "account", "account_id", earliest_closure("account_status")),
        Lookup("destination_account", "destination_account_id", "account", "account_id"),
    ),
    accepts=(
        "source_account_found", "destination_account_found", "amount > 0", APPROVED,
        "source_account_id <> destination_account_id",
        one_of("transaction_type", TRANSACTION_TYPES), one_of("payment_channel", PAYMENT_CHANNELS),
        f"NOT coalesce({CLOSED_BEFORE_USE}, FALSE)",
    ),
    rules=(
        Rule(
            "TRANSACTION_SOURCE_ACCOUNT_REFERENCE", CRITICAL, "Source account does not resolve to a valid account.",
            "NOT source_account_found",
        ),
        Rule(
            "TRANSACTION_DESTINATION_ACCOUNT_REFERENCE", CRITICAL,
            "Destination account does not resolve to a valid account.", "NOT destination_account_found",
        ),
        Rule("TRANSACTION_AMOUNT_POSITIVE", HIGH, "Transaction amount must be greater than zero.", "amount <= 0"),
        Rule(
            "TRANSACTION_CURRENCY_REFERENCE", HIGH, "Transaction currency is not in the approved currency list.",
            f"NOT ({APPROVED})",
        ),
        Rule(
            "TRANSACTION_ACCOUNTS_DIFFER", HIGH, "Source and destination accounts must be different.",
            "source_account_id = destination_account_id",
        ),
        Rule(
            "TRANSACTION_TYPE_REFERENCE", HIGH, "Transaction type is not approved.",
            f"NOT {one_of('transaction_type', TRANSACTION_TYPES)}",
        ),
        Rule(
            "TRANSACTION_CHANNEL_REFERENCE", HIGH, "Payment channel is not approved.",
            f"NOT {one_of('payment_channel', PAYMENT_CHANNELS)}",
        ),
        Rule(
            "CLOSED_ACCOUNT_TRANSACTION", HIGH, "Transaction occurred after the source account was closed.",
            CLOSED_BEFORE_USE,
        ),
    ),
)

BALANCE_BOOK = RuleBook(
    entity=BALANCE,
    lookups=(Lookup("account", "account_id", "account", "account_id", laid_out=True),),
    prepare=with_previous_closing,
    by_version=True,
    accepts=(
        f"account_found AND debit_total >= 0 AND credit_total >= 0 AND {BALANCE_EQUATION} "
        "AND (previous_closing_balance IS NULL OR opening_balance = previous_closing_balance)"
    ),
    rules=(
        Rule(
            "BALANCE_ACCOUNT_REFERENCE", CRITICAL, "Balance account_id does not resolve to a valid account.",
            "NOT account_found",
        ),
        Rule("BALANCE_DEBIT_NON_NEGATIVE", HIGH, "Debit total must be non-negative.", "debit_total < 0"),
        Rule("BALANCE_CREDIT_NON_NEGATIVE", HIGH, "Credit total must be non-negative.", "credit_total < 0"),
        Rule(
            "BALANCE_EQUATION", CRITICAL,
            "Opening balance plus credits minus debits does not equal closing balance.", f"NOT ({BALANCE_EQUATION})",
        ),
        Rule(
            "BALANCE_ROLL_FORWARD", CRITICAL, "Current opening balance does not equal previous closing balance.",
            "opening_balance <> previous_closing_balance",
        ),
    ),
)

BOOKS = {
    "branch": BRANCH_BOOK,
    "customer": CUSTOMER_BOOK,
    "account": ACCOUNT_BOOK,
    "transaction": TRANSACTION_BOOK,
    "daily_balance": BALANCE_BOOK,
}

# The same rules for tables known to hold every key once, because they were grouped by it or kept to newest versions.
KEYED_BOOKS = BOOKS | {"daily_balance": replace(BALANCE_BOOK, prepare=with_previous_closing_by_key, by_version=False)}

# Rules run on the source tables before migration. The closed-account rule looks at the source account table.
SOURCE_CUSTOMER_BOOK = RuleBook(
    entity=CUSTOMER,
    accepts=CUSTOMER_BOOK.accepts,
    rules=(
        CUSTOMER_BOOK.rule("CUSTOMER_DOB_NOT_FUTURE"),
        Rule(
            "CUSTOMER_EMAIL_FORMAT", HIGH, "Customer email does not match the required format.",
            f"NOT ({GOOD_EMAIL})",
        ),
    ),
)

SOURCE_TRANSACTION_BOOK = RuleBook(
    entity=TRANSACTION,
    lookups=(Lookup("source_account", "source_account_id", "account", "account_id", earliest_closure("status")),),
    accepts=(APPROVED, f"NOT coalesce({CLOSED_BEFORE_USE}, FALSE)"),
    rules=(
        Rule(
            "TRANSACTION_CURRENCY_REFERENCE", HIGH,
            "Transaction currency is not present in the approved reference list.", f"NOT ({APPROVED})",
        ),
        TRANSACTION_BOOK.rule("CLOSED_ACCOUNT_TRANSACTION"),
    ),
)
