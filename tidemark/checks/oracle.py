"""Independent SQL for the registered queries, written by hand in the dialect of the comparison engine.

``PRELUDE`` spells out the bank views, the raw layer, the accepted rows and the quarantine as common table
expressions. Money, dates and instants are rendered as text in the results, as on the Spark side.
"""

from __future__ import annotations

from tidemark.schemas import SOURCE_SYSTEM

BATCH = "B-0001"
INGESTED = "2026-07-27 00:00:00"
REJECTED = "2026-07-28 00:00:00"
RUN_AT = "2026-07-29 00:00:00"
AS_OF = "2026-07-26"

# -- bank views -------------------------------------------------------------------------------------------------

SOURCES = {
    "src_branch": """
        SELECT CAST(n_nationkey AS BIGINT) AS branch_id,
               CASE WHEN n_nationkey % 12 = 11 THEN '   '
                    ELSE ' NB-' || lpad(CAST(n_nationkey AS VARCHAR), greatest(3, length(CAST(n_nationkey AS VARCHAR)))::INT, '0') || ' ' END AS branch_code,
               CASE WHEN n_nationkey % 20 <> 19 THEN n_name END AS branch_name,
               ' City ' || n_nationkey AS city,
               r_name || ' State ' AS state,
               ' ' || lower(r_name) || ' ' AS operating_region,
               CASE WHEN n_nationkey % 20 <> 13 THEN DATE '1995-01-01' + n_nationkey END AS opened_date,
               CASE WHEN n_nationkey % 8 = 7 THEN 'SUSPENDED'
                    WHEN n_nationkey = 6 THEN NULL
                    ELSE (['ACTIVE', 'INACTIVE', 'CLOSED'])[1 + n_nationkey % 3] END AS status,
               CAST(DATE '1995-01-01' + n_nationkey AS TIMESTAMP) AS created_at,
               CAST(DATE '1995-01-31' + n_nationkey AS TIMESTAMP) AS updated_at
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "src_customer": """
        SELECT c_custkey AS customer_id,
               ' CN-' || c_custkey AS customer_number,
               c_name || '  ' AS full_name,
               CASE WHEN c_custkey % 211 <> 210
                    THEN DATE '1990-01-01' + CAST(c_custkey * 97 % 14000 AS INTEGER) END AS date_of_birth,
               CASE WHEN c_custkey % 50 = 0 THEN 'invalid-email'
                    WHEN c_custkey % 77 <> 5 THEN c_name || '@Example.com ' END AS email,
               CASE WHEN c_custkey % 9 <> 4 THEN '+91' || lpad(CAST(c_custkey AS VARCHAR), greatest(10, length(CAST(c_custkey AS VARCHAR)))::INT, '0') END AS phone,
               c_mktsegment AS address_line_1,
               CAST(NULL AS VARCHAR) AS address_line_2,
               CASE WHEN c_custkey % 13 <> 0 THEN 'City ' || c_nationkey END AS city,
               'State ' || c_nationkey AS state,
               lpad(CAST(c_nationkey AS VARCHAR), greatest(6, length(CAST(c_nationkey AS VARCHAR)))::INT, '0') AS postal_code,
               CASE WHEN c_custkey % 333 = 7 THEN 'in' ELSE 'IN' END AS country_code,
               (['PENDING', 'VERIFIED', 'REVIEW_REQUIRED', 'REJECTED'])[1 + c_custkey % 4] AS kyc_status,
               CASE WHEN c_custkey % 401 = 100 THEN 'UNKNOWN'
                    ELSE (['ACTIVE', 'INACTIVE', 'BLOCKED', 'CLOSED'])[1 + c_custkey % 4] END AS customer_status,
               TIMESTAMP '2015-01-01' + to_minutes(c_custkey) AS created_at,
               TIMESTAMP '2015-01-01' + to_minutes(c_custkey)
                 - CASE WHEN c_custkey % 499 = 98 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS updated_at
        FROM customer""",
    "src_account": """
        SELECT o_orderkey AS account_id,
               ' AC-' || lpad(CAST(o_orderkey AS VARCHAR), greatest(12, length(CAST(o_orderkey AS VARCHAR)))::INT, '0') || ' ' AS account_number,
               o_custkey AS customer_id,
               CASE WHEN o_orderkey % 1013 <> 1012 THEN o_orderkey % 26 END AS branch_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'SAVINGS' WHEN '2-HIGH' THEN 'CURRENT'
                    WHEN '3-MEDIUM' THEN 'LOAN' WHEN '5-LOW' THEN 'CREDIT_CARD'
                    ELSE CASE WHEN o_orderkey % 5 = 0 THEN 'NOT SPECIFIED' ELSE 'SAVINGS' END END AS account_type,
               CASE WHEN o_orderkey % 40 = 3 THEN 'USD' WHEN o_orderkey % 500 = 77 THEN 'inr'
                    WHEN o_orderkey % 1000 <> 999 THEN 'INR' END AS currency_code,
               CAST(o_orderdate AS DATE) AS opened_date,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE)
                    + CASE WHEN o_orderkey % 61 = 0 THEN -1 ELSE CAST(o_orderkey % 2500 AS INTEGER) END END AS closed_date,
               CASE o_orderstatus WHEN 'F' THEN 'CLOSED'
                    WHEN 'O' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'ACTIVE' ELSE 'FROZEN' END
                    ELSE CASE WHEN o_orderkey % 11 = 0 THEN 'PENDING' ELSE 'DORMANT' END END AS status,
               o_orderdate AS created_at,
               CASE WHEN o_orderkey % 700 = 699 THEN o_orderdate - INTERVAL 1 DAY
                    ELSE o_orderdate + to_minutes(o_orderkey % 1440) END AS updated_at
        FROM orders""",
    "line_identity": """
        SELECT *, CAST(l_extendedprice AS DECIMAL(18, 2)) AS price,
               l_shipdate + to_seconds(l_linenumber * 3661) AS ts
        FROM lineitem""",
    "src_transaction": """
        SELECT CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, price,
                    date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)))), 1, 15) AS BIGINT) AS transaction_id,
               l_orderkey AS source_account_id,
               l_partkey AS destination_account_id,
               ts AS transaction_ts,
               CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'transfer'
                    WHEN l_returnflag = 'R' AND l_linenumber = 6 THEN 'REFUND'
                    WHEN l_returnflag = 'R' OR (l_returnflag = 'A' AND l_linestatus = 'O') THEN 'TRANSFER'
                    WHEN l_returnflag = 'A' THEN 'CARD_PAYMENT'
                    WHEN l_linestatus = 'O' THEN 'CASH_WITHDRAWAL'
                    ELSE 'DIRECT_DEBIT' END AS transaction_type,
               CAST(CASE WHEN l_quantity = 50 AND l_linenumber = 1 THEN -price
                         WHEN l_quantity = 50 AND l_linenumber = 2 THEN 0 ELSE price END AS DECIMAL(18, 2)) AS amount,
               CASE WHEN l_partkey % 200 = 0 THEN 'ZZZ' WHEN l_partkey % 300 = 1 THEN 'inr' ELSE 'INR' END
                 AS currency_code,
               CASE WHEN l_suppkey % 97 = 96 THEN 'KIOSK'
                    ELSE (['MOBILE', 'ONLINE', 'ATM', 'BRANCH', 'CARD'])[1 + l_suppkey % 5] END AS payment_channel,
               l_quantity >= 49 AS aml_flag,
               CASE WHEN l_linenumber = 7 AND l_suppkey % 10 = 0 THEN ts - INTERVAL 1 HOUR ELSE ts END AS created_at,
               CASE WHEN l_linenumber = 7 AND l_suppkey % 10 = 0 THEN ts ELSE ts + INTERVAL 1 HOUR END AS updated_at
        FROM line_identity""",
    "legs": """
        SELECT source_account_id AS account_id, CAST(transaction_ts AS DATE) AS business_date,
               amount AS debit, CAST(0 AS DECIMAL(18, 2)) AS credit FROM src_transaction
        UNION ALL
        SELECT destination_account_id, CAST(transaction_ts AS DATE), 0, amount FROM src_transaction""",
    "movements": """
        SELECT account_id, business_date, CAST(sum(debit) AS DECIMAL(18, 2)) AS debit_total,
               CAST(sum(credit) AS DECIMAL(18, 2)) AS credit_total
        FROM legs GROUP BY ALL""",
    "running": """
        SELECT *, CAST(10000 + 100 * account_id + sum(credit_total - debit_total)
                  OVER (PARTITION BY account_id ORDER BY business_date) AS DECIMAL(18, 2)) AS clean_closing
        FROM movements""",
    "src_daily_balance": """
        SELECT account_id, business_date,
               CAST(clean_closing - credit_total + debit_total AS DECIMAL(18, 2)) AS opening_balance,
               debit_total, credit_total,
               CAST(clean_closing + CASE WHEN (account_id + day(business_date)) % 50 = 0 THEN 1 ELSE 0 END
                    AS DECIMAL(18, 2)) AS closing_balance,
               business_date + INTERVAL '23 hours 59 minutes' AS created_at,
               business_date + INTERVAL '23 hours 59 minutes' AS updated_at
        FROM running""",
    "event_txn": """
        SELECT event_id AS transaction_id, user_id AS source_account_id,
               user_id + 1 + event_id % 7 AS destination_account_id, ts AS transaction_ts,
               CAST(value AS DECIMAL(18, 2)) AS amount
        FROM events""",
    "event_legs": """
        SELECT source_account_id AS account_id, CAST(transaction_ts AS DATE) AS business_date, amount AS debit,
               CAST(0 AS DECIMAL(18, 2)) AS credit FROM event_txn
        UNION ALL SELECT destination_account_id, CAST(transaction_ts AS DATE), 0, amount FROM event_txn""",
    "event_movements": """
        SELECT account_id, business_date, CAST(sum(debit) AS DECIMAL(18, 2)) AS debit_total,
               CAST(sum(credit) AS DECIMAL(18, 2)) AS credit_total
        FROM event_legs GROUP BY ALL""",
    "event_balance": """
        SELECT *, CAST(closing_balance - credit_total + debit_total AS DECIMAL(18, 2)) AS opening_balance
        FROM (SELECT *, CAST(10000 + 100 * account_id + sum(credit_total - debit_total)
                        OVER (PARTITION BY account_id ORDER BY business_date) AS DECIMAL(18, 2)) AS closing_balance
              FROM event_movements)""",
    "event_broken": """
        SELECT * REPLACE (CAST(closing_balance + CASE WHEN (account_id + day(business_date)) % 50 = 0
                               THEN 1 ELSE 0 END AS DECIMAL(18, 2)) AS closing_balance)
        FROM event_balance""",
}

# -- raw layer --------------------------------------------------------------------------------------------------

#: An instant as text with the non-zero digits of its fraction, without and with the zone offset.
INSTANT = "CAST(CAST({0} AS TIMESTAMP) AS VARCHAR)"
STAMP = INSTANT + " || '+00'"


def _raw(name: str, table: str, key: str, hashed: str) -> str:
    return f"""
        SELECT *, '{BATCH}' AS migration_batch_id, '{SOURCE_SYSTEM}' AS source_system,
               '{table}' AS source_table, {key} AS source_record_key, updated_at AS source_updated_at,
               TIMESTAMP '{INGESTED}' AS ingested_at, sha256(concat_ws('|', {hashed})) AS record_hash,
               '1.0' AS schema_version, FALSE AS is_deleted
        FROM src_{name}"""


RAW = {
    "raw_branch": _raw(
        "branch", "core.branch", "CAST(branch_id AS VARCHAR)",
        "branch_id, branch_code, branch_name, city, state, operating_region, opened_date, status",
    ),
    "raw_customer": _raw(
        "customer", "core.customer", "CAST(customer_id AS VARCHAR)",
        "customer_id, customer_number, full_name, date_of_birth, coalesce(email, ''), coalesce(phone, ''), "
        "country_code, kyc_status, customer_status",
    ),
    "raw_account": _raw(
        "account", "core.account", "CAST(account_id AS VARCHAR)",
        "account_id, account_number, customer_id, branch_id, account_type, currency_code, opened_date, "
        "coalesce(CAST(closed_date AS VARCHAR), ''), status",
    ),
    "raw_transaction": _raw(
        "transaction", "payments.bank_transaction", "CAST(transaction_id AS VARCHAR)",
        f"transaction_id, source_account_id, destination_account_id, {STAMP.format('transaction_ts')}, "
        "transaction_type, amount, currency_code, payment_channel, aml_flag",
    ),
    "raw_daily_balance": _raw(
        "daily_balance", "finance.daily_account_balance", "concat_ws('|', account_id, business_date)",
        "account_id, business_date, opening_balance, debit_total, credit_total, closing_balance",
    ),
    "chained_balance": """
        SELECT *, lag(closing_balance) OVER (PARTITION BY account_id ORDER BY business_date) AS previous_closing
        FROM raw_daily_balance""",
}

LINEAGE = (
    "migration_batch_id, source_system, source_table, source_record_key, source_updated_at, ingested_at, "
    "record_hash, schema_version, is_deleted"
)

# -- accepted rows ----------------------------------------------------------------------------------------------

_CLOSED_EARLIER = """SELECT 1 FROM stg_account a WHERE a.account_id = r.source_account_id
    AND a.account_status = 'CLOSED' AND a.closed_date < CAST(r.transaction_ts AS DATE)"""

STAGING = {
    "stg_branch": f"""
        SELECT branch_id, trim(branch_code) AS branch_code, trim(branch_name) AS branch_name, trim(city) AS city,
               trim(state) AS state, upper(trim(operating_region)) AS operating_region, opened_date,
               upper(status) AS branch_status, {LINEAGE}
        FROM raw_branch
        WHERE branch_id IS NOT NULL AND trim(branch_code) <> '' AND trim(branch_name) <> ''
          AND opened_date IS NOT NULL AND status IN ('ACTIVE', 'INACTIVE', 'CLOSED')""",
    "stg_customer": f"""
        SELECT customer_id, trim(customer_number) AS customer_number, trim(full_name) AS customer_name,
               date_of_birth, lower(trim(email)) AS email_normalised, phone, country_code, kyc_status,
               customer_status, {LINEAGE}
        FROM raw_customer
        WHERE date_of_birth <= DATE '{AS_OF}' AND coalesce(email LIKE '%_@_%._%', TRUE)""",
    "stg_account": f"""
        SELECT account_id, trim(account_number) AS account_number, customer_id, branch_id,
               upper(account_type) AS account_type, upper(currency_code) AS currency_code, opened_date, closed_date,
               upper(status) AS account_status, {LINEAGE}
        FROM raw_account
        WHERE customer_id IN (SELECT customer_id FROM stg_customer) AND currency_code = 'INR'
          AND (closed_date IS NULL OR closed_date >= opened_date)
          AND account_type IN ('SAVINGS', 'CURRENT', 'LOAN', 'CREDIT_CARD')
          AND status IN ('ACTIVE', 'DORMANT', 'FROZEN', 'CLOSED')""",
    "stg_transaction": f"""
        SELECT transaction_id, source_account_id, destination_account_id,
               transaction_ts AS transaction_timestamp_utc, upper(transaction_type) AS transaction_type,
               amount AS transaction_amount, upper(currency_code) AS currency_code,
               upper(payment_channel) AS payment_channel, aml_flag AS is_aml_flagged, {LINEAGE}
        FROM raw_transaction r
        WHERE source_account_id IN (SELECT account_id FROM stg_account)
          AND destination_account_id IN (SELECT account_id FROM stg_account)
          AND amount > 0 AND currency_code = 'INR' AND source_account_id <> destination_account_id
          AND transaction_type IN ('TRANSFER', 'CARD_PAYMENT', 'CASH_WITHDRAWAL', 'DIRECT_DEBIT')
          AND payment_channel IN ('MOBILE', 'ONLINE', 'ATM', 'BRANCH', 'CARD')
          AND NOT EXISTS ({_CLOSED_EARLIER})""",
    "stg_daily_balance": f"""
        SELECT account_id, business_date, opening_balance, debit_total, credit_total, closing_balance, {LINEAGE}
        FROM chained_balance
        WHERE account_id IN (SELECT account_id FROM stg_account) AND debit_total >= 0 AND credit_total >= 0
          AND opening_balance + credit_total - debit_total = closing_balance
          AND (previous_closing IS NULL OR previous_closing = opening_balance)""",
}

# -- quarantine -------------------------------------------------------------------------------------------------


def _payload(*columns: str) -> str:
    items = [f"'{c}', " + (STAMP.format(c) if c.endswith(("_ts", "_at")) else c) for c in columns]
    return f"CAST(json_object({', '.join(items)}) AS VARCHAR)"


# Fields of a payload, in order.
PAYLOADS = {
    "branch": _payload(
        "branch_id", "branch_code", "branch_name", "city", "state", "operating_region", "opened_date", "status"
    ),
    "customer": _payload(
        "customer_id", "customer_number", "full_name", "date_of_birth", "email", "phone", "country_code",
        "kyc_status", "customer_status",
    ),
    "account": _payload(
        "account_id", "account_number", "customer_id", "branch_id", "account_type", "currency_code", "opened_date",
        "closed_date", "status",
    ),
    "transaction": _payload(
        "transaction_id", "source_account_id", "destination_account_id", "transaction_ts", "transaction_type",
        "amount", "currency_code", "payment_channel", "aml_flag",
    ),
    "daily_balance": _payload(
        "account_id", "business_date", "opening_balance", "debit_total", "credit_total", "closing_balance"
    ),
}

# Rules, severities and messages. (table, rule, severity, message, condition on a row r of the raw table)
RULES = [
    ("branch", "BRANCH_CODE_REQUIRED", "HIGH", "Branch code is missing or blank.",
     "coalesce(trim(branch_code), '') = ''"),
    ("branch", "BRANCH_NAME_REQUIRED", "HIGH", "Branch name is missing or blank.",
     "coalesce(trim(branch_name), '') = ''"),
    ("branch", "BRANCH_OPENED_DATE_REQUIRED", "HIGH", "Branch opened_date is missing.", "opened_date IS NULL"),
    ("branch", "BRANCH_STATUS_REFERENCE", "HIGH", "Branch status is not approved.",
     "status NOT IN ('ACTIVE', 'INACTIVE', 'CLOSED')"),
    ("customer", "CUSTOMER_DOB_NOT_FUTURE", "HIGH", "Customer date of birth is in the future.",
     f"date_of_birth > DATE '{AS_OF}'"),
    ("customer", "CUSTOMER_EMAIL_FORMAT", "HIGH", "Customer email format is invalid.",
     "email NOT LIKE '%_@_%._%'"),
    ("account", "ACCOUNT_CUSTOMER_REFERENCE", "CRITICAL",
     "Account customer_id does not resolve to a valid customer.",
     "NOT EXISTS (FROM stg_customer c WHERE c.customer_id = r.customer_id)"),
    ("account", "ACCOUNT_CURRENCY_REFERENCE", "HIGH", "Account currency is not in the approved currency list.",
     "currency_code <> 'INR'"),
    ("account", "ACCOUNT_DATE_RANGE", "HIGH", "Account closed_date is earlier than opened_date.",
     "closed_date < opened_date"),
    ("account", "ACCOUNT_TYPE_REFERENCE", "HIGH", "Account type is not approved.",
     "account_type NOT IN ('SAVINGS', 'CURRENT', 'LOAN', 'CREDIT_CARD')"),
    ("account", "ACCOUNT_STATUS_REFERENCE", "HIGH", "Account status is not approved.",
     "status NOT IN ('ACTIVE', 'DORMANT', 'FROZEN', 'CLOSED')"),
    ("account", "ACCOUNT_BRANCH_REFERENCE", "HIGH", "Account branch_id does not resolve to a valid branch.",
     "NOT EXISTS (FROM stg_branch b WHERE b.branch_id = r.branch_id)"),
    ("transaction", "TRANSACTION_SOURCE_ACCOUNT_REFERENCE", "CRITICAL",
     "Source account does not resolve to a valid account.",
     "NOT EXISTS (FROM stg_account a WHERE a.account_id = r.source_account_id)"),
    ("transaction", "TRANSACTION_DESTINATION_ACCOUNT_REFERENCE", "CRITICAL",
     "Destination account does not resolve to a valid account.",
     "NOT EXISTS (FROM stg_account a WHERE a.account_id = r.destination_account_id)"),
    ("transaction", "TRANSACTION_AMOUNT_POSITIVE", "HIGH", "Transaction amount must be greater than zero.",
     "amount <= 0"),
    ("transaction", "TRANSACTION_CURRENCY_REFERENCE", "HIGH",
     "Transaction currency is not in the approved currency list.", "currency_code <> 'INR'"),
    ("transaction", "TRANSACTION_ACCOUNTS_DIFFER", "HIGH", "Source and destination accounts must be different.",
     "source_account_id = destination_account_id"),
    ("transaction", "TRANSACTION_TYPE_REFERENCE", "HIGH", "Transaction type is not approved.",
     "transaction_type NOT IN ('TRANSFER', 'CARD_PAYMENT', 'CASH_WITHDRAWAL', 'DIRECT_DEBIT')"),
    ("transaction", "TRANSACTION_CHANNEL_REFERENCE", "HIGH", "Payment channel is not approved.",
     "payment_channel NOT IN ('MOBILE', 'ONLINE', 'ATM', 'BRANCH', 'CARD')"),
    ("transaction", "CLOSED_ACCOUNT_TRANSACTION", "HIGH",
     "Transaction occurred after the source account was closed.", f"EXISTS ({_CLOSED_EARLIER})"),
    ("daily_balance", "BALANCE_ACCOUNT_REFERENCE", "CRITICAL",
     "Balance account_id does not resolve to a valid account.",
     "NOT EXISTS (FROM stg_account a WHERE a.account_id = r.account_id)"),
    ("daily_balance", "BALANCE_DEBIT_NON_NEGATIVE", "HIGH", "Debit total must be non-negative.", "debit_total < 0"),
    ("daily_balance", "BALANCE_CREDIT_NON_NEGATIVE", "HIGH", "Credit total must be non-negative.",
     "credit_total < 0"),
    ("daily_balance", "BALANCE_EQUATION", "CRITICAL",
     "Opening balance plus credits minus debits does not equal closing balance.",
     "opening_balance + credit_total - debit_total <> closing_balance"),
    ("daily_balance", "BALANCE_ROLL_FORWARD", "CRITICAL",
     "Current opening balance does not equal previous closing balance.", "opening_balance <> previous_closing"),
]


def _rejections(table: str) -> str:
    origin = "chained_balance" if table == "daily_balance" else f"raw_{table}"
    return " UNION ALL ".join(
        f"""
        SELECT migration_batch_id, source_system, source_table, source_record_key, '{rule}' AS rule_id,
               '{severity}' AS severity, '{message}' AS error_message, {PAYLOADS[table]} AS raw_payload,
               '{REJECTED}' AS rejected_at, 'OPEN' AS resolution_status
        FROM {origin} r WHERE {condition}"""
        for owner, rule, severity, message, condition in RULES
        if owner == table
    )


QUARANTINE = {f"rej_{t}": _rejections(t) for t in ("branch", "customer", "account", "transaction", "daily_balance")}

PRELUDE = {**SOURCES, **RAW, **STAGING, **QUARANTINE}


def with_prelude(select: str, **more: str) -> str:
    """A complete statement: only the expressions that ``select`` needs, in dependency order, then the query."""
    available = {**PRELUDE, **more}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in available:
            if name not in needed and _mentions(text, name):
                needed.add(name)
                visit(available[name])

    visit(select)
    parts = ",\n".join(f"{name} AS ({body})" for name, body in available.items() if name in needed)
    return f"WITH {parts}\n{select}" if parts else select


def _mentions(text: str, name: str) -> bool:
    at = text.find(name)
    while at >= 0:
        before = text[at - 1] if at else " "
        after = text[at + len(name)] if at + len(name) < len(text) else " "
        if not (before.isalnum() or before in "_.'") and not (after.isalnum() or after in "_'"):
            return True
        at = text.find(name, at + 1)
    return False


def text(*columns: str) -> str:
    """Columns rendered as text under their own names."""
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


def moment(*columns: str) -> str:
    """Instants rendered as text, fractions included."""
    return ", ".join(f"{INSTANT.format(c)} AS {c}" for c in columns)
