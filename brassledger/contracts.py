"""Column contracts, value domains and other fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: raw column contracts, in file order (every column is text)
RAW_TRANSACTION = (
    "transaction_id",
    "transaction_timestamp",
    "source_account_id",
    "counterparty_id",
    "transaction_type",
    "amount",
    "channel",
    "merchant_category",
    "branch_id",
    "transaction_status",
    "balance_before",
    "balance_after",
    "is_fraud_flag",
)
RAW_ACCOUNT = ("account_id", "customer_id", "account_type", "open_date", "account_status", "current_balance")
RAW_CUSTOMER = (
    "customer_id",
    "customer_since",
    "state",
    "customer_segment",
    "risk_tier",
    "digital_enrolled_flag",
    "home_branch_id",
)
RAW_BRANCH = ("branch_id", "branch_name", "city", "state", "region")

# --- fixed values: domains
TRANSACTION_TYPES = ("DEPOSIT", "WITHDRAWAL", "PAYMENT", "TRANSFER", "DEBIT")
CHANNELS = ("MOBILE", "ONLINE", "ATM", "BRANCH", "POS")
TRANSACTION_STATUSES = ("POSTED", "FAILED", "REVERSED")
ACCOUNT_STATUSES = ("ACTIVE", "DORMANT", "CLOSED", "FROZEN")
DIGITAL = ("MOBILE", "ONLINE")

# --- fixed values: text patterns and the money type
MONEY = "decimal(18,2)"
TIMESTAMP_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"
STREAM_MARK = "source=stream"

# --- fixed values: row-level reason codes -> (dimension, business rule)
REASONS = {
    "NULL_TXN_ID": ("Completeness", "Every transaction has an ID"),
    "NULL_ACCOUNT": ("Completeness", "Every transaction has a source account"),
    "NULL_CHANNEL": ("Completeness", "Every transaction has a channel"),
    "ORPHAN_ACCOUNT": ("Referential integrity", "Source account exists in account master"),
    "NON_POSITIVE_AMOUNT": ("Validity", "Amount is greater than zero"),
    "INVALID_AMOUNT": ("Validity", "Amount is numeric"),
    "INVALID_TYPE": ("Validity", "Type is an approved transaction type"),
    "INVALID_CHANNEL": ("Validity", "Channel is an approved channel"),
    "INVALID_STATUS": ("Validity", "Status is POSTED, FAILED or REVERSED"),
    "INVALID_TIMESTAMP": ("Validity", "Timestamp is parseable"),
    "FUTURE_TIMESTAMP": ("Timeliness", "Timestamp is not in the future"),
    "DUPLICATE_TXN_ID": ("Uniqueness", "One record per transaction ID"),
}

# A line with too few or too many fields.  Its values cannot be told apart, so the line itself is kept in a column of
# this name (NULL for well-formed rows) and the row has this one reason.  Not one of the fixed codes above: the
# scorecard shows it when it occurs.
RAW_LINE = "malformed_line"
LINE_REASONS = {"MALFORMED_LINE": ("Validity", "Every line has the fields of its contract")}

# --- fixed values: pipeline status and dataset names
PUBLISHED = "PUBLISHED"
BLOCKED = "BLOCKED_BY_QUALITY_GATE"
RAW_DATASET = "raw_transactions"
CURATED_DATASET = "curated_transactions"

# Columns the rule set looks at, on raw and on curated data alike.
RULE_COLUMNS = (
    "transaction_id",
    "transaction_ts",
    "source_account_id",
    "transaction_type",
    "amount",
    "channel",
    "transaction_status",
)

# --- fixed values: published table layouts, in column order
FACT_DDL = """
    transaction_id string, transaction_ts timestamp_ntz, transaction_date date, transaction_hour int,
    source_account_id string, customer_id string, account_type string, counterparty_id string,
    transaction_type string, flow_direction string, amount decimal(18,2), signed_amount decimal(18,2),
    channel string, digital_channel_flag boolean, merchant_category string, branch_id string,
    transaction_status string, is_failed boolean, balance_before decimal(18,2),
    balance_after decimal(18,2), is_fraud_flag int, ingest_source string, source_file string, run_id string
"""
CUSTOMER_DDL = """
    customer_id string, customer_since date, state string, customer_segment string, risk_tier string,
    digital_enrolled_flag boolean, home_branch_id string, tenure_years double
"""
ACCOUNT_DDL = """
    account_id string, customer_id string, account_type string, open_date date, account_status string,
    current_balance decimal(18,2)
"""
BRANCH_DDL = "branch_id string, branch_name string, city string, state string, region string"
QUARANTINE_DDL = """
    transaction_id string, transaction_ts timestamp_ntz, source_account_id string, counterparty_id string,
    transaction_type string, amount decimal(18,2), channel string, merchant_category string,
    branch_id string, transaction_status string, balance_before decimal(18,2), balance_after decimal(18,2),
    is_fraud_flag int, ingest_source string, source_file string, raw_transaction_timestamp string,
    raw_amount string, dq_fail_reasons string, run_id string, quarantined_at timestamp_ntz
"""
MALFORMED_DDL = """
    malformed_line string, ingest_source string, source_file string, run_id string, quarantined_at timestamp_ntz
"""
OUTCOME_DDL = """
    run_id string, run_ts timestamp_ntz, dataset string, rule string, outcome string,
    failure_reason string, evaluated_metrics string
"""
SUMMARY_DDL = """
    run_id string, run_ts timestamp_ntz, raw_rows bigint, curated_rows bigint, quarantined_rows bigint,
    quarantine_rate double, max_quarantine_rate double, raw_dq_score double, curated_dq_score double,
    accounts_quarantined bigint, pipeline_status string
"""
REASON_COUNT_DDL = "reason string, ingest_source string, row_count bigint, run_id string, run_ts timestamp_ntz"
AUDIT_DDL = "loaded_at timestamp_ntz, table_name string, rows_loaded bigint"


# Column documentation; `publish` writes it into the tables' schemas.
COMMENTS = {
    "fact_transactions": {
        "transaction_id": "Key; the newest delivered version is kept",
        "transaction_ts": "When it happened, wall clock in UTC",
        "transaction_date": "Day of transaction_ts",
        "transaction_hour": "Hour of transaction_ts, 0 to 23",
        "source_account_id": "Account the movement belongs to; known to the account master",
        "customer_id": "Owner of that account",
        "account_type": "Type of that account",
        "counterparty_id": "Other side: C... a customer, M... a merchant",
        "transaction_type": "One of the five approved types",
        "flow_direction": "INFLOW for deposits, OUTFLOW for the rest",
        "amount": "Size of the movement, above zero",
        "signed_amount": "Amount with its sign; sums to net flow",
        "channel": "One of the five approved channels",
        "digital_channel_flag": "True for the mobile and online channels",
        "merchant_category": "Filled for payments and debits",
        "branch_id": "Filled for the branch and ATM channels",
        "transaction_status": "One of the three approved statuses",
        "is_failed": "True when the status is FAILED",
        "balance_before": "Account balance before the movement",
        "balance_after": "Account balance after the movement",
        "is_fraud_flag": "1 where the source labels the row as fraud",
        "ingest_source": "BATCH or STREAM",
        "source_file": "File the row was read from",
        "run_id": "Run that published the row",
    },
    "dim_customer": {
        "customer_id": "Key",
        "customer_since": "First day of the relationship",
        "state": "State of residence",
        "customer_segment": "Commercial segment",
        "risk_tier": "LOW, MEDIUM or HIGH",
        "digital_enrolled_flag": "Signed up for digital banking",
        "home_branch_id": "Main branch",
        "tenure_years": "Years since customer_since at the run's clock",
    },
    "dim_account": {
        "account_id": "Key",
        "customer_id": "Owner",
        "account_type": "Type of account",
        "open_date": "Day the account was opened",
        "account_status": "One of the four approved statuses",
        "current_balance": "Ledger balance",
    },
    "dim_branch": {"branch_id": "Key", "branch_name": "Display name", "region": "Sales region"},
}


def text_schema(columns) -> T.StructType:
    """A schema of nullable text columns, for files that must never be inferred."""
    schema = T.StructType()
    for name in columns:
        schema = schema.add(name, T.StringType(), nullable=True)
    return schema


def layout(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def layout_columns(ddl: str) -> list[str]:
    return layout(ddl).fieldNames()
