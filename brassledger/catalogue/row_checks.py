"""Row validation with reason codes: one query per check, then the whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from brassledger.catalogue.core import query
from brassledger.catalogue.ingest import zone

SHOWN = (
    "transaction_id", "source_account_id", "raw_amount", "raw_transaction_timestamp", "transaction_type",
    "channel", "transaction_status", "ingest_source",
)


def _found(checked, reason: str):
    return checked.filter(F.array_contains("dq_fail_reasons", reason)).select(*SHOWN)


def _register(reason: str, where: str) -> None:
    @query(f"dq_{reason.lower()}", f"SELECT {', '.join(SHOWN)} FROM std WHERE {where}")
    def rows_with_reason(ws):
        return _found(ws.run.checked, reason)


_register("NULL_TXN_ID", "transaction_id IS NULL")
_register("NULL_ACCOUNT", "source_account_id IS NULL")
_register("ORPHAN_ACCOUNT", "source_account_id NOT IN (SELECT account_id FROM all_account)")
_register("NON_POSITIVE_AMOUNT", "amount <= 0")
_register("INVALID_TIMESTAMP", "transaction_ts IS NULL")
_register("FUTURE_TIMESTAMP", "transaction_ts > TIMESTAMP '2024-02-01'")
_register(
    "INVALID_TYPE",
    "coalesce(transaction_type, '') NOT IN ('DEPOSIT', 'WITHDRAWAL', 'PAYMENT', 'TRANSFER', 'DEBIT')",
)
_register("NULL_CHANNEL", "channel IS NULL")


def _register_broken(reason: str, column: str, bad: str, span: str) -> None:
    shown = ", ".join(f"{bad} AS {c}" if c == column else c for c in SHOWN)

    @query(f"dq_{reason.lower()}", f"SELECT {shown} FROM std WHERE n % 2000 BETWEEN {span}")
    def rows_with_reason(ws):
        return _found(ws.broken_run.checked, reason)


_register_broken("INVALID_AMOUNT", "raw_amount", "if(n % 2 = 0, '12,50', 'abc')", "32 AND 33")
_register_broken("INVALID_CHANNEL", "channel", "if(n % 2 = 0, 'FAX', 'KIOSK')", "34 AND 35")
_register_broken("INVALID_STATUS", "transaction_status", "if(n % 2 = 0, 'PENDING', NULL)", "36 AND 38")


@query(
    "dq_duplicate_txn_id",
    """SELECT transaction_id, transaction_ts, ingest_source FROM flagged
       WHERE list_contains(reasons, 'DUPLICATE_TXN_ID')""",
)
def dq_duplicate_txn_id(ws):
    repeats = ws.run.flagged.filter(F.array_contains("dq_fail_reasons", "DUPLICATE_TXN_ID"))
    return repeats.select("transaction_id", "transaction_ts", "ingest_source")


@query(
    "dq_reason_array",
    """SELECT transaction_id, len(found)::INTEGER AS reason_count, array_to_string(found, ',') AS reasons
       FROM checked""",
)
def dq_reason_array(ws):
    return ws.run.checked.select(
        "transaction_id",
        F.size("dq_fail_reasons").alias("reason_count"),
        F.concat_ws(",", "dq_fail_reasons").alias("reasons"),
    )


@query(
    "flag_transactions",
    """SELECT transaction_id, transaction_ts, source_account_id, amount, ingest_source,
              array_to_string(reasons, ',') AS dq_fail_reasons FROM flagged""",
)
def flag_transactions(ws):
    """From the raw files, read once, to flagged rows."""
    return ws.new_run().flagged.select(
        "transaction_id", "transaction_ts", "source_account_id", "amount", "ingest_source",
        F.concat_ws(",", "dq_fail_reasons").alias("dq_fail_reasons"),
    )


@query(
    "split_valid",
    """SELECT transaction_id, transaction_ts, source_account_id, counterparty_id, transaction_type, amount, channel,
              merchant_category, branch_id, transaction_status, balance_before, balance_after, is_fraud_flag,
              ingest_source FROM flagged WHERE len(reasons) = 0""",
)
def split_valid(ws):
    return ws.run.valid.drop("owner", "source_file")


@query(
    "split_quarantine",
    """SELECT * REPLACE (regexp_extract(source_file, '(source=[a-z]+)', 1) AS source_file) FROM quarantine""",
)
def split_quarantine(ws):
    return ws.run.quarantine.withColumn("source_file", zone())


@query(
    "account_status_quarantine",
    """SELECT *, 'INVALID_ACCOUNT_STATUS' AS dq_fail_reason, '20240201T000000Z' AS run_id,
              TIMESTAMP '2024-02-01' AS quarantined_at
       FROM all_account WHERE coalesce(account_status, '') NOT IN ('ACTIVE', 'DORMANT', 'CLOSED', 'FROZEN')""",
)
def account_status_quarantine(ws):
    return ws.masters.account_quarantine


@query("quarantine_reason_counts", "SELECT * FROM reason_history WHERE run_id = '20240201T000000Z'")
def quarantine_reason_counts(ws):
    """From the raw files, read once, to counts."""
    return ws.new_run().reasons
