"""Projections, filters, predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger.catalogue.core import query
from brassledger.catalogue.ingest import zone
from brassledger.functions import columns as C
from brassledger.operators import enrich
from brassledger.plans import analysis


@query(
    "clean_code",
    """SELECT nullif(transaction_id, '') AS transaction_id, nullif(upper(trim(channel)), '') AS channel,
              nullif(upper(trim(transaction_type)), '') AS transaction_type FROM raw""",
)
def clean_code(ws):
    return ws.raw.transactions.select(
        "transaction_id", C.code("channel").alias("channel"), C.code("transaction_type").alias("transaction_type")
    )


@query(
    "clean_text",
    "SELECT nullif(transaction_id, '') AS transaction_id, nullif(trim(channel), '') AS channel_text FROM raw",
)
def clean_text(ws):
    return ws.raw.transactions.select("transaction_id", C.text("channel").alias("channel_text"))


@query("parse_ts_lenient", "SELECT transaction_id, raw_transaction_timestamp, transaction_ts FROM std")
def parse_ts_lenient(ws):
    raw_ts = F.col("transaction_timestamp")
    return ws.raw.transactions.select(
        "transaction_id", raw_ts.alias("raw_transaction_timestamp"), C.timestamp(raw_ts).alias("transaction_ts")
    )


@query(
    "parse_date_lenient",
    """SELECT account_id, open_date::DATE AS open_date,
              NULL::DATE AS bad_date FROM raw_account""",
)
def parse_date_lenient(ws):
    """Real dates parse; the same text with month and day swapped for a 13th month does not."""
    opened = F.col("open_date")
    broken = F.overlay(opened, F.lit("13"), 6, 2)
    return ws.raw.accounts.select("account_id", C.date(opened).alias("open_date"), C.date(broken).alias("bad_date"))


@query(
    "parse_money_lenient",
    """SELECT transaction_id, if(n % 2000 IN (32, 33), NULL, amount) AS amount, balance_before, balance_after
       FROM std""",
)
def parse_money_lenient(ws):
    return ws.broken_run.std.select("transaction_id", "amount", "balance_before", "balance_after")


@query("parse_int_lenient", "SELECT transaction_id, is_fraud_flag, NULL::INTEGER AS not_a_number FROM std")
def parse_int_lenient(ws):
    return ws.raw.transactions.select(
        "transaction_id",
        C.integer("is_fraud_flag").alias("is_fraud_flag"),
        C.integer("counterparty_id").alias("not_a_number"),
    )


@query("ingest_path", "SELECT ingest_source, count(*) AS row_count FROM std GROUP BY ALL")
def ingest_path(ws):
    path = C.ingest_path("source_file").alias("ingest_source")
    return ws.raw.transactions.groupBy(path).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "keep_raw_originals",
    """SELECT transaction_id, transaction_ts, amount, raw_transaction_timestamp, raw_amount FROM std
       WHERE transaction_ts IS NULL OR amount IS NULL OR amount <= 0""",
)
def keep_raw_originals(ws):
    bad = F.col("transaction_ts").isNull() | F.col("amount").isNull() | (F.col("amount") <= 0)
    columns = ("transaction_id", "transaction_ts", "amount", "raw_transaction_timestamp", "raw_amount")
    return ws.from_files.std.filter(bad).select(*columns)


@query(
    "standardize_transactions",
    "SELECT * EXCLUDE (n) REPLACE (regexp_extract(source_file, '(source=[a-z]+)', 1) AS source_file) FROM std",
)
def standardize_transactions(ws):
    return ws.from_files.std.drop(K.RAW_LINE).withColumn("source_file", zone())


@query(
    "standardize_accounts",
    """SELECT *, if(coalesce(account_status, '') IN ('ACTIVE', 'DORMANT', 'CLOSED', 'FROZEN'), NULL,
                    'INVALID_ACCOUNT_STATUS') AS dq_fail_reason FROM all_account""",
)
def standardize_accounts(ws):
    return ws.masters.checked_accounts


@query("standardize_customers", "SELECT * FROM dim_customer")
def standardize_customers(ws):
    return ws.masters.dim_customer


@query("standardize_branches", "SELECT * FROM dim_branch")
def standardize_branches(ws):
    return ws.masters.dim_branch


@query("yn_to_bool", "SELECT customer_id, digital_enrolled_flag = 'Y' AS digital_enrolled_flag FROM raw_customer")
def yn_to_bool(ws):
    return ws.raw.customers.select("customer_id", C.yes("digital_enrolled_flag").alias("digital_enrolled_flag"))


@query("flow_direction", "SELECT transaction_id, flow_direction FROM fact")
def flow_direction(ws):
    return ws.run.valid.select("transaction_id", enrich.flow_direction().alias("flow_direction"))


@query("signed_amount", "SELECT transaction_id, signed_amount FROM fact")
def signed_amount(ws):
    return ws.run.valid.select("transaction_id", enrich.signed_amount().alias("signed_amount"))


@query("digital_and_failed_flags", "SELECT transaction_id, digital_channel_flag, is_failed FROM fact")
def digital_and_failed_flags(ws):
    return ws.run.valid.select(
        "transaction_id",
        enrich.is_digital().alias("digital_channel_flag"),
        enrich.is_failed().alias("is_failed"),
    )


@query(
    "filter_not_failed",
    "SELECT transaction_status, count(*) AS row_count FROM fact WHERE NOT is_failed GROUP BY ALL",
)
def filter_not_failed(ws):
    kept = ws.current.fact.filter(~F.col("is_failed"))
    return kept.groupBy("transaction_status").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "filter_not_null",
    "SELECT merchant_category, count(*) AS row_count FROM fact WHERE merchant_category IS NOT NULL GROUP BY ALL",
)
def filter_not_null(ws):
    kept = ws.current.fact.filter(F.col("merchant_category").isNotNull())
    return kept.groupBy("merchant_category").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "like_reason",
    """SELECT transaction_id, dq_fail_reasons, dq_fail_reasons = 'NULL_ACCOUNT' AS is_null_account
       FROM quarantine WHERE dq_fail_reasons LIKE '%ACCOUNT%'""",
)
def like_reason(ws):
    matching = ws.newest.quarantined().filter(F.col("dq_fail_reasons").like("%ACCOUNT%"))
    exact = analysis.has_reason("NULL_ACCOUNT").alias("is_null_account")
    return matching.select("transaction_id", "dq_fail_reasons", exact)


@query(
    "in_list",
    "SELECT account_id, account_status FROM dim_account WHERE account_status IN ('DORMANT', 'CLOSED')",
)
def in_list(ws):
    return ws.current.dim_account.filter(F.col("account_status").isin("DORMANT", "CLOSED")).select(
        "account_id", "account_status"
    )


@query(
    "range_on_date",
    """SELECT transaction_date, count(*) AS row_count FROM fact
       WHERE transaction_date > (SELECT max(transaction_date) FROM fact) - INTERVAL 3 MONTH GROUP BY ALL""",
)
def range_on_date(ws):
    return analysis.recent(ws.current.fact, 3).groupBy("transaction_date").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "having_min_count",
    """SELECT transaction_type, channel, count(*) AS txn_count FROM fact GROUP BY ALL HAVING count(*) > 100""",
)
def having_min_count(ws):
    grouped = ws.current.fact.groupBy("transaction_type", "channel").agg(F.count(F.lit(1)).alias("txn_count"))
    return grouped.filter(F.col("txn_count") > 100)
