"""Data preparation, and the defects of what arrived."""

from __future__ import annotations

from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger import fixtures as X
from brassledger.catalogue.core import query
from brassledger.functions import columns as C
from brassledger.operators import prepare


@query(
    "prep_map_types",
    """SELECT o_orderkey, CASE o_orderpriority[1] WHEN '1' THEN 'TRANSFER' WHEN '2' THEN 'PAYMENT'
              WHEN '3' THEN 'DEPOSIT' WHEN '4' THEN 'WITHDRAWAL' ELSE 'DEBIT' END AS transaction_type FROM orders""",
)
def prep_map_types(ws):
    codes = F.array(*[F.lit(c) for c in ("TRANSFER", "PAYMENT", "CASH_IN", "CASH_OUT", "DEBIT")])
    source = F.element_at(codes, F.left("o_orderpriority", F.lit(1)).cast("int"))
    return ws.table("orders").select("o_orderkey", prepare.map_types(source).alias("transaction_type"))


@query(
    "prep_step_to_timestamp",
    """SELECT o_orderkey, TIMESTAMP '2025-07-01' + to_seconds((o_orderkey % 743) * 43200 + o_orderkey * 7919 % 43200)
              AS transaction_ts FROM orders""",
)
def prep_step_to_timestamp(ws):
    n = F.col("o_orderkey")
    ts = prepare.step_to_timestamp(n % 743 + 1, n * 7919 % 43_200)
    return ws.table("orders").select("o_orderkey", ts.alias("transaction_ts"))


@query(
    "prep_pool_accounts",
    """SELECT c_custkey, 'ACC' || lpad((('0x' || sha256(c_name)[:15])::BIGINT % 500 + 1)::VARCHAR, 7, '0')
              AS source_account_id FROM customer""",
)
def prep_pool_accounts(ws):
    return ws.table("customer").select(
        "c_custkey", prepare.pool_account(F.col("c_name"), 500).alias("source_account_id")
    )


@query(
    "prep_holdout_newest",
    """SELECT transaction_id, transaction_timestamp,
              row_number() OVER (ORDER BY transaction_timestamp DESC, transaction_id DESC) <= 1000 AS held_out
       FROM clean""",
)
def prep_holdout_newest(ws):
    marked = prepare.mark_holdout(X.clean_transactions(ws.spark, ws.sf_dir), 1000)
    return marked.select("transaction_id", "transaction_timestamp", "held_out")


# What prepared data brings along, seen in what arrived.


@query(
    "inject_defects",
    """SELECT ingest_source, array_to_string(reasons, ',') AS found, count(*) AS row_count FROM flagged GROUP BY ALL""",
)
def inject_defects(ws):
    """Defects that arrived, by path and combination of reasons."""
    found = F.concat_ws(",", "dq_fail_reasons").alias("found")
    return ws.run.flagged.groupBy("ingest_source", found).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "inject_cosmetic_noise",
    """SELECT transaction_id, channel, transaction_type, upper(trim(channel)) AS channel_code,
              upper(trim(transaction_type)) AS type_code FROM raw
       WHERE channel <> upper(trim(channel)) OR transaction_type <> upper(trim(transaction_type))""",
)
def inject_cosmetic_noise(ws):
    """Raw rows that differ from their standard form in case or padding only, and that form."""
    codes = {"channel_code": C.code("channel"), "type_code": C.code("transaction_type")}
    rows = ws.raw.transactions.withColumns(codes)
    noisy = (F.col("channel") != F.col("channel_code")) | (F.col("transaction_type") != F.col("type_code"))
    id_ = F.coalesce("transaction_id", F.lit("")).alias("transaction_id")
    return rows.filter(noisy).select(id_, "channel", "transaction_type", "channel_code", "type_code")


@query(
    "inject_account_defects",
    """SELECT nullif(account_status, '') AS delivered_status, count(*) AS accounts,
              coalesce(account_status, '') IN ('ACTIVE', 'DORMANT', 'CLOSED', 'FROZEN') AS accepted
       FROM raw_account GROUP BY ALL""",
)
def inject_account_defects(ws):
    """Delivered account statuses, and whether the check accepts them."""
    accepted = F.coalesce(C.code("account_status").isin(*K.ACCOUNT_STATUSES), F.lit(False)).alias("accepted")
    status = F.nullif("account_status", F.lit("")).alias("delivered_status")
    return ws.raw.accounts.groupBy(status, accepted).agg(F.count(F.lit(1)).alias("accounts"))


@query(
    "defect_manifest",
    """SELECT reason AS defect, count(*) AS defect_rows FROM (SELECT unnest(reasons) AS reason FROM flagged) GROUP BY ALL""",
)
def defect_manifest(ws):
    """Rows per defect, as found."""
    found = ws.run.flagged.select(F.explode("dq_fail_reasons").alias("defect"))
    return found.groupBy("defect").agg(F.count(F.lit(1)).alias("defect_rows"))
