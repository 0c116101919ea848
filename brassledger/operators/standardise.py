"""Raw text rows to typed rows.  Nothing is rejected here; bad values become NULL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger.functions import columns as C


def instant(value: dt.datetime) -> Column:
    """A wall-clock literal without a time zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def transactions(raw: DataFrame) -> DataFrame:
    """17 columns: the typed transaction, its path, and the two raw originals.

    Where the raw rows carry `malformed_line`, it follows as the 18th, and a
    row that has one keeps its path only: a missing or extra field shifts the
    others, so none of its values is what its column says.
    """
    codes = ("transaction_type", "channel", "merchant_category", "branch_id", "transaction_status")
    typed = {
        "transaction_id": C.code("transaction_id"),
        "transaction_ts": C.timestamp("transaction_timestamp"),
        "source_account_id": C.code("source_account_id"),
        "counterparty_id": C.code("counterparty_id"),
        **{name: C.code(name) for name in codes},
        "amount": C.money("amount"),
        "balance_before": C.money("balance_before"),
        "balance_after": C.money("balance_after"),
        "is_fraud_flag": C.integer("is_fraud_flag"),
        "ingest_source": C.ingest_path("source_file"),
        "source_file": F.col("source_file"),
        "raw_transaction_timestamp": F.col("transaction_timestamp"),
        "raw_amount": F.col("amount"),
    }
    order = K.layout_columns(K.QUARANTINE_DDL)[:17]
    if K.RAW_LINE not in raw.columns:
        return raw.select(*[typed[name].alias(name) for name in order])
    whole = F.col(K.RAW_LINE).isNull()
    path = ("ingest_source", "source_file")
    values = {name: typed[name] if name in path else F.when(whole, typed[name]) for name in order}
    return raw.select(*[value.alias(name) for name, value in values.items()], K.RAW_LINE)


def newest_per_key(df: DataFrame, key: str, newest_by: str) -> DataFrame:
    """One row per key: newest first, remaining columns as tie-breakers.

    Keys are counted by hash; those that occur once, nearly all, are taken as
    they are.  Rows of the others meet in a maximum over a struct, which
    combines on the map side: a key that holds a third of the rows costs one
    partial row per task, which a window would not.  (That maximum is a sorting
    aggregate, so it should see few rows.)
    """
    counts = df.groupBy(F.col(key).alias("_again")).agg(F.count(F.lit(1)).alias("_n"))
    again = counts.filter(F.col("_n") > 1).select("_again")
    same = F.col(key) == F.col("_again")
    rest = [c for c in df.columns if c not in (key, newest_by)]
    rivals = df.join(again, same, "left_semi").groupBy(key).agg(F.max(F.struct(newest_by, *rest)).alias("_best"))
    best = rivals.select(*[F.col(c) if c == key else F.col(f"_best.{c}") for c in df.columns])
    return df.join(again, same, "left_anti").unionByName(best)


def accounts(raw: DataFrame) -> DataFrame:
    """Typed accounts plus `dq_fail_reason`: the first rule that fails, else NULL."""
    typed = raw.select(
        C.code("account_id").alias("account_id"),
        C.code("customer_id").alias("customer_id"),
        C.code("account_type").alias("account_type"),
        C.date("open_date").alias("open_date"),
        C.code("account_status").alias("account_status"),
        C.money("current_balance").alias("current_balance"),
    )
    known_status = F.coalesce(F.col("account_status").isin(*K.ACCOUNT_STATUSES), F.lit(False))
    reason = F.when(F.col("account_id").isNull(), "NULL_ACCOUNT_ID").when(~known_status, "INVALID_ACCOUNT_STATUS")
    return typed.withColumn("dq_fail_reason", reason)


def account_master(checked_accounts: DataFrame) -> DataFrame:
    """One row per account id, bad status included: such accounts are still known owners."""
    present = checked_accounts.filter(F.col("account_id").isNotNull()).drop("dq_fail_reason")
    return newest_per_key(present, "account_id", "open_date")


def valid_accounts(checked_accounts: DataFrame) -> DataFrame:
    good = checked_accounts.filter(F.col("dq_fail_reason").isNull()).drop("dq_fail_reason")
    return newest_per_key(good, "account_id", "open_date")


def rejected_accounts(checked_accounts: DataFrame, run_id: str, at: dt.datetime) -> DataFrame:
    bad = checked_accounts.filter(F.col("dq_fail_reason").isNotNull())
    return bad.withColumns({"run_id": F.lit(run_id), "quarantined_at": instant(at)})


def typed_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        C.code("customer_id").alias("customer_id"),
        C.date("customer_since").alias("customer_since"),
        *[C.code(c).alias(c) for c in ("state", "customer_segment", "risk_tier")],
        C.yes("digital_enrolled_flag").alias("digital_enrolled_flag"),
        C.code("home_branch_id").alias("home_branch_id"),
    ).filter(F.col("customer_id").isNotNull())


def customers(typed: DataFrame, as_of: dt.datetime) -> DataFrame:
    today = F.lit(as_of.date())
    return newest_per_key(typed, "customer_id", "customer_since").withColumn(
        "tenure_years", C.tenure_years("customer_since", today)
    )


def branches(raw: DataFrame) -> DataFrame:
    cleaned = raw.select(
        C.code("branch_id").alias("branch_id"),
        C.text("branch_name").alias("branch_name"),
        C.text("city").alias("city"),
        C.code("state").alias("state"),
        C.code("region").alias("region"),
    )
    return cleaned.filter(F.col("branch_id").isNotNull())
