"""Preparation of source data as Spark jobs: mapping, pooling, holdout.

Every choice depends on a row's own number or key, so it needs no row order,
repeats exactly, and runs without a shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brassledger.functions import columns as C

# --- fixed values: source transaction codes
SOURCE_TYPES = {
    "CASH_IN": "DEPOSIT",
    "CASH_OUT": "WITHDRAWAL",
    "PAYMENT": "PAYMENT",
    "TRANSFER": "TRANSFER",
    "DEBIT": "DEBIT",
}
# --- fixed values: time axis of the source
BASE_TIME = dt.datetime(2025, 7, 1)
HOURS_PER_STEP = 12


def map_types(source: Column) -> Column:
    """Bank type of a source code; unknown codes give NULL."""
    pairs = [F.lit(v) for pair in SOURCE_TYPES.items() for v in pair]
    return F.try_element_at(F.create_map(*pairs), source)


def step_to_timestamp(step: Column, offset_seconds: Column) -> Column:
    """Step 1 starts at the base time; the offset places the row inside its step."""
    seconds = (step - 1) * (HOURS_PER_STEP * 3600) + offset_seconds
    return F.timestamp_add("SECOND", seconds, F.lit(BASE_TIME.isoformat(sep=" ")).cast("timestamp_ntz"))


def pool_account(origin: Column, accounts: int) -> Column:
    """Many one-off origin ids onto a fixed number of accounts, stably."""
    return C.padded("ACC", C.stable_bucket(origin, accounts) + 1, 7)


def mark_holdout(txns: DataFrame, newest: int, ts: str = "transaction_timestamp", key: str = "transaction_id"):
    """Adds `held_out`: true for the `newest` rows by (timestamp, key).

    A bounded top-n gives the cut; comparing with it is a filter, so no row is
    shuffled and no anti-join is needed.  The key must be unique, as prepared
    ids are.
    """
    rank = F.struct(ts, key)
    top = txns.select(rank.alias("rank")).orderBy(F.col("rank").desc()).limit(newest)
    cut = top.agg(F.min("rank").alias("cut")).scalar()
    return txns.withColumn("held_out", F.coalesce(rank >= cut, F.lit(False)))
