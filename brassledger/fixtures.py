"""Bank-shaped raw frames from the test tables: orders as BATCH, events as STREAM.

Key-driven throughout: the same row always gets the same values, and nothing
shuffles.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger import fixture_defects as D
from brassledger.functions import columns as C
from brassledger.plans.run import RawZone, Run, Settings

AS_OF = dt.datetime(2024, 2, 1)
NUMBER = "n"  # row number column the injections key on

# --- fixed values: fixture mapping
BATCH_TYPES = {"1": "TRANSFER", "2": "PAYMENT", "3": "DEPOSIT", "4": "WITHDRAWAL", "5": "DEBIT"}
STREAM_TYPES = {
    "purchase": "PAYMENT",
    "signup": "DEPOSIT",
    "view": "TRANSFER",
    "click": "DEBIT",
    "error": "WITHDRAWAL",
}
MERCHANTS = ("GROCERY", "UTILITIES", "DINING", "RETAIL", "TRAVEL", "HEALTHCARE", "FUEL", "ENTERTAINMENT")
STATES = (
    "MD", "VA", "DC", "PA", "NY", "NJ", "DE", "NC", "GA", "FL",
    "TX", "CA", "IL", "OH", "MA", "WA", "AZ", "CO", "MN", "TN",
)
SEGMENTS = {
    "HOUSEHOLD": "MASS",
    "MACHINERY": "MASS",
    "AUTOMOBILE": "MASS_AFFLUENT",
    "FURNITURE": "AFFLUENT",
    "BUILDING": "SMALL_BUSINESS",
}
BATCH_FILE = "raw/transactions/source=batch/part-000.csv"
STREAM_FILE = "raw/transactions/source=stream/ingest_date=2024-02-01/part-000.csv"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lookup(c: Column, mapping: dict[str, str]) -> Column:
    pairs = [F.lit(v) for pair in mapping.items() for v in pair]
    return F.try_element_at(F.create_map(*pairs), c)


def _pick(index: Column, options) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), index.cast("int") + 1)


def _channel(kind: Column, n: Column) -> Column:
    even = F.when(n % 2 == 0, "MOBILE").otherwise("ONLINE")
    return (
        F.when(kind == "DEPOSIT", _pick(n % 4, ("BRANCH", "ATM", "MOBILE", "ONLINE")))
        .when(kind == "WITHDRAWAL", F.when(n % 4 == 0, "BRANCH").otherwise("ATM"))
        .when(kind == "DEBIT", F.when(n % 10 < 7, "POS").otherwise("ONLINE"))
        .otherwise(F.when(n % 10 == 0, "BRANCH").otherwise(even))
    )


def _movements(rows: DataFrame, prefix: str, source_file: str) -> DataFrame:
    """Contract columns from (n, k, ts text, kind, money, status)."""
    n, kind, money = F.col("n"), F.col("kind"), F.col("money")
    merchant = kind.isin("PAYMENT", "DEBIT")
    before = (n * 37 % 100_000).cast(K.MONEY)
    after = F.when(kind == "DEPOSIT", before + money).otherwise(F.greatest(before - money, F.lit(0).cast(K.MONEY)))
    blank = F.lit("")
    wide = rows.withColumn("channel", _channel(kind, n))
    columns = {
        "transaction_id": C.padded(prefix, n, 10),
        "transaction_timestamp": F.col("ts_text"),
        "source_account_id": C.padded("ACC", F.col("k") + 1, 7),
        "counterparty_id": F.when(merchant, C.padded("M", n * 31 % 100_000, 6)).otherwise(
            C.padded("C", n * 31 % 100_000, 6)
        ),
        "transaction_type": kind,
        "amount": money.cast("string"),
        "channel": F.col("channel"),
        "merchant_category": F.when(merchant, _pick(n % 8, MERCHANTS)).otherwise(blank),
        "branch_id": F.when(F.col("channel").isin("BRANCH", "ATM"), C.padded("BR", n % 25 + 1, 3)).otherwise(blank),
        "transaction_status": F.col("status"),
        "balance_before": before.cast("string"),
        "balance_after": after.cast("string"),
        "is_fraud_flag": F.when(n % 769 == 0, "1").otherwise("0"),
        "source_file": F.lit(source_file),
        NUMBER: n,
    }
    return wide.select(*[c.alias(name) for name, c in columns.items()])


def clean_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey")
    moment = F.timestamp_add("SECOND", n * 7919 % 86_400, F.col("o_orderdate"))
    status = F.col("o_orderstatus")
    rows = table(spark, sf_dir, "orders").select(
        n.alias("n"),
        F.col("o_custkey").alias("k"),
        moment.cast("timestamp_ntz").cast("string").alias("ts_text"),
        _lookup(F.left("o_orderpriority", F.lit(1)), BATCH_TYPES).alias("kind"),
        F.col("o_totalprice").cast(K.MONEY).alias("money"),
        F.when((status == "F") & (n % 5 == 0), "FAILED")
        .when((status == "P") & (n % 50 == 1), "REVERSED")
        .otherwise("POSTED")
        .alias("status"),
    )
    return _movements(rows, "TXN", BATCH_FILE)


def clean_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(
        n.alias("n"),
        F.col("user_id").alias("k"),
        F.left(F.col("ts").cast("string"), F.lit(19)).alias("ts_text"),
        _lookup(F.col("event_type"), STREAM_TYPES).alias("kind"),
        F.greatest(F.col("value").cast(K.MONEY), F.lit("0.01").cast(K.MONEY)).alias("money"),
        F.when((F.col("event_type") == "error") & (n % 5 == 0), "FAILED").otherwise("POSTED").alias("status"),
    )
    return _movements(rows, "EVT", STREAM_FILE)


def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_batch(spark, sf_dir).unionByName(clean_stream(spark, sf_dir))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.inject_defects(clean_transactions(spark, sf_dir), NUMBER).drop(NUMBER)


# ---------------------------------------------------------------- dimensions
def _state(nation_key: Column) -> Column:
    return _pick(nation_key % 20, STATES)


def _since(k: Column) -> Column:
    return F.date_add(F.lit(dt.date(2005, 1, 1)), (k * 37 % 5000).cast("int"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, balance = F.col("c_custkey"), F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        C.padded("CUST", k, 6).alias("customer_id"),
        _since(k).cast("string").alias("customer_since"),
        _state(F.col("c_nationkey")).alias("state"),
        _lookup(F.col("c_mktsegment"), SEGMENTS).alias("customer_segment"),
        F.when(balance < 0, "HIGH").when(balance < 2000, "MEDIUM").otherwise("LOW").alias("risk_tier"),
        F.when(k % 10 < 7, "Y").otherwise("N").alias("digital_enrolled_flag"),
        C.padded("BR", F.col("c_nationkey") + 1, 3).alias("home_branch_id"),
    )


def clean_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    turn, life = k % 20, k % 200
    opened = F.date_add(_since(k), (k * 13 % 2000).cast("int"))
    return table(spark, sf_dir, "customer").select(
        C.padded("ACC", k + 1, 7).alias("account_id"),
        C.padded("CUST", k, 6).alias("customer_id"),
        F.when(turn < 11, "CHECKING")
        .when(turn < 17, "SAVINGS")
        .when(turn < 19, "MONEY_MARKET")
        .otherwise("CD")
        .alias("account_type"),
        opened.cast("string").alias("open_date"),
        F.when(life < 180, "ACTIVE")
        .when(life < 192, "DORMANT")
        .when(life < 199, "CLOSED")
        .otherwise("FROZEN")
        .alias("account_status"),
        F.col("c_acctbal").cast(K.MONEY).cast("string").alias("current_balance"),
        k.alias(NUMBER),
    )


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.inject_account_defects(clean_accounts(spark, sf_dir), NUMBER).drop(NUMBER)


def raw_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        C.padded("BR", F.col("n_nationkey") + 1, 3).alias("branch_id"),
        F.concat(F.col("n_name"), F.lit(" Main Branch")).alias("branch_name"),
        F.col("n_name").alias("city"),
        _state(F.col("n_nationkey")).alias("state"),
        F.replace(F.upper("r_name"), F.lit(" "), F.lit("_")).alias("region"),
    )


# ---------------------------------------------------------------- runs
def raw_zone(spark: SparkSession, sf_dir: str, transactions: DataFrame | None = None) -> RawZone:
    return RawZone(
        raw_transactions(spark, sf_dir) if transactions is None else transactions,
        raw_accounts(spark, sf_dir),
        raw_customers(spark, sf_dir),
        raw_branches(spark, sf_dir),
    )


def run(spark: SparkSession, sf_dir: str, as_of: dt.datetime = AS_OF, max_rate: float = 0.05) -> Run:
    """The main run: all raw rows at the fixture's clock."""
    return Run(raw_zone(spark, sf_dir), Settings(as_of, max_rate))
