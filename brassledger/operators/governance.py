"""Masking, row access, and column tags as operations on frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brassledger.functions import columns as C

# --- fixed values: roles
ENGINEER = "BANK_DATA_ENGINEER"
STEWARD = "BANK_DQ_STEWARD"
ANALYST = "BANK_ANALYST"
REGIONAL = "BANK_ANALYST_MID_ATLANTIC"
ADMIN = "ACCOUNTADMIN"
SEES_RAW = frozenset({STEWARD, ENGINEER, ADMIN})
SEES_ALL_ROWS = frozenset({ENGINEER, STEWARD, ANALYST, ADMIN})

# --- fixed values: which states a restricted role may see
ENTITLEMENTS = ((REGIONAL, "MD"), (REGIONAL, "VA"), (REGIONAL, "DC"), (REGIONAL, "DE"), (REGIONAL, "PA"))

# --- fixed values: masked columns per table
MASKED = {
    "fact_transactions": {
        "customer_id": "identifier",
        "source_account_id": "identifier",
        "counterparty_id": "identifier",
        "balance_before": "balance",
        "balance_after": "balance",
    },
    "dim_customer": {"customer_id": "identifier"},
    "dim_account": {"account_id": "identifier", "customer_id": "identifier", "current_balance": "balance"},
}

# --- fixed values: classification per column, owner per table
TAGS = {
    "fact_transactions": {
        "customer_id": "DIRECT_IDENTIFIER",
        "source_account_id": "DIRECT_IDENTIFIER",
        "counterparty_id": "DIRECT_IDENTIFIER",
        "balance_before": "SENSITIVE_FINANCIAL",
        "balance_after": "SENSITIVE_FINANCIAL",
    },
    "dim_customer": {"customer_id": "DIRECT_IDENTIFIER", "state": "QUASI_IDENTIFIER"},
    "dim_account": {"account_id": "DIRECT_IDENTIFIER", "current_balance": "SENSITIVE_FINANCIAL"},
}
OWNERS = {
    "fact_transactions": "Retail Bank - Payments & Deposits Analytics",
    "dim_customer": "Retail Bank - Customer Data Office",
}
CLASSIFICATION = "data_classification"
COMMENT = "comment"

# --- fixed values: what each role is for
ACCESS = (
    (ENGINEER, "everything", "raw"),
    (STEWARD, "analytics + dq/quarantine", "raw"),
    (ANALYST, "analytics marts", "hashed"),
    (REGIONAL, "analytics marts", "hashed"),
)


# ---------------------------------------------------------------- masking
def mask_identifier(column, role: str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c if role in SEES_RAW else C.hashed(c)


def mask_balance(column, role: str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c if role in SEES_RAW else C.banded(c)


def apply_masking(df: DataFrame, table: str, role: str) -> DataFrame:
    """The frame as the role sees it; columns keep name, type and order."""
    policy = {"identifier": mask_identifier, "balance": mask_balance}
    bound = {c: policy[kind](c, role) for c, kind in MASKED[table].items() if c in df.columns}
    return df.withColumns(bound) if bound else df


# ---------------------------------------------------------------- row access
def entitlements(spark: SparkSession) -> DataFrame:
    return C.fixed_rows(spark, ("role_name", "state"), ENTITLEMENTS)


def visible_rows(customers: DataFrame, role: str, granted: DataFrame | None = None) -> DataFrame:
    """Customers the role may see.  Unrestricted roles need no join at all."""
    if role in SEES_ALL_ROWS:
        return customers
    granted = entitlements(customers.sparkSession) if granted is None else granted
    states = granted.filter(F.col("role_name") == role).select("state")
    return customers.join(states, "state", "left_semi").select(*customers.columns)


def visible_per_role(customers: DataFrame, roles: list[str], granted: DataFrame) -> DataFrame:
    """(role_name, state, customers) when the role is a column and not known in advance.

    Customers are counted per state first, so the roles meet a row per state
    and never the customers.  `EXISTS` below an `OR` stays one join.
    """
    per_state = customers.groupBy(F.col("state").alias("_seen")).agg(F.count(F.lit(1)).alias("customers"))
    pairs = per_state.withColumn("_viewer", F.explode(F.array(*[F.lit(r) for r in roles])))
    # The outer columns must have names the inner frame does not know.
    mine = F.col("role_name") == F.col("_viewer").outer()
    exists = granted.filter(mine & (F.col("state") == F.col("_seen").outer())).exists()
    allowed = pairs.filter(F.col("_viewer").isin(*SEES_ALL_ROWS) | exists)
    return allowed.select(F.col("_viewer").alias("role_name"), F.col("_seen").alias("state"), "customers")


# ---------------------------------------------------------------- tags
def tag_columns(df: DataFrame, table: str) -> DataFrame:
    """Classification (and owner) as column metadata, which travels through selects."""
    owner = OWNERS.get(table)
    for name, label in TAGS.get(table, {}).items():
        if name in df.columns:
            meta = {**df.schema[name].metadata, CLASSIFICATION: label}
            if owner:
                meta["data_owner"] = owner
            df = df.withMetadata(name, meta)
    return df


def describe_columns(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    for name, comment in comments.items():
        if name in df.columns:
            df = df.withMetadata(name, {**df.schema[name].metadata, COMMENT: comment})
    return df


def tag_report(df: DataFrame, table: str) -> DataFrame:
    """Per column: tag, mask, and how many values it covers, from one pass over the frame."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f.name)).alias(f.name) for f in fields])
    lines = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.metadata.get(CLASSIFICATION)).cast("string").alias("classification"),
            F.lit(MASKED.get(table, {}).get(f.name)).cast("string").alias("mask"),
            F.col(f.name).alias("filled_values"),
        )
        for f in fields
    ]
    return counts.select(F.inline(F.array(*lines)))


def access_matrix(customers: DataFrame) -> DataFrame:
    """Role, scope, identifier form, and the customers and states it reaches."""
    spark = customers.sparkSession
    roles = C.fixed_rows(spark, ("role_name", "sees", "identifiers"), ACCESS)
    seen = visible_per_role(customers, [r for r, *_ in ACCESS], entitlements(spark))
    reach = seen.groupBy("role_name").agg(
        F.sum("customers").cast("bigint").alias("customers_visible"), F.count("state").alias("states_visible")
    )
    return roles.join(reach, "role_name", "left").select(
        "role_name",
        "sees",
        "identifiers",
        F.coalesce("customers_visible", F.lit(0)).cast("bigint").alias("customers_visible"),
        F.coalesce("states_visible", F.lit(0)).cast("bigint").alias("states_visible"),
    )
