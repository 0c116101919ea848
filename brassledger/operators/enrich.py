"""Valid rows to fact rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brassledger import contracts as K


def is_inflow() -> Column:
    return F.col("transaction_type") == "DEPOSIT"


def flow_direction() -> Column:
    return F.when(is_inflow(), "INFLOW").otherwise("OUTFLOW")


def signed_amount() -> Column:
    sign = F.when(is_inflow(), F.lit(1)).otherwise(F.lit(-1))
    return (F.col("amount") * sign).cast(K.MONEY)


def is_digital() -> Column:
    return F.col("channel").isin(*K.DIGITAL)


def is_failed() -> Column:
    return F.col("transaction_status") == "FAILED"


def fact_rows(valid: DataFrame, run_id: str) -> DataFrame:
    """26 columns; owner columns come from the struct the lookup left behind."""
    derived = {
        "transaction_date": F.col("transaction_ts").cast("date"),
        "transaction_hour": F.hour("transaction_ts"),
        "customer_id": F.col("owner.customer_id"),
        "account_type": F.col("owner.account_type"),
        "flow_direction": flow_direction(),
        "signed_amount": signed_amount(),
        "digital_channel_flag": is_digital(),
        "is_failed": is_failed(),
        "run_id": F.lit(run_id),
        "year": F.year("transaction_ts"),
        "month": F.month("transaction_ts"),
    }
    columns = [*K.layout_columns(K.FACT_DDL), "year", "month"]
    return valid.select(*[derived.get(c, F.col(c)).alias(c) for c in columns])
