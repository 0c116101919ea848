"""Transactions as JSON events and back.  The same functions serve batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brassledger import contracts as K

BAD = "_undecodable"
CORRUPT = "_corrupt"


def event_key(row_number: Column) -> Column:
    """Partition key of an event: account, else transaction id, else its number."""
    return F.coalesce(
        F.nullif(F.col("source_account_id"), F.lit("")),
        F.nullif(F.col("transaction_id"), F.lit("")),
        row_number.cast("string"),
    )


def blank_to_null(events: DataFrame) -> DataFrame:
    return events.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in K.RAW_TRANSACTION})


def encode(events: DataFrame) -> Column:
    """All contract keys, NULLs written as null."""
    return F.to_json(F.struct(*K.RAW_TRANSACTION), {"ignoreNullFields": "false"})


def decode(raw: DataFrame, value: str = "value") -> DataFrame:
    """Contract columns plus `_undecodable`.

    Missing and null keys become empty text, as the file contract wants.
    Undecodable: no payload, not JSON, or JSON that is not one object.  A
    single such record never fails its batch.
    """
    schema = K.text_schema((*K.RAW_TRANSACTION, CORRUPT))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = raw.select(F.from_json(F.col(value), schema, options).alias("e"), F.trim(F.col(value)).alias("v"))
    is_object = F.coalesce(F.col("v").startswith("{"), F.lit(False))
    bad = ~is_object | F.col("e").isNull() | F.col(f"e.{CORRUPT}").isNotNull()
    fields = [F.coalesce(F.col(f"e.{c}"), F.lit("")).alias(c) for c in K.RAW_TRANSACTION]
    return parsed.select(*fields, bad.alias(BAD))
