"""Streaming: encode, break, decode, land, count, and read back with the batch reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger import fixtures as X
from brassledger.catalogue.core import query
from brassledger.catalogue.ingest import DECODED
from brassledger.functions import columns as C
from brassledger.operators import standardise
from brassledger.sources import files
from brassledger.streaming import events as E
from brassledger.streaming import landing


@query("stream_decode", f"SELECT {DECODED}, undecodable FROM stream_events")
def stream_decode(ws):
    """The streaming decoder on the event files read as a batch."""
    return E.decode(ws.spark.read.text(ws.events_root)).withColumnRenamed(E.BAD, "undecodable")


@query(
    "stream_land_batches",
    """SELECT 'stream' AS zone, '2024-02-01' AS ingest_date, count(*) AS row_count,
              count(DISTINCT transaction_id) AS id_count, count(amount) AS amount_count
       FROM stream_events WHERE NOT undecodable""",
)
def stream_land_batches(ws):
    """The landing stream's folders, by what their names say."""
    landed = ws.landed()
    return landed.groupBy(
        F.regexp_extract("source_file", r"source=([a-z]+)", 1).alias("zone"),
        F.regexp_extract("source_file", r"ingest_date=([0-9-]+)", 1).alias("ingest_date"),
    ).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("transaction_id").alias("id_count"),
        F.count("amount").alias("amount_count"),
    )


@query(
    "stream_batch_metrics",
    """SELECT count(*) AS received, count(*) FILTER (NOT undecodable) AS written,
              count(*) FILTER (undecodable) AS undecodable FROM stream_events""",
)
def stream_batch_metrics(ws):
    """Totals over the per-batch rows the landing stream wrote."""
    per_batch = landing.read_metrics(ws.spark, f"{ws.landing_root}/metrics")
    return per_batch.agg(*[F.sum(c).alias(c) for c in ("received", "written", "undecodable")])


@query(
    "stream_key_choice",
    """SELECT coalesce(source_account_id, transaction_id, n::VARCHAR) AS event_key, count(*) AS event_count
       FROM stream_events GROUP BY ALL""",
)
def stream_key_choice(ws):
    keyed = ws.corrupted_events().select(E.event_key(F.col(X.NUMBER)).alias("event_key"))
    return keyed.groupBy("event_key").agg(F.count(F.lit(1)).alias("event_count"))


@query(
    "stream_corrupt",
    """SELECT count(*) AS events, count(*) FILTER (undecodable) AS undecodable,
              count(*) FILTER (NOT undecodable AND source_account_id IS NULL) AS without_account,
              count(*) FILTER (NOT undecodable AND channel IS NULL) AS without_channel,
              count(*) FILTER (NOT undecodable AND amount LIKE '-%') AS negative_amounts,
              count(*) FILTER (NOT undecodable AND transaction_type = 'UNKNOWN') AS unknown_types
       FROM stream_events""",
)
def stream_corrupt(ws):
    """Events that arrived broken, by what is wrong with them."""
    events = E.decode(ws.spark.read.text(ws.events_root))
    sound = ~F.col(E.BAD)
    return events.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(E.BAD).alias("undecodable"),
        F.count_if(sound & (F.col("source_account_id") == "")).alias("without_account"),
        F.count_if(sound & (F.col("channel") == "")).alias("without_channel"),
        F.count_if(sound & F.col("amount").startswith("-")).alias("negative_amounts"),
        F.count_if(sound & (F.col("transaction_type") == "UNKNOWN")).alias("unknown_types"),
    )


@query(
    "stream_batch_union",
    """SELECT ingest_source, count(*) AS row_count, count(DISTINCT transaction_id) AS id_count,
              sum(amount)::DECIMAL(28,2) AS amount
       FROM (SELECT 'STREAM' AS ingest_source, transaction_id, amount::DECIMAL(18,2) AS amount FROM stream_events
             WHERE NOT undecodable
             UNION ALL SELECT ingest_source, transaction_id, amount FROM std WHERE ingest_source = 'BATCH')
       GROUP BY ALL""",
)
def stream_batch_union(ws):
    """Landed stream files and batch files through one reader and one standardiser."""
    folders = [f"{ws.raw_root}/transactions/source=batch", f"{ws.landing_root}/transactions"]
    std = standardise.transactions(files.read_raw(ws.spark, folders, K.RAW_TRANSACTION))
    return std.groupBy("ingest_source").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("transaction_id").alias("id_count"),
        C.total("amount").alias("amount"),
    )
