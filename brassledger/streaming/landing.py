"""Structured Streaming: JSON events into the raw zone, one folder per micro-batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brassledger import contracts as K
from brassledger.sources.files import CSV_DIALECT
from brassledger.streaming import events as E

METRICS = ("received", "written", "undecodable")
METRIC_DDL = "batch_id bigint, received bigint, written bigint, undecodable bigint"


def read_events(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of JSON lines; any source with a text column `value` can take its place."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def counts() -> list[Column]:
    """received / written / undecodable, as measures of decoded rows."""
    return [
        F.count(F.lit(1)).alias("received"),
        F.count_if(~F.col(E.BAD)).alias("written"),
        F.count_if(E.BAD).alias("undecodable"),
    ]


def land(
    stream: DataFrame,
    raw_root: str,
    metrics_path: str,
    checkpoint: str,
    ingest_date: dt.date | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Decode and write each micro-batch as gzip CSV under source=stream/ingest_date=, counting what passes.

    A batch is read once: its counts are observed while it is written, nothing is cached and no second job reads it.

    Values are landed as they are; judging them is the batch run's task.  The
    batch number names the folder and the folder is overwritten, so a batch
    that runs again lands once.  (With `ingest_date=None` the day is taken from
    the clock; a retry across midnight then lands twice, and the run's repeat
    check removes the second copy.)  `every=None` drains what is there and stops.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        day = ingest_date or dt.datetime.now(dt.timezone.utc).date()
        seen = Observation(f"landing-{batch_id}")
        # Observed behind the exchange, in the tasks that write, whose counts are taken once also when tasks run again.
        decoded = E.decode(batch).hint("rebalance").observe(seen, *counts())
        good = decoded.filter(~F.col(E.BAD)).select(*K.RAW_TRANSACTION)
        folder = f"{raw_root}/source=stream/ingest_date={day:%Y-%m-%d}/batch={batch_id:09d}"
        good.write.mode("overwrite").options(**CSV_DIALECT).csv(folder, compression="gzip")
        row = {"batch_id": batch_id, **dict.fromkeys(METRICS, 0), **seen.get}
        counted = batch.sparkSession.range(1).select(*[F.lit(row[c]).cast("bigint").alias(c) for c in ("batch_id", *METRICS)])
        counted.write.mode("overwrite").parquet(f"{metrics_path}/batch={batch_id:09d}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def read_metrics(spark: SparkSession, metrics_path: str) -> DataFrame:
    """Per-batch counts.  Only the columns of the files: the folder name repeats the batch id."""
    reader = spark.read.schema(METRIC_DDL).option("recursiveFileLookup", "true")
    return reader.parquet(metrics_path)
