"""Metric state that merges: what is counted of transactions once, by day and type, and combined whenever it is asked for.

A state row holds counts and sums, a HyperLogLog sketch of the ids and a KLL sketch of the amounts.  Rows merge over
days, types, folders and runs by sums and sketch unions, so a metric reads states and not transactions.

* Counts and sums are exact whatever is merged.
* Distinct ids are estimates: relative standard error 0.8 % (2^14 registers), small numbers nearly exact.
* Quantiles are exact up to `SKETCH_ROWS` amounts per merged group; above, their rank is within `RANK_ERROR` of the
  wanted one (99 % of the time).  A sketch is at most about 100 KB, however many rows it stands for.
  `exact_percentiles` reads the rows of such larger groups again, and only theirs.

`Profiles` keeps states per folder of raw files, so that a metric over a growing raw zone reads new folders only.  A
state belongs to the names of a folder's files: a folder that has gained or replaced files is measured anew.  Metrics
against a clock (rows in the future) are no part of the state, as they change without new files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from decimal import Decimal
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger.functions import columns as C
from brassledger.operators import quality
from brassledger.session import exists

SKETCH_ROWS = 4096
RANK_ERROR = 0.0013
REGISTERS_LOG2 = 14
BY = ("transaction_date", "transaction_type")
COUNTS = ("row_count", "null_ids", "null_accounts", "null_channels", "non_positive_amounts", "invalid_channels")
STATE_DDL = f"""
    transaction_date date, transaction_type string, {", ".join(f"{c} bigint" for c in COUNTS)},
    amounts bigint, amount_total decimal(38,2), id_sketch binary, amount_sketch binary
"""
SOURCES_PER_JOB = 32  # new folders measured in one job; bounds the size of its plan, not what is measured


# ---------------------------------------------------------------- states
def measure(rows: DataFrame, *also: str) -> DataFrame:
    """Typed transactions to their state, by day and type (and `also`).  Every part combines on the map side."""
    counts = (
        quality.row_count(),
        quality.null_count("transaction_id"),
        quality.null_count("source_account_id"),
        quality.null_count("channel"),
        quality.non_positive_count("amount"),
        quality.outside_domain_count("channel"),
    )
    day = F.to_date("transaction_ts").alias("transaction_date")
    return rows.groupBy(*also, day, "transaction_type").agg(
        *(count.cast("bigint").alias(name) for count, name in zip(counts, COUNTS)),
        F.count("amount").alias("amounts"),
        F.sum(F.col("amount").cast("decimal(28,2)")).cast("decimal(38,2)").alias("amount_total"),
        F.hll_sketch_agg("transaction_id", REGISTERS_LOG2).alias("id_sketch"),
        F.kll_sketch_agg_double(F.col("amount").cast("double"), SKETCH_ROWS).alias("amount_sketch"),
    )


def merged(state: DataFrame, *by: str) -> DataFrame:
    """States combined over all that `by` does not name; itself a state."""
    return state.groupBy(*by).agg(
        *(F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in (*COUNTS, "amounts")),
        F.sum("amount_total").cast("decimal(38,2)").alias("amount_total"),
        F.hll_union_agg("id_sketch").alias("id_sketch"),
        F.kll_merge_agg_double("amount_sketch", SKETCH_ROWS).alias("amount_sketch"),
    )


def metrics(state: DataFrame, *by: str) -> DataFrame:
    """The exact counts, and estimates of distinct ids and of rows beyond the first of an id."""
    distinct = F.coalesce(F.hll_sketch_estimate("id_sketch"), F.lit(0)).cast("bigint")
    beyond = F.greatest(F.col("row_count") - F.col("null_ids") - distinct, F.lit(0))
    shown = merged(state, *by)
    return shown.select(*by, *COUNTS, distinct.alias("distinct_ids"), beyond.cast("bigint").alias("duplicates"))


def quantile(rank: float) -> Column:
    """A stored amount at `rank` (the smallest whose share of rows reaches it); NULL where there is no amount."""
    value = F.kll_sketch_get_quantile_double("amount_sketch", F.lit(rank))
    return F.when(F.col("amounts") > 0, value).cast("decimal(18,2)")


def value_percentiles(state: DataFrame, *by: str) -> DataFrame:
    """Rows, total, mean, median and p95 of amounts per `by`, from sketches alone."""
    return merged(state, *by).select(
        *by,
        F.col("row_count").alias("txn_count"),
        F.col("amount_total").alias("total_value"),
        F.round(C.share(F.col("amount_total"), F.col("row_count")), 2).alias("avg_value"),
        quantile(0.5).alias("median_value"),
        quantile(0.95).alias("p95_value"),
    )


def exact_percentiles(state: DataFrame, rows: DataFrame, *by: str) -> DataFrame:
    """`value_percentiles` without an error: groups above `SKETCH_ROWS` amounts are counted out from `rows`.

    `rows` are the rows the state was measured from, with the columns `by`.  Equal amounts of a group combine on the map
    side; the running count over a group's distinct amounts can spill, so a group need not fit in memory.
    """
    shown = merged(state, *by)
    large = shown.filter(F.col("amounts") > SKETCH_ROWS).select(*[F.col(c).alias(f"_{c}") for c in by])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    met = rows.filter(F.col("amount").isNotNull()).join(large, same, "left_semi")
    counted = met.groupBy(*by, "amount").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*by)
    ranked = counted.withColumns({"upto": F.sum("n").over(group.orderBy("amount")), "whole": F.sum("n").over(group)})

    def reached(rank: str) -> Column:
        share = F.lit(Decimal(rank))  # decimals, so that a whole number of rows is hit exactly
        return F.min(F.when(F.col("upto") >= share * F.col("whole"), F.col("amount"))).cast("decimal(18,2)")

    exact = ranked.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(
        reached("0.5").alias("_median"), reached("0.95").alias("_p95")
    )
    replaced = value_percentiles(state, *by).join(exact, same, "left")
    return replaced.withColumns(
        {"median_value": F.coalesce("_median", "median_value"), "p95_value": F.coalesce("_p95", "p95_value")}
    ).drop(*exact.columns)


# ---------------------------------------------------------------- states of folders
def folders_of(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Folders below `root` with their files; names only, nothing is opened."""
    listed: dict[str, list[str]] = {}
    for path in map(unquote, spark.read.option("recursiveFileLookup", "true").format("text").load(root).inputFiles()):
        listed.setdefault(path.rsplit("/", 1)[0], []).append(path)
    return listed


def state_key(files: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()


class Profiles:
    """States of folders, one partition each, below `root`.

    A partition is written as one file and replaced as a whole, so a refresh that breaks off leaves whole states, and
    two refreshes at a time write the same.  Folders that are gone, or whose files have changed, leave states behind
    that nobody reads.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _known(self) -> set[str]:
        if not exists(self.spark, self.root):
            return set()
        files = self.spark.read.schema(K.layout(STATE_DDL)).parquet(self.root).inputFiles()
        return {part.removeprefix("source=") for file in files for part in file.split("/") if part.startswith("source=")}

    def refresh(self, folders: dict[str, list[str]], read: Callable[[list[str]], DataFrame]) -> list[str]:
        """Measure the folders without a state; returns their names.  `read` gives typed transactions of files."""
        known = self._known()
        new = {folder: files for folder, files in folders.items() if state_key(files) not in known}
        names = sorted(new)
        for at in range(0, len(names), SOURCES_PER_JOB):
            parts = [read(new[name]).withColumn("source", F.lit(state_key(new[name]))) for name in names[at : at + SOURCES_PER_JOB]]
            rows = parts[0]
            for part in parts[1:]:
                rows = rows.unionByName(part)
            states = measure(rows, "source").repartition("source")
            writer = states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("source").parquet(self.root)
        return names

    def state(self, folders: dict[str, list[str]]) -> DataFrame:
        """States of these folders as they are now; folders without rows have none."""
        wanted = {state_key(files) for files in folders.values()} & self._known()
        paths = [f"{self.root}/source={key}" for key in sorted(wanted)]
        if not paths:
            return self.spark.createDataFrame([], K.layout(STATE_DDL))
        return self.spark.read.schema(K.layout(STATE_DDL)).parquet(*paths)
