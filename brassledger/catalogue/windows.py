"""Window functions, sorting, limits, set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from brassledger.catalogue.core import query
from brassledger.functions import columns as C
from brassledger.operators import quality, validate
from brassledger.plans import marts


def rows(name: str = "row_count"):
    return F.count(F.lit(1)).alias(name)


# ---------------------------------------------------------------- windows
@query(
    "win_dedupe_row_number",
    """SELECT transaction_id, transaction_ts, ingest_source FROM flagged
       WHERE len(reasons) = 0 AND transaction_id IN
             (SELECT transaction_id FROM flagged WHERE list_contains(reasons, 'DUPLICATE_TXN_ID'))""",
)
def win_dedupe_row_number(ws):
    """The version kept of every id that was delivered more than once."""
    run = ws.run
    kept = validate.valid_rows(run.flagged).join(
        validate.repeated_ids(run.checked), F.col("transaction_id") == F.col("_rid"), "left_semi"
    )
    return kept.select("transaction_id", "transaction_ts", "ingest_source")


@query(
    "win_lag_mom",
    """SELECT ingest_source, month_start, txn_count,
              round(100 * (txn_count - lag(txn_count) OVER w)::DOUBLE / nullif(lag(txn_count) OVER w, 0), 2) AS mom_pct
       FROM (SELECT ingest_source, month_start, count(*) AS txn_count FROM fact GROUP BY ALL)
       WINDOW w AS (PARTITION BY ingest_source ORDER BY month_start)""",
)
def win_lag_mom(ws):
    month = C.month_start("transaction_date").alias("month_start")
    months = ws.current.fact.groupBy("ingest_source", month).agg(rows("txn_count"))
    previous = F.lag("txn_count").over(Window.partitionBy("ingest_source").orderBy("month_start"))
    growth = F.round(C.share(F.col("txn_count") - previous, previous, 100.0), 2)
    return months.withColumn("mom_pct", growth)


@query(
    "win_rank_over_agg",
    """SELECT transaction_type, merchant_category, sum(amount)::DECIMAL(28,2) AS spend,
              rank() OVER (PARTITION BY transaction_type ORDER BY sum(amount) DESC)::INTEGER AS spend_rank
       FROM fact WHERE merchant_category IS NOT NULL GROUP BY transaction_type, merchant_category""",
)
def win_rank_over_agg(ws):
    spent = ws.current.fact.filter(F.col("merchant_category").isNotNull())
    grouped = spent.groupBy("transaction_type", "merchant_category").agg(C.total("amount").alias("spend"))
    w = Window.partitionBy("transaction_type").orderBy(F.col("spend").desc())
    return grouped.withColumn("spend_rank", F.rank().over(w))


@query(
    "win_share_partition",
    """SELECT transaction_type, channel, count(*) AS txn_count,
              round(100 * count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY transaction_type), 2) AS share_pct
       FROM fact GROUP BY transaction_type, channel""",
)
def win_share_partition(ws):
    grouped = ws.current.fact.groupBy("transaction_type", "channel").agg(rows("txn_count"))
    whole = F.sum("txn_count").over(Window.partitionBy("transaction_type"))
    return grouped.withColumn("share_pct", F.round(C.share(F.col("txn_count"), whole, 100.0), 2))


@query(
    "win_share_total",
    """SELECT channel, sum(amount)::DECIMAL(28,2) AS txn_value,
              round(100 * sum(amount)::DOUBLE / sum(sum(amount)) OVER ()::DOUBLE, 2) AS share_pct
       FROM fact GROUP BY channel""",
)
def win_share_total(ws):
    grouped = ws.current.fact.groupBy("channel").agg(C.total("amount").alias("txn_value"))
    whole = F.sum("txn_value").over(Window.partitionBy())  # one row per channel
    return grouped.withColumn("share_pct", F.round(C.share(F.col("txn_value"), whole, 100.0), 2))


@query(
    "win_latest_row",
    """SELECT * FROM summary QUALIFY row_number() OVER (PARTITION BY pipeline_status ORDER BY run_ts DESC) = 1""",
)
def win_latest_row(ws):
    return quality.newest_by_rank(ws.lake.summary(), ["pipeline_status"])


@query("win_max_partition", "SELECT * FROM newest_rules")
def win_max_partition(ws):
    return marts.rule_results_ranked(ws.lake.outcomes())


# ---------------------------------------------------------------- sort and limit
@query(
    "sort_multi",
    """SELECT transaction_hour, channel, transaction_type, count(*) AS row_count FROM fact GROUP BY ALL
       ORDER BY transaction_hour, row_count DESC, channel, transaction_type""",
)
def sort_multi(ws):
    grouped = ws.current.fact.groupBy("transaction_hour", "channel", "transaction_type").agg(rows())
    return grouped.orderBy("transaction_hour", F.col("row_count").desc(), "channel", "transaction_type")


@query(
    "topk",
    """SELECT source_account_id, count(*) AS txn_count FROM fact GROUP BY ALL
       ORDER BY txn_count DESC, source_account_id LIMIT 25""",
)
def topk(ws):
    grouped = ws.current.fact.groupBy("source_account_id").agg(rows("txn_count"))
    return grouped.orderBy(F.col("txn_count").desc(), "source_account_id").limit(25)


@query("latest_one", "SELECT run_id, run_ts, pipeline_status FROM summary ORDER BY run_ts DESC LIMIT 1")
def latest_one(ws):
    return quality.latest_run(ws.lake.summary()).select("run_id", "run_ts", "pipeline_status")


@query(
    "sample_limit",
    """SELECT transaction_id, source_account_id, dq_fail_reasons FROM quarantine
       WHERE dq_fail_reasons = 'NULL_CHANNEL' ORDER BY transaction_id LIMIT 20""",
)
def sample_limit(ws):
    chosen = ws.newest.quarantined().filter(F.col("dq_fail_reasons") == "NULL_CHANNEL")
    return chosen.select("transaction_id", "source_account_id", "dq_fail_reasons").orderBy("transaction_id").limit(20)


@query(
    "nulls_last_order",
    """SELECT ingest_source, transaction_type, max(transaction_ts) AS newest_ts FROM std
       WHERE transaction_ts IS NULL OR transaction_type IS NOT NULL GROUP BY ALL
       ORDER BY newest_ts DESC NULLS LAST, ingest_source, transaction_type""",
)
def nulls_last_order(ws):
    grouped = ws.from_files.std.groupBy("ingest_source", "transaction_type").agg(
        F.max("transaction_ts").alias("newest_ts")
    )
    order = (F.col("newest_ts").desc_nulls_last(), "ingest_source", "transaction_type")
    return grouped.orderBy(*order)


# ---------------------------------------------------------------- set operations
@query(
    "union_all",
    """SELECT 'fact' AS part, ingest_source, count(*) AS row_count FROM fact GROUP BY ALL
       UNION ALL SELECT 'quarantine', ingest_source, count(*) FROM quarantine GROUP BY ALL""",
)
def union_all(ws):
    parts = {"fact": ws.fact, "quarantine": ws.newest.quarantined()}
    counted = [
        df.groupBy("ingest_source").agg(rows()).select(F.lit(name).alias("part"), "ingest_source", "row_count")
        for name, df in parts.items()
    ]
    return counted[0].unionAll(counted[1])


@query("union_by_name", "SELECT * FROM outcome_history WHERE run_id = '20240201T000000Z'")
def union_by_name(ws):
    """Raw and curated outcomes of one run; the second frame has its columns in another order."""
    outcomes = ws.lake.outcomes().filter(F.col("run_id") == "20240201T000000Z")
    raw = outcomes.filter(F.col("dataset") == "raw_transactions")
    curated = outcomes.filter(F.col("dataset") == "curated_transactions")
    return raw.unionByName(curated.select(*reversed(curated.columns)))


@query(
    "values_table",
    """SELECT reason, dq_dimension, business_rule, coalesce(sum(row_count), 0)::BIGINT AS failing_rows
       FROM reason_names LEFT JOIN reason_history USING (reason) GROUP BY ALL""",
)
def values_table(ws):
    failing = ws.lake.reasons().groupBy("reason").agg(F.sum("row_count").alias("n"))
    joined = quality.reason_table(ws.spark).join(failing, "reason", "left")
    shown = F.coalesce("n", F.lit(0)).cast("bigint").alias("failing_rows")
    return joined.select("reason", "dq_dimension", "business_rule", shown)


@query("distinct_keys", "SELECT DISTINCT source_account_id FROM fact")
def distinct_keys(ws):
    return ws.current.fact.select("source_account_id").distinct()


@query(
    "append_duplicates",
    """SELECT transaction_id, count(*) AS versions, count(DISTINCT transaction_timestamp) AS distinct_times
       FROM raw WHERE transaction_id <> '' GROUP BY ALL HAVING count(*) > 1""",
)
def append_duplicates(ws):
    """Versions of the ids that were delivered more than once."""
    versions = ws.raw.transactions.filter(F.col("transaction_id") != "").groupBy("transaction_id")
    counted = versions.agg(rows("versions"), F.count_distinct("transaction_timestamp").alias("distinct_times"))
    return counted.filter(F.col("versions") > 1)
