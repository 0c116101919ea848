"""Dashboard sheets: small re-aggregations of marts, never of the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brassledger.functions import columns as C
from brassledger.plans.marts import BAND_OUT


def _sum(name: str) -> Column:
    return F.sum(name).cast("bigint")


def _ratio(part: Column, whole: Column, digits: int = 6) -> Column:
    return F.round(C.share(part, whole), digits)


# ---------------------------------------------------------------- overview
def failed_rate(daily: DataFrame) -> DataFrame:
    grouped = daily.groupBy("transaction_date")
    return grouped.agg(_ratio(F.sum("failed_txn_count"), F.sum("txn_count")).alias("failed_rate"))


def digital_share_daily(daily: DataFrame) -> DataFrame:
    digital = F.sum(F.when(F.col("digital_channel_flag"), F.col("txn_count")).otherwise(F.lit(0)))
    return daily.groupBy("transaction_date").agg(_ratio(digital, F.sum("txn_count")).alias("digital_share"))


def latest_month(kpis: DataFrame) -> DataFrame:
    """Each month with a marker on the newest (a row per month: the open window is small)."""
    newest = F.max("month_start").over(Window.partitionBy())
    return kpis.select("month_start", "txn_count", (F.col("month_start") == newest).alias("is_latest_month"))


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """Cards of the newest month."""
    newest = kpis.agg(F.max("month_start")).scalar()
    return kpis.filter(F.col("month_start") == newest).select(
        "month_start", "txn_value", "deposit_value", "net_flow", "active_customers", "digital_share", "failed_rate"
    )


def value_by_type(daily: DataFrame) -> DataFrame:
    grouped = daily.groupBy("transaction_type")
    return grouped.agg(_sum("txn_count").alias("txn_count"), C.total("txn_value").alias("txn_value"))


def channel_mix(daily: DataFrame) -> DataFrame:
    month = C.month_start("transaction_date").alias("month_start")
    grouped = daily.groupBy(month, "channel").agg(_sum("txn_count").alias("txn_count"))
    whole = F.sum("txn_count").over(Window.partitionBy("month_start"))
    return grouped.withColumn("channel_share", _ratio(F.col("txn_count"), whole))


# ---------------------------------------------------------------- customers
def state_value(segment: DataFrame) -> DataFrame:
    grouped = segment.groupBy("state")
    return grouped.agg(_sum("txn_count").alias("txn_count"), C.total("txn_value").alias("txn_value"))


def segment_digital(segment: DataFrame) -> DataFrame:
    """Digital share per segment and enrolment, weighted by transactions."""
    weighted = F.sum(F.col("digital_share") * F.col("txn_count"))
    return segment.groupBy("customer_segment", "digital_enrolled_flag").agg(
        _sum("txn_count").alias("txn_count"), _ratio(weighted, F.sum("txn_count"), 4).alias("digital_share")
    )


def netflow_histogram(value: DataFrame, width: int = 100_000) -> DataFrame:
    bin_start = (F.floor(F.col("net_flow").cast("double") / width) * width).cast("bigint")
    grouped = value.groupBy(bin_start.alias("bin_start"), "flow_band")
    return grouped.agg(F.count(F.lit(1)).alias("customers"))


def top_outflow(value: DataFrame, top: int = 20) -> DataFrame:
    losing = value.filter(F.col("flow_band") == BAND_OUT)
    shown = losing.select("customer_id", "state", "customer_segment", "net_flow")
    return shown.orderBy("net_flow", "customer_id").limit(top)


def merchant_treemap(merchant: DataFrame) -> DataFrame:
    grouped = merchant.groupBy("merchant_category")
    return grouped.agg(_sum("txn_count").alias("txn_count"), C.total("txn_value").alias("txn_value"))


# ---------------------------------------------------------------- quality
def pass_by_dimension(scorecard: DataFrame) -> DataFrame:
    """Pass rate over all checks of a dimension: 1 - failing / evaluated."""
    failing, evaluated = F.sum("failing_rows"), F.sum("evaluated_rows")
    return scorecard.groupBy("dq_dimension").agg(
        failing.cast("bigint").alias("failing_rows"),
        F.round(C.share(evaluated - failing, evaluated, 100.0), 4).alias("pass_rate_pct"),
    )


def rows_by_reason(reasons: DataFrame) -> DataFrame:
    """One row per reason, one column per path, newest run."""
    newest = reasons.agg(F.max("run_id")).scalar()
    current = reasons.filter(F.col("run_id") == newest)
    wide = current.groupBy("reason").pivot("ingest_source", ["BATCH", "STREAM"]).agg(F.sum("row_count"))
    return wide.select(
        "reason",
        *[F.coalesce(F.col(p), F.lit(0)).cast("bigint").alias(f"{p.lower()}_rows") for p in ("BATCH", "STREAM")],
    )


def rule_table(rule_results: DataFrame) -> DataFrame:
    """Rules as rows, datasets as columns."""
    datasets = ["raw_transactions", "curated_transactions"]
    wide = rule_results.groupBy("rule").pivot("dataset", datasets).agg(F.max("outcome"))
    return wide.toDF("rule", "raw_outcome", "curated_outcome")


def run_trend(history: DataFrame, reference: float = 0.05) -> DataFrame:
    pct = F.round(F.col("quarantine_rate") * 100, 4)
    return history.select(
        "run_ts",
        "pipeline_status",
        pct.alias("quarantine_pct"),
        F.lit(reference * 100).alias("reference_pct"),
        (F.col("quarantine_rate") > reference).alias("above_reference"),
        "raw_dq_score",
        "curated_dq_score",
    )


def quarantine_pct(history: DataFrame) -> DataFrame:
    return history.select("run_id", F.round(F.col("quarantine_rate") * 100, 4).alias("quarantine_rate_pct"))
