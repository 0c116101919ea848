"""KPI, channel and data-quality analyses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brassledger.functions import columns as C
from brassledger.operators import quality
from brassledger.operators.standardise import instant


def _rows() -> Column:
    return F.count(F.lit(1))


def _month() -> Column:
    return C.month_start("transaction_date").alias("month_start")


def _percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(C.share(part, whole, 100.0), digits)


# ---------------------------------------------------------------- KPIs
def monthly_value(fact: DataFrame) -> DataFrame:
    grouped = fact.groupBy(_month()).agg(_rows().alias("txn_count"), C.total("amount").alias("txn_value"))
    return grouped.orderBy("month_start")


def deposits_trend(fact: DataFrame) -> DataFrame:
    inflow = F.col("flow_direction") == "INFLOW"
    months = (
        fact.filter(~F.col("is_failed"))
        .groupBy(_month())
        .agg(C.total(C.money_if(inflow)).alias("deposits"), C.total(C.money_if(~inflow)).alias("outflows"))
    )
    # One row per calendar month by now, so the unpartitioned window stays tiny.
    previous = F.lag("deposits").over(Window.orderBy("month_start"))
    shown = months.select(
        "month_start",
        "deposits",
        "outflows",
        (F.col("deposits") - F.col("outflows")).cast("decimal(28,2)").alias("net_flow"),
        _percent(F.col("deposits") - previous, previous, 2).alias("deposits_mom_pct"),
    )
    return shown.orderBy("month_start")


def value_percentiles(fact: DataFrame, accuracy: int = 100_000) -> DataFrame:
    """Mean, median and p95 by type.

    Quantile sketches merge, so a hot type is no issue.  Results are exact up to
    about `accuracy` rows per group and approximate above (error in rank at most
    rows / accuracy), so on larger data they can differ from an exact oracle.
    """
    both = F.percentile_approx("amount", [0.5, 0.95], accuracy)
    grouped = fact.groupBy("transaction_type").agg(
        _rows().alias("txn_count"), F.sum("amount").alias("total"), both.alias("cuts")
    )
    return grouped.select(
        "transaction_type",
        "txn_count",
        F.round(C.share(F.col("total"), F.col("txn_count")), 2).alias("avg_value"),
        F.col("cuts")[0].alias("median_value"),
        F.col("cuts")[1].alias("p95_value"),
    ).orderBy(F.col("txn_count").desc(), "transaction_type")


def active_customers(fact: DataFrame) -> DataFrame:
    per_customer = fact.groupBy(_month(), "customer_id").agg(_rows().alias("n"))
    months = per_customer.groupBy("month_start").agg(
        F.count("customer_id").alias("active_customers"), F.sum("n").alias("n")
    )
    return months.select(
        "month_start",
        "active_customers",
        F.round(C.share(F.col("n"), F.col("active_customers")), 2).alias("txns_per_customer"),
    ).orderBy("month_start")


def failed_rate(fact: DataFrame, min_rows: int = 1000) -> DataFrame:
    grouped = fact.groupBy("transaction_type", "channel").agg(
        _rows().alias("txn_count"), F.count_if("is_failed").alias("failed")
    )
    kept = grouped.filter(F.col("txn_count") > min_rows)
    return kept.select(
        "transaction_type",
        "channel",
        "txn_count",
        _percent(F.col("failed"), F.col("txn_count"), 3).alias("failed_pct"),
    ).orderBy(F.col("failed_pct").desc(), "transaction_type", "channel")


def top_state_segment(fact: DataFrame, customers: DataFrame, top: int = 15) -> DataFrame:
    per_customer = fact.groupBy("customer_id").agg(_rows().alias("n"), C.total("amount").alias("v"))
    joined = per_customer.join(customers.select("customer_id", "state", "customer_segment"), "customer_id")
    grouped = joined.groupBy("state", "customer_segment").agg(
        F.sum("n").cast("bigint").alias("txn_count"), C.total("v").alias("txn_value")
    )
    best = grouped.orderBy(F.col("txn_value").desc(), "state", "customer_segment").limit(top)
    # Ranks of the best rows depend on nothing below them, so ranking follows the cut.
    rank = F.rank().over(Window.orderBy(F.col("txn_value").desc()))
    return best.withColumn("value_rank", rank).orderBy("value_rank", "state", "customer_segment")


def newest_date(fact: DataFrame) -> Column:
    """The newest transaction date as a scalar; with folder columns it is looked for in the newest folder only."""
    if {"year", "month"} <= set(fact.columns):
        folder = F.col("year") * 12 + F.col("month")
        fact = fact.filter(folder == fact.agg(F.max(folder)).scalar())
    return fact.agg(F.max("transaction_date")).scalar()


def recent(fact: DataFrame, months: int = 3) -> DataFrame:
    """Rows dated after `months` months before the newest date.

    When the fact still has its folder columns, the same bound is put on them,
    so old folders are skipped although the caller filters by date only.
    """
    start = F.add_months(newest_date(fact), -months)
    kept = fact.filter(F.col("transaction_date") > start)
    if {"year", "month"} <= set(fact.columns):
        kept = kept.filter(F.col("year") * 12 + F.col("month") >= F.year(start) * 12 + F.month(start))
    return kept


def net_outflow_recent(fact: DataFrame, customers: DataFrame, months: int = 3, top: int = 50) -> DataFrame:
    window = recent(fact, months).filter(~F.col("is_failed"))
    flows = window.groupBy("customer_id").agg(
        C.total("signed_amount").alias("net_flow_3m"), _rows().alias("txn_count_3m")
    )
    losing = flows.filter(F.col("net_flow_3m") < 0)
    joined = losing.join(customers.select("customer_id", "customer_segment", "state"), "customer_id")
    shown = joined.select("customer_id", "customer_segment", "state", "net_flow_3m", "txn_count_3m")
    return shown.orderBy("net_flow_3m", "customer_id").limit(top)


def accounts_opened(accounts: DataFrame) -> DataFrame:
    grouped = accounts.groupBy(F.year("open_date").alias("open_year"), "account_type")
    return grouped.agg(_rows().alias("accounts_opened")).orderBy("open_year", "account_type")


def dormant_active(fact: DataFrame, accounts: DataFrame, top: int = 25) -> DataFrame:
    idle = accounts.filter(F.col("account_status").isin("DORMANT", "CLOSED")).select("account_id", "account_status")
    used = fact.groupBy(F.col("source_account_id").alias("account_id")).agg(
        _rows().alias("txn_count"), F.max("transaction_date").alias("last_txn")
    )
    joined = idle.join(used, "account_id")
    return joined.orderBy(F.col("txn_count").desc(), "account_id").limit(top)


# ---------------------------------------------------------------- channels
def channel_mix(fact: DataFrame) -> DataFrame:
    grouped = fact.groupBy(_month(), "channel").agg(_rows().alias("txn_count"))
    whole = F.sum("txn_count").over(Window.partitionBy("month_start"))
    return grouped.withColumn("share_pct", _percent(F.col("txn_count"), whole, 2)).orderBy("month_start", "channel")


def digital_adoption(fact: DataFrame, customers: DataFrame) -> DataFrame:
    per_customer = fact.groupBy("customer_id").agg(
        _rows().alias("n"), F.count_if("digital_channel_flag").alias("digital")
    )
    traits = ("customer_segment", "digital_enrolled_flag")
    joined = per_customer.join(customers.select("customer_id", *traits), "customer_id")
    return (
        joined.groupBy(*traits)
        .agg(
            F.count("customer_id").alias("customers"),
            _percent(F.sum("digital"), F.sum("n"), 2).alias("digital_txn_pct"),
        )
        .orderBy(*traits)
    )


def hourly_profile(fact: DataFrame) -> DataFrame:
    grouped = fact.groupBy("transaction_hour", "channel").agg(_rows().alias("txn_count"))
    return grouped.orderBy("transaction_hour", "channel")


def busiest_branches(fact: DataFrame, branches: DataFrame, top: int = 15) -> DataFrame:
    at_branch = fact.filter(F.col("branch_id").isNotNull())
    counted = at_branch.groupBy("branch_id").agg(
        _rows().alias("n"), F.count_if(F.col("channel") == "ATM").alias("atm")
    )
    joined = counted.join(branches.select("branch_id", "branch_name", "region"), "branch_id")
    grouped = joined.groupBy("branch_name", "region").agg(
        F.sum("n").cast("bigint").alias("txn_count"), _percent(F.sum("atm"), F.sum("n"), 1).alias("atm_share_pct")
    )
    return grouped.orderBy(F.col("txn_count").desc(), "branch_name", "region").limit(top)


def merchant_share(fact: DataFrame) -> DataFrame:
    spent = fact.filter(F.col("merchant_category").isNotNull())
    grouped = spent.groupBy("merchant_category").agg(C.total("amount").alias("spend"))
    # One row per category by now.
    whole = F.sum("spend").over(Window.partitionBy())
    shown = grouped.withColumn("spend_share_pct", _percent(F.col("spend"), whole, 2))
    return shown.orderBy(F.col("spend").desc(), "merchant_category")


# ---------------------------------------------------------------- data quality
def latest_run(summary: DataFrame) -> DataFrame:
    return quality.latest_run(summary)


def latest_reasons(reasons: DataFrame) -> DataFrame:
    """Run ids sort by time as text."""
    newest = reasons.agg(F.max("run_id")).scalar()
    shown = reasons.filter(F.col("run_id") == newest).select("reason", "ingest_source", "row_count")
    return shown.orderBy(F.col("row_count").desc(), "reason", "ingest_source")


def rule_compare(rule_results: DataFrame) -> DataFrame:
    """Raw against curated outcome of each rule.

    Takes the newest run per dataset, so after a blocked run the curated side
    is from an older run than the raw side.
    """
    raw = rule_results.filter(F.col("dataset") == "raw_transactions")
    curated = rule_results.filter(F.col("dataset") == "curated_transactions")
    joined = raw.join(curated.select("rule", F.col("outcome").alias("curated_outcome")), "rule", "left")
    shown = joined.select("rule", F.col("outcome").alias("raw_outcome"), "curated_outcome", "failure_reason")
    return shown.orderBy("raw_outcome", "rule")


def quality_trend(summary: DataFrame) -> DataFrame:
    return summary.select(
        "run_ts",
        "pipeline_status",
        "raw_dq_score",
        "curated_dq_score",
        F.round(F.col("quarantine_rate") * 100, 3).alias("quarantine_pct"),
    ).orderBy("run_ts")


def has_reason(reason: str) -> Column:
    """Exact membership; a substring test would also match longer codes."""
    return F.array_contains(F.split("dq_fail_reasons", ","), reason)


def sample_quarantine(quarantine: DataFrame, reason: str = "ORPHAN_ACCOUNT", rows: int = 20) -> DataFrame:
    """A fixed-order sample for root-cause work."""
    columns = (
        "transaction_id", "source_account_id", "raw_amount", "raw_transaction_timestamp",
        "transaction_type", "channel", "dq_fail_reasons", "source_file",
    )
    return quarantine.filter(has_reason(reason)).select(*columns).orderBy(*columns).limit(rows)


def reconcile(summary: DataFrame, fact: DataFrame) -> DataFrame:
    """0 means every raw row is either published or quarantined.

    After a blocked run the fact is an older run's, and a difference is due.
    """
    published = fact.agg(_rows()).scalar()
    newest = quality.latest_run(summary)
    return newest.select(
        "raw_rows",
        "curated_rows",
        "quarantined_rows",
        published.alias("curated_in_catalog"),
        (F.col("raw_rows") - published - F.col("quarantined_rows")).alias("unexplained_diff"),
    )


def freshness(fact: DataFrame, as_of: dt.datetime) -> DataFrame:
    grouped = fact.groupBy("ingest_source").agg(F.max("transaction_ts").alias("newest_txn"))
    hours = C.whole_hours("newest_txn", instant(as_of))
    return grouped.withColumn("hours_since_newest", hours)
