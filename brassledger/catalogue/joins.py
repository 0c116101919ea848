"""Joins, each in the form the pipeline uses it."""

from __future__ import annotations

from pyspark.sql import functions as F

from brassledger.catalogue.core import query
from brassledger.functions import columns as C
from brassledger.operators import governance as G
from brassledger.operators import quality, validate
from brassledger.plans import analysis, marts


def rows(name: str = "row_count"):
    return F.count(F.lit(1)).alias(name)


@query(
    "join_known_accounts",
    """SELECT ingest_source, source_account_id IS NOT NULL AS has_account, a.account_id IS NOT NULL AS known,
              count(*) AS row_count
       FROM std LEFT JOIN all_account a ON source_account_id = a.account_id GROUP BY ALL""",
)
def join_known_accounts(ws):
    looked_up = validate.with_owner(ws.run.std, ws.run.account_master)
    has_account = F.col("source_account_id").isNotNull().alias("has_account")
    return looked_up.groupBy("ingest_source", has_account, F.col("owner").isNotNull().alias("known")).agg(rows())


@query(
    "join_orphans_anti",
    """SELECT transaction_id, source_account_id FROM std
       WHERE source_account_id IS NOT NULL AND source_account_id NOT IN (SELECT account_id FROM all_account)""",
)
def join_orphans_anti(ws):
    with_account = ws.run.std.filter(F.col("source_account_id").isNotNull())
    known = ws.run.account_master.select(F.col("account_id").alias("source_account_id"))
    orphans = with_account.join(known, "source_account_id", "left_anti")
    return orphans.select("transaction_id", "source_account_id")


@query("join_enrich_account", "SELECT transaction_id, source_account_id, customer_id, account_type FROM fact")
def join_enrich_account(ws):
    return ws.run.fact.select("transaction_id", "source_account_id", "customer_id", "account_type")


@query(
    "join_left_customer",
    """SELECT c.state, count(*) AS txn_count, count(*) FILTER (c.customer_id IS NULL) AS without_customer
       FROM checked t LEFT JOIN dim_customer c ON t.customer_id = c.customer_id GROUP BY ALL""",
)
def join_left_customer(ws):
    """All checked raw rows, where owners are really missing, against the whole dimension."""
    per_customer = ws.run.checked.groupBy(F.col("owner.customer_id").alias("customer_id")).agg(rows("n"))
    known = ws.dim_customer.select("customer_id", "state", F.lit(True).alias("found"))
    joined = per_customer.join(known, "customer_id", "left")
    missing = F.when(F.col("found").isNull(), F.col("n")).otherwise(F.lit(0))
    return joined.groupBy("state").agg(
        F.sum("n").alias("txn_count"), F.sum(missing).cast("bigint").alias("without_customer")
    )


@query(
    "join_inner_customer",
    """SELECT customer_segment, risk_tier, count(*) AS txn_count, sum(amount)::DECIMAL(28,2) AS txn_value
       FROM fact JOIN dim_customer USING (customer_id) GROUP BY ALL""",
)
def join_inner_customer(ws):
    per_customer = ws.current.fact.groupBy("customer_id").agg(rows("n"), C.total("amount").alias("v"))
    joined = per_customer.join(ws.current.dim_customer.select("customer_id", "customer_segment", "risk_tier"), "customer_id")
    return joined.groupBy("customer_segment", "risk_tier").agg(
        F.sum("n").alias("txn_count"), C.total("v").alias("txn_value")
    )


@query(
    "join_inner_branch",
    """SELECT b.branch_id, region, count(*) AS txn_count FROM fact t JOIN dim_branch b ON t.branch_id = b.branch_id
       GROUP BY ALL""",
)
def join_inner_branch(ws):
    per_branch = ws.current.fact.filter(F.col("branch_id").isNotNull()).groupBy("branch_id").agg(rows("txn_count"))
    return per_branch.join(ws.current.dim_branch.select("branch_id", "region"), "branch_id").select(
        "branch_id", "region", "txn_count"
    )


@query(
    "join_three_way",
    """SELECT customer_segment, b.region, count(*) AS txn_count, sum(amount)::DECIMAL(28,2) AS txn_value
       FROM fact t JOIN dim_customer c ON t.customer_id = c.customer_id JOIN dim_branch b ON t.branch_id = b.branch_id
       GROUP BY ALL""",
)
def join_three_way(ws):
    pairs = (
        ws.current.fact.filter(F.col("branch_id").isNotNull())
        .groupBy("customer_id", "branch_id")
        .agg(rows("n"), C.total("amount").alias("v"))
    )
    joined = pairs.join(ws.current.dim_branch.select("branch_id", "region"), "branch_id").join(
        ws.current.dim_customer.select("customer_id", "customer_segment"), "customer_id"
    )
    return joined.groupBy("customer_segment", "region").agg(
        F.sum("n").alias("txn_count"), C.total("v").alias("txn_value")
    )


@query(
    "join_account_fact",
    """SELECT a.account_type, account_status, count(*) AS txn_count, count(DISTINCT a.account_id) AS accounts_used
       FROM dim_account a JOIN fact t ON t.source_account_id = a.account_id GROUP BY ALL""",
)
def join_account_fact(ws):
    used = ws.current.fact.groupBy(F.col("source_account_id").alias("account_id")).agg(rows("n"))
    joined = ws.current.dim_account.select("account_id", "account_type", "account_status").join(used, "account_id")
    return joined.groupBy("account_type", "account_status").agg(
        F.sum("n").alias("txn_count"), rows("accounts_used")
    )


@query(
    "bounds_cross_join",
    """WITH b AS (SELECT max(transaction_date) AS newest FROM fact)
       SELECT newest, transaction_type, count(*) AS txn_count FROM fact, b
       WHERE transaction_date > newest - INTERVAL 3 MONTH GROUP BY ALL""",
)
def bounds_cross_join(ws):
    """The one-row bound as a scalar subquery: no join is planned at all."""
    newest = analysis.newest_date(ws.fact)
    return analysis.recent(ws.fact, 3).groupBy(newest.alias("newest"), "transaction_type").agg(rows("txn_count"))


@query("join_latest_per_dataset", "SELECT * FROM newest_rules")
def join_latest_per_dataset(ws):
    return marts.rule_results(ws.lake.outcomes())


@query(
    "join_rule_compare",
    """SELECT r.rule, r.outcome AS raw_outcome, c.outcome AS curated_outcome, r.failure_reason
       FROM newest_rules r LEFT JOIN newest_rules c ON r.rule = c.rule AND c.dataset = 'curated_transactions'
       WHERE r.dataset = 'raw_transactions'""",
)
def join_rule_compare(ws):
    return analysis.rule_compare(marts.rule_results(ws.lake.outcomes()))


@query(
    "join_ri_left",
    """SELECT 'raw.source_account_id -> dim_account' AS check_name,
              count(*) FILTER (a.account_id IS NULL) AS failing_rows, count(*) AS evaluated_rows
       FROM std LEFT JOIN dim_account a ON source_account_id = a.account_id""",
)
def join_ri_left(ws):
    """On raw rows, where keys are really missing."""
    return quality.unmatched(
        ws.run.std, "source_account_id", ws.dim_account, "account_id", "raw.source_account_id -> dim_account"
    )


@query(
    "join_latest_run",
    """SELECT reason, ingest_source, row_count, raw_rows FROM reason_history
       JOIN (SELECT run_id, raw_rows FROM summary ORDER BY run_ts DESC LIMIT 1) USING (run_id)""",
)
def join_latest_run(ws):
    newest = quality.latest_run(ws.lake.summary()).select("run_id", "raw_rows")
    joined = ws.lake.reasons().join(newest, "run_id")
    return joined.select("reason", "ingest_source", "row_count", "raw_rows")


@query("join_scorecard", "SELECT rule_code, failing_rows, evaluated_rows FROM scorecard")
def join_scorecard(ws):
    card = quality.scorecard(ws.lake.summary(), ws.lake.reasons())
    return card.select("rule_code", "failing_rows", "evaluated_rows")


@query(
    "semi_exists_entitlement",
    """SELECT role_name, state, count(*) AS customers FROM dim_customer,
              (VALUES ('BANK_DATA_ENGINEER'), ('BANK_ANALYST'), ('BANK_ANALYST_MID_ATLANTIC')) r(role_name)
       WHERE role_name IN ('BANK_DATA_ENGINEER', 'BANK_ANALYST') OR state IN ('MD', 'VA', 'DC', 'DE', 'PA')
       GROUP BY ALL""",
)
def semi_exists_entitlement(ws):
    roles = [G.ENGINEER, G.ANALYST, G.REGIONAL]
    return G.visible_per_role(ws.current.dim_customer, roles, G.entitlements(ws.spark))


@query(
    "scalar_subquery",
    """SELECT reason, row_count, (SELECT count(*) FROM fact) AS fact_rows,
              (SELECT max(run_id) FROM summary) AS newest_run
       FROM reason_history WHERE run_id = (SELECT max(run_id) FROM reason_history)""",
)
def scalar_subquery(ws):
    reasons = ws.lake.reasons()
    newest = reasons.agg(F.max("run_id")).scalar()
    return reasons.filter(F.col("run_id") == newest).select(
        "reason",
        "row_count",
        ws.fact.agg(F.count(F.lit(1))).scalar().alias("fact_rows"),
        ws.lake.summary().agg(F.max("run_id")).scalar().alias("newest_run"),
    )
