"""Marts over the star schema, as frames.

Open marts see everything; secure marts see the fact through the customers a role may see.  What a mart is, stands in
`mart_sql`; here it is applied to frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brassledger.functions.relations import over
from brassledger.operators import governance as G
from brassledger.operators import quality
from brassledger.plans import mart_sql as M

BAND_OUT, BAND_IN = M.BAND_OUT, M.BAND_IN


def _seen_by(visible: DataFrame | None) -> dict[str, DataFrame]:
    return {} if visible is None else {"visible": visible}


# ---------------------------------------------------------------- open marts, or with the customers a role may see
def daily_transactions(fact: DataFrame, visible: DataFrame | None = None) -> DataFrame:
    return over(M.daily_transactions(visible is not None), fact_transactions=fact, **_seen_by(visible))


def monthly_kpis(fact: DataFrame, visible: DataFrame | None = None) -> DataFrame:
    return over(M.monthly_kpis(visible is not None), fact_transactions=fact, **_seen_by(visible))


def monthly_segment(fact: DataFrame, customers: DataFrame, secure: bool = False) -> DataFrame:
    return over(M.monthly_segment(secure), fact_transactions=fact, **{"visible" if secure else "dim_customer": customers})


def customer_value(fact: DataFrame, customers: DataFrame, secure: bool = False) -> DataFrame:
    return over(M.customer_value(secure), fact_transactions=fact, **{"visible" if secure else "dim_customer": customers})


def merchant_monthly(fact: DataFrame, visible: DataFrame | None = None) -> DataFrame:
    return over(M.merchant_monthly(visible is not None), fact_transactions=fact, **_seen_by(visible))


def branch_activity(fact: DataFrame, branches: DataFrame, visible: DataFrame | None = None) -> DataFrame:
    return over(M.branch_activity(visible is not None), fact_transactions=fact, dim_branch=branches, **_seen_by(visible))


def account_book(accounts: DataFrame) -> DataFrame:
    return over(M.ACCOUNT_BOOK, dim_account=accounts)


# ---------------------------------------------------------------- quality marts
def rule_results(outcomes: DataFrame) -> DataFrame:
    """Outcomes of the newest run of each dataset, by joining the newest time."""
    return over(M.RULE_RESULTS, rule_outcomes=outcomes)


def rule_results_ranked(outcomes: DataFrame) -> DataFrame:
    """The same through a window maximum, over one row per run and dataset and never the history itself."""
    runs = outcomes.groupBy("dataset", "run_ts").agg(F.max("run_ts").alias("_own"))
    newest = F.max("_own").over(Window.partitionBy("dataset"))
    runs = runs.withColumn("_newest", newest).filter(F.col("_own") == F.col("_newest"))
    return _rule_columns(outcomes.join(runs.select("dataset", "run_ts"), ["dataset", "run_ts"], "left_semi"))


def _rule_columns(outcomes: DataFrame) -> DataFrame:
    passed = F.when(F.col("outcome") == "Passed", 1).otherwise(0)
    return outcomes.select(
        "run_id", "run_ts", "dataset", "rule", "outcome", "failure_reason", passed.alias("passed_flag")
    )


def run_history(summary: DataFrame) -> DataFrame:
    return over(M.RUN_HISTORY, run_summary=summary)


def quarantine_reasons(reasons: DataFrame) -> DataFrame:
    return over(M.QUARANTINE_REASONS, quarantine_reasons=reasons)


# ---------------------------------------------------------------- secure marts
class SecureMarts:
    """The marts as one role sees them.

    Here the role is known when the frame is made; for views that follow whoever reads them, see `catalog`.
    Identifiers are masked last: grouping by the key or by its hash is the same, and each customer is hashed once.
    """

    def __init__(self, fact: DataFrame, customers: DataFrame, role: str):
        self.role = role
        self.fact = fact
        self.customers = G.visible_rows(customers, role)

    def daily_transactions(self) -> DataFrame:
        return daily_transactions(self.fact, self.customers)

    def monthly_kpis(self) -> DataFrame:
        return monthly_kpis(self.fact, self.customers)

    def monthly_segment(self) -> DataFrame:
        return monthly_segment(self.fact, self.customers, secure=True)

    def customer_value(self) -> DataFrame:
        mart = customer_value(self.fact, self.customers, secure=True)
        return mart.withColumn("customer_id", G.mask_identifier("customer_id", self.role))

    def merchant_monthly(self) -> DataFrame:
        return merchant_monthly(self.fact, self.customers)

    def branch_activity(self, branches: DataFrame) -> DataFrame:
        return branch_activity(self.fact, branches, self.customers)


def all_secure(seen: SecureMarts, dim_branch, scorecard, outcomes, summary, reasons) -> dict[str, DataFrame]:
    """The ten marts one role may export, by name."""
    return {
        "mart_monthly_kpis": seen.monthly_kpis(),
        "mart_daily_transactions": seen.daily_transactions(),
        "mart_monthly_segment": seen.monthly_segment(),
        "mart_customer_value": seen.customer_value(),
        "mart_merchant_monthly": seen.merchant_monthly(),
        "mart_branch_activity": seen.branch_activity(dim_branch),
        "mart_dq_scorecard": scorecard,
        "mart_dq_run_history": run_history(summary),
        "mart_dq_rule_results": rule_results(outcomes),
        "mart_quarantine_reasons": quarantine_reasons(reasons),
    }


def all_open(fact, dim_customer, dim_account, dim_branch, outcomes, summary, reasons) -> dict[str, DataFrame]:
    """The ten open marts by name."""
    return {
        "mart_daily_transactions": daily_transactions(fact),
        "mart_monthly_kpis": monthly_kpis(fact),
        "mart_monthly_segment": monthly_segment(fact, dim_customer),
        "mart_customer_value": customer_value(fact, dim_customer),
        "mart_merchant_monthly": merchant_monthly(fact),
        "mart_branch_activity": branch_activity(fact, dim_branch),
        "mart_account_book": account_book(dim_account),
        "mart_dq_rule_results": rule_results(outcomes),
        "mart_dq_run_history": run_history(summary),
        "mart_quarantine_reasons": quarantine_reasons(reasons),
    }


def marts_as(snapshot, role: str) -> dict[str, DataFrame]:
    """The ten marts a role may export, all of one snapshot of the lake."""
    seen = SecureMarts(snapshot.fact(), snapshot.dimension("dim_customer"), role)
    summary, reasons = snapshot.summary(), snapshot.reasons()
    card = quality.scorecard(summary, reasons)
    return all_secure(seen, snapshot.dimension("dim_branch"), card, snapshot.outcomes(), summary, reasons)
