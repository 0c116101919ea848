"""The marts, each defined once, as SQL over named relations.

The same text serves frames (`marts`), lasting open views and role-bound views (`catalog`).  Relations stand in braces:
``{fact_transactions}``, ``{dim_customer}``, ..., and ``{visible}`` for the customers a role may see.  A mart with a
row policy is the same mart over an aggregate per customer, of which visible customers are kept; so the fact is always
aggregated before it meets customers, and a hot customer is one row by then.
"""

from __future__ import annotations

from brassledger.operators.quality import SCORECARD

MONEY = "decimal(28,2)"
MONTH = "trunc(transaction_date, 'MM')"
BAND_OUT, BAND_IN = "NET_OUTFLOW", "NET_INFLOW"
INFLOW = "sum(IF(flow_direction = 'INFLOW', amount, 0))"
OUTFLOW = "sum(IF(flow_direction = 'OUTFLOW', amount, 0))"
# A join, as IN would be moved below the aggregate and meet the fact's rows.
SEEN = "LEFT SEMI JOIN (SELECT customer_id AS seen_id FROM {visible}) ON customer_id = seen_id"
TRAITS = ("customer_segment", "state", "risk_tier", "digital_enrolled_flag")
PLACE = ("branch_id", "branch_name", "city", "state", "region")


def _rate(part: str, whole: str) -> str:
    return f"round(CAST({part} AS double) / nullif(CAST({whole} AS double), 0D), 6)"


def _list(names) -> str:
    return ", ".join(names)


def totals(keys: dict[str, str], counts: dict[str, str], money: dict[str, str], secure: bool, where: str = "true") -> str:
    """Counts and sums per key, over all rows or over those of visible customers."""
    named = [f"{e} AS {n}" if e != n else n for n, e in keys.items()]
    measures = [f"{e} AS {n}" for n, e in counts.items()] + [f"CAST({e} AS {MONEY}) AS {n}" for n, e in money.items()]
    by = _list(keys.values())
    if not secure:
        return f"SELECT {_list(named + measures)} FROM {{fact_transactions}} WHERE {where} GROUP BY {by}"
    again = [f"CAST(sum({n}) AS bigint) AS {n}" for n in counts] + [f"CAST(sum({n}) AS {MONEY}) AS {n}" for n in money]
    fine = f"SELECT {_list([*named, 'customer_id', *measures])} FROM {{fact_transactions}} WHERE {where} GROUP BY {by}, customer_id"
    return f"SELECT {_list([*keys, *again])} FROM ({fine}) {SEEN} GROUP BY {_list(keys)}"


def daily_transactions(secure: bool = False) -> str:
    keys = ("transaction_date", "transaction_type", "flow_direction", "channel", "digital_channel_flag", "ingest_source")
    counts = {
        "txn_count": "count(*)",
        "failed_txn_count": "count_if(is_failed)",
        "fraud_labelled_count": "count_if(is_fraud_flag = 1)",
    }
    inner = totals({k: k for k in keys}, counts, {"txn_value": "sum(amount)"}, secure)
    return f"SELECT {_list(keys)}, txn_count, txn_value, failed_txn_count, fraud_labelled_count FROM ({inner})"


def monthly_kpis(secure: bool = False) -> str:
    """Totals and distinct counts take separate paths and meet per month.

    They read almost disjoint columns, so the second scan costs little, while one combined aggregate would drag all
    totals through the expansion for the two distinct counts.
    """
    counts = {"txn_count": "count(*)", "failed": "count_if(is_failed)", "digital": "count_if(digital_channel_flag)"}
    money = {"txn_value": "sum(amount)", "deposit_value": INFLOW, "outflow_value": OUTFLOW, "net_flow": "sum(signed_amount)"}
    pairs = f"SELECT DISTINCT {MONTH} AS month_start, customer_id, source_account_id FROM {{fact_transactions}}"
    if secure:
        pairs = f"SELECT month_start, customer_id, source_account_id FROM ({pairs}) {SEEN}"
    return f"""
        SELECT month_start, txn_count, txn_value, {_rate("txn_value", "txn_count")} AS avg_txn_value, deposit_value,
               outflow_value, net_flow, active_customers, active_accounts,
               {_rate("txn_count", "active_customers")} AS txns_per_customer,
               {_rate("failed", "txn_count")} AS failed_rate, {_rate("digital", "txn_count")} AS digital_share
        FROM ({totals({"month_start": MONTH}, counts, money, secure)})
        JOIN (SELECT month_start AS active_month, count(DISTINCT customer_id) AS active_customers,
                     count(DISTINCT source_account_id) AS active_accounts FROM ({pairs}) GROUP BY month_start)
        ON month_start <=> active_month"""


def monthly_segment(secure: bool = False) -> str:
    """Customers are counted as rows: one per month and customer.  The secure mart has their digital share as well."""
    customers, how = ("{visible}", "JOIN") if secure else ("{dim_customer}", "LEFT JOIN")
    share = f", {_rate('sum(digital)', 'sum(n)')} AS digital_share" if secure else ""
    return f"""
        SELECT month_start, {_list(TRAITS)}, CAST(sum(n) AS bigint) AS txn_count, CAST(sum(spent) AS {MONEY}) AS txn_value,
               count(v.customer_id) AS active_customers{share}
        FROM (SELECT {MONTH} AS month_start, customer_id, count(*) AS n, CAST(sum(amount) AS {MONEY}) AS spent,
                     count_if(digital_channel_flag) AS digital
              FROM {{fact_transactions}} GROUP BY {MONTH}, customer_id) v
        {how} (SELECT customer_id, {_list(TRAITS)} FROM {customers}) c ON v.customer_id = c.customer_id
        GROUP BY month_start, {_list(TRAITS)}"""


def customer_value(secure: bool = False, identifier: str = "v.customer_id") -> str:
    customers, how = ("{visible}", "JOIN") if secure else ("{dim_customer}", "LEFT JOIN")
    traits = ("customer_segment", "state", "risk_tier", "tenure_years", "digital_enrolled_flag")
    return f"""
        SELECT {identifier} AS customer_id, {_list(traits)}, txn_count, txn_value, inflow_value, outflow_value, net_flow,
               {_rate("digital", "txn_count")} AS digital_share, last_txn_date,
               IF(net_flow < 0, '{BAND_OUT}', '{BAND_IN}') AS flow_band
        FROM (SELECT customer_id, count(*) AS txn_count, CAST(sum(amount) AS {MONEY}) AS txn_value,
                     CAST({INFLOW} AS {MONEY}) AS inflow_value, CAST({OUTFLOW} AS {MONEY}) AS outflow_value,
                     CAST(sum(signed_amount) AS {MONEY}) AS net_flow, count_if(digital_channel_flag) AS digital,
                     max(transaction_date) AS last_txn_date
              FROM {{fact_transactions}} WHERE NOT is_failed GROUP BY customer_id) v
        {how} (SELECT customer_id, {_list(traits)} FROM {customers}) c ON v.customer_id = c.customer_id"""


def merchant_monthly(secure: bool = False) -> str:
    keys = {"month_start": MONTH, "merchant_category": "merchant_category", "channel": "channel"}
    return totals(keys, {"txn_count": "count(*)"}, {"txn_value": "sum(amount)"}, secure, "merchant_category IS NOT NULL")


def branch_activity(secure: bool = False) -> str:
    """Branch ids may repeat in the master; the outer aggregate keeps the mart's grain."""
    keys = {"branch_id": "branch_id", "channel": "channel", "month_start": MONTH}
    counted = totals(keys, {"n": "count(*)"}, {"spent": "sum(amount)"}, secure, "branch_id IS NOT NULL")
    return f"""
        SELECT {_list(f"b.{c}" for c in PLACE)}, channel, month_start, CAST(sum(n) AS bigint) AS txn_count,
               CAST(sum(spent) AS {MONEY}) AS txn_value
        FROM ({counted}) t JOIN (SELECT {_list(PLACE)} FROM {{dim_branch}}) b ON t.branch_id = b.branch_id
        GROUP BY {_list(f"b.{c}" for c in PLACE)}, channel, month_start"""


ACCOUNT_BOOK = f"""
    SELECT trunc(open_date, 'YEAR') AS open_year, account_type, account_status, count(*) AS accounts,
           CAST(sum(current_balance) AS {MONEY}) AS total_balance,
           {_rate("sum(current_balance)", "count(current_balance)")} AS avg_balance
    FROM {{dim_account}} GROUP BY trunc(open_date, 'YEAR'), account_type, account_status"""
RULE_RESULTS = """
    SELECT run_id, run_ts, dataset, rule, outcome, failure_reason, IF(outcome = 'Passed', 1, 0) AS passed_flag
    FROM {rule_outcomes}
    WHERE (dataset, run_ts) IN (SELECT dataset, max(run_ts) FROM {rule_outcomes} GROUP BY dataset)"""
RUN_HISTORY = """
    SELECT run_id, run_ts, pipeline_status, raw_rows, curated_rows, quarantined_rows, quarantine_rate,
           max_quarantine_rate, raw_dq_score, curated_dq_score, accounts_quarantined FROM {run_summary}"""
QUARANTINE_REASONS = "SELECT run_id, run_ts, reason, ingest_source, row_count FROM {quarantine_reasons}"

OPEN = {
    "mart_daily_transactions": daily_transactions(),
    "mart_monthly_kpis": monthly_kpis(),
    "mart_monthly_segment": monthly_segment(),
    "mart_customer_value": customer_value(),
    "mart_merchant_monthly": merchant_monthly(),
    "mart_branch_activity": branch_activity(),
    "mart_account_book": ACCOUNT_BOOK,
    "mart_dq_rule_results": RULE_RESULTS,
    "mart_dq_run_history": RUN_HISTORY,
    "mart_quarantine_reasons": QUARANTINE_REASONS,
}
#: Over ``{visible}``; identifiers pass through the function ``{mask_identifier}`` after the aggregation.
SECURE = {
    "mart_monthly_kpis": monthly_kpis(True),
    "mart_daily_transactions": daily_transactions(True),
    "mart_monthly_segment": monthly_segment(True),
    "mart_customer_value": customer_value(True, "{mask_identifier}(v.customer_id)"),
    "mart_merchant_monthly": merchant_monthly(True),
    "mart_branch_activity": branch_activity(True),
    "mart_dq_scorecard": SCORECARD,
    "mart_dq_run_history": RUN_HISTORY,
    "mart_dq_rule_results": RULE_RESULTS,
    "mart_quarantine_reasons": QUARANTINE_REASONS,
}
