"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from brassledger.catalogue.core import query
from brassledger.functions import columns as C
from brassledger.operators import rules


def rows(name: str = "txn_count"):
    return F.count(F.lit(1)).alias(name)


@query(
    "agg_count_sum_avg",
    """SELECT transaction_type, channel, count(*) AS txn_count, sum(amount)::DECIMAL(28,2) AS txn_value,
              round(sum(amount)::DOUBLE / count(*), 6) AS avg_value FROM fact GROUP BY ALL""",
)
def agg_count_sum_avg(ws):
    mean = F.round(C.share(F.sum("amount"), F.count("amount")), 6)
    return ws.current.fact.groupBy("transaction_type", "channel").agg(
        rows(), C.total("amount").alias("txn_value"), mean.alias("avg_value")
    )


@query(
    "agg_conditional",
    """SELECT month_start, count(*) FILTER (is_failed) AS failed_txn_count,
              coalesce(sum(amount) FILTER (flow_direction = 'INFLOW'), 0)::DECIMAL(28,2) AS deposit_value,
              round(count(*) FILTER (digital_channel_flag) / count(*)::DOUBLE, 6) AS digital_share
       FROM fact GROUP BY ALL""",
)
def agg_conditional(ws):
    month = C.month_start("transaction_date").alias("month_start")
    inflow = F.col("flow_direction") == "INFLOW"
    return ws.current.fact.groupBy(month).agg(
        F.count_if("is_failed").alias("failed_txn_count"),
        C.total(C.money_if(inflow)).alias("deposit_value"),
        F.round(C.share(F.count_if("digital_channel_flag"), F.count(F.lit(1))), 6).alias("digital_share"),
    )


@query(
    "agg_count_distinct",
    """SELECT transaction_type, count(DISTINCT customer_id) AS customers,
              count(DISTINCT source_account_id) AS accounts FROM fact GROUP BY ALL""",
)
def agg_count_distinct(ws):
    pairs = ws.current.fact.groupBy("transaction_type", "customer_id", "source_account_id").agg(rows("n"))
    return pairs.groupBy("transaction_type").agg(
        F.count_distinct("customer_id").alias("customers"), F.count_distinct("source_account_id").alias("accounts")
    )


@query(
    "agg_ratio_nullif",
    """SELECT channel, round(count(*)::DOUBLE / nullif(count(DISTINCT customer_id), 0), 6) AS txns_per_customer,
              round(count(*)::DOUBLE / nullif(count(*) FILTER (transaction_status = 'REVERSED'), 0), 6)
                AS txns_per_reversal
       FROM fact GROUP BY ALL""",
)
def agg_ratio_nullif(ws):
    reversed_ = F.count_if(F.col("transaction_status") == "REVERSED")
    per_customer = ws.current.fact.groupBy("channel", "customer_id").agg(rows("n"), reversed_.alias("r"))
    n = F.sum("n")
    return per_customer.groupBy("channel").agg(
        F.round(C.share(n, F.count("customer_id")), 6).alias("txns_per_customer"),
        F.round(C.share(n, F.sum("r")), 6).alias("txns_per_reversal"),
    )


@query(
    "agg_percentiles",
    """SELECT channel, quantile_disc(amount, 0.5)::DECIMAL(18,2) AS median_value,
              quantile_disc(amount, 0.95)::DECIMAL(18,2) AS p95_value FROM fact GROUP BY ALL""",
)
def agg_percentiles(ws):
    cuts = F.percentile_approx("amount", [0.5, 0.95], 100_000)
    grouped = ws.current.fact.groupBy("channel").agg(cuts.alias("cuts"))
    return grouped.select("channel", F.col("cuts")[0].alias("median_value"), F.col("cuts")[1].alias("p95_value"))


@query(
    "agg_max_date",
    "SELECT customer_id, max(transaction_date) AS last_txn_date FROM fact GROUP BY ALL",
)
def agg_max_date(ws):
    return ws.current.fact.groupBy("customer_id").agg(F.max("transaction_date").alias("last_txn_date"))


@query(
    "agg_having_negative",
    """SELECT customer_id, sum(signed_amount)::DECIMAL(28,2) AS net_flow FROM fact GROUP BY ALL
       HAVING sum(signed_amount) < 0""",
)
def agg_having_negative(ws):
    flows = ws.current.fact.groupBy("customer_id").agg(C.total("signed_amount").alias("net_flow"))
    return flows.filter(F.col("net_flow") < 0)


@query(
    "agg_band",
    """SELECT customer_id, if(sum(signed_amount) < 0, 'NET_OUTFLOW', 'NET_INFLOW') AS flow_band FROM fact
       GROUP BY ALL""",
)
def agg_band(ws):
    band = F.when(F.sum("signed_amount") < 0, "NET_OUTFLOW").otherwise("NET_INFLOW")
    return ws.current.fact.groupBy("customer_id").agg(band.alias("flow_band"))


@query(
    "agg_listagg_distinct",
    """SELECT customer_segment, string_agg(DISTINCT state, ',' ORDER BY state) AS states FROM dim_customer
       GROUP BY ALL""",
)
def agg_listagg_distinct(ws):
    pairs = ws.masters.dim_customer.select("customer_segment", "state").distinct()
    listed = F.expr("listagg(DISTINCT state, ',') WITHIN GROUP (ORDER BY state)")
    return pairs.groupBy("customer_segment").agg(listed.alias("states"))


@query(
    "agg_distinct_states",
    "SELECT month_start, count(DISTINCT state) AS states_visible FROM segment GROUP BY ALL",
)
def agg_distinct_states(ws):
    month = C.month_start("transaction_date").alias("month_start")
    per_customer = ws.current.fact.groupBy(month, "customer_id").agg(rows("n"))
    joined = per_customer.join(ws.current.dim_customer.select("customer_id", "state"), "customer_id", "left")
    return joined.groupBy("month_start").agg(F.count_distinct("state").alias("states_visible"))


@query(
    "agg_explode_count",
    "SELECT reason, count(*) AS row_count FROM (SELECT unnest(reasons) AS reason FROM flagged) GROUP BY reason",
)
def agg_explode_count(ws):
    single = ws.newest.quarantined().select(F.explode(F.split("dq_fail_reasons", ",")).alias("reason"))
    return single.groupBy("reason").agg(rows("row_count"))


@query(
    "agg_avg_outcome",
    """SELECT run_id, dataset, round(avg(if(outcome = 'Passed', 1.0::DOUBLE, 0.0::DOUBLE)), 4) AS dq_score
       FROM outcome_history GROUP BY ALL""",
)
def agg_avg_outcome(ws):
    passed = F.when(F.col("outcome") == rules.PASSED, F.lit(1.0)).otherwise(F.lit(0.0))
    return ws.lake.outcomes().groupBy("run_id", "dataset").agg(F.round(F.avg(passed), 4).alias("dq_score"))


@query(
    "agg_sum_reason_counts",
    "SELECT reason, sum(row_count)::BIGINT AS failing_rows FROM reason_history GROUP BY ALL",
)
def agg_sum_reason_counts(ws):
    return ws.lake.reasons().groupBy("reason").agg(F.sum("row_count").alias("failing_rows"))
