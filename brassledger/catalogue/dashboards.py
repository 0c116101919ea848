"""Dashboard sheets."""

from __future__ import annotations

from brassledger.catalogue.core import query
from brassledger.operators import governance as G
from brassledger.operators import quality
from brassledger.plans import dashboards as D
from brassledger.plans import marts


def _daily(ws):
    return marts.daily_transactions(ws.current.fact)


@query(
    "dash_failed_rate",
    """SELECT transaction_date, round(sum(failed_txn_count)::DOUBLE / sum(txn_count), 6) AS failed_rate
       FROM daily GROUP BY ALL""",
)
def dash_failed_rate(ws):
    return D.failed_rate(_daily(ws))


@query(
    "dash_digital_share_daily",
    """SELECT transaction_date,
              round(coalesce(sum(txn_count) FILTER (digital_channel_flag), 0)::DOUBLE / sum(txn_count), 6)
                AS digital_share
       FROM daily GROUP BY ALL""",
)
def dash_digital_share_daily(ws):
    return D.digital_share_daily(_daily(ws))


@query(
    "dash_latest_month",
    "SELECT month_start, txn_count, month_start = max(month_start) OVER () AS is_latest_month FROM kpis",
)
def dash_latest_month(ws):
    return D.latest_month(marts.monthly_kpis(ws.current.fact))


@query(
    "dash_quarantine_pct",
    "SELECT run_id, round(quarantine_rate * 100, 4) AS quarantine_rate_pct FROM summary",
)
def dash_quarantine_pct(ws):
    return D.quarantine_pct(marts.run_history(ws.lake.summary()))


@query(
    "dash_kpi_cards",
    """SELECT month_start, txn_value, deposit_value, net_flow, active_customers, digital_share, failed_rate
       FROM kpis ORDER BY month_start DESC LIMIT 1""",
)
def dash_kpi_cards(ws):
    return D.kpi_cards(marts.monthly_kpis(ws.current.fact))


@query(
    "dash_value_by_type",
    """SELECT transaction_type, sum(txn_count)::BIGINT AS txn_count, sum(txn_value)::DECIMAL(28,2) AS txn_value
       FROM daily GROUP BY ALL""",
)
def dash_value_by_type(ws):
    return D.value_by_type(_daily(ws))


@query(
    "dash_channel_mix",
    """SELECT month_start, channel, count(*) AS txn_count,
              round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY month_start), 6) AS channel_share
       FROM fact GROUP BY month_start, channel""",
)
def dash_channel_mix(ws):
    return D.channel_mix(_daily(ws))


@query(
    "dash_state_value",
    """SELECT state, sum(txn_count)::BIGINT AS txn_count, sum(txn_value)::DECIMAL(28,2) AS txn_value
       FROM segment GROUP BY ALL""",
)
def dash_state_value(ws):
    return D.state_value(ws.current_secure(G.ANALYST).monthly_segment())


@query(
    "dash_segment_digital",
    """SELECT customer_segment, digital_enrolled_flag, sum(txn_count)::BIGINT AS txn_count,
              round(sum(digital_share * txn_count) / sum(txn_count), 4) AS digital_share
       FROM segment GROUP BY ALL""",
)
def dash_segment_digital(ws):
    return D.segment_digital(ws.current_secure(G.ANALYST).monthly_segment())


@query(
    "dash_netflow_histogram",
    """SELECT (floor(net_flow::DOUBLE / 100000) * 100000)::BIGINT AS bin_start, flow_band, count(*) AS customers
       FROM customer_value GROUP BY ALL""",
)
def dash_netflow_histogram(ws):
    return D.netflow_histogram(ws.current_secure(G.ANALYST).customer_value())


@query(
    "dash_top20_outflow",
    """SELECT 'H_' || sha256(customer_id)[:16] AS customer_id, state, customer_segment, net_flow
       FROM customer_value WHERE flow_band = 'NET_OUTFLOW'
       ORDER BY net_flow, 'H_' || sha256(customer_id)[:16] LIMIT 20""",
)
def dash_top20_outflow(ws):
    return D.top_outflow(ws.current_secure(G.ANALYST).customer_value())


@query(
    "dash_merchant_treemap",
    """SELECT merchant_category, sum(txn_count)::BIGINT AS txn_count, sum(txn_value)::DECIMAL(28,2) AS txn_value
       FROM merchant GROUP BY ALL""",
)
def dash_merchant_treemap(ws):
    return D.merchant_treemap(marts.merchant_monthly(ws.current.fact))


@query(
    "dash_dq_pass_by_dimension",
    """SELECT dq_dimension, sum(failing_rows)::BIGINT AS failing_rows,
              round(100 * (sum(evaluated_rows) - sum(failing_rows))::DOUBLE / sum(evaluated_rows), 4) AS pass_rate_pct
       FROM scorecard GROUP BY ALL""",
)
def dash_dq_pass_by_dimension(ws):
    return D.pass_by_dimension(quality.scorecard(ws.lake.summary(), ws.lake.reasons()))


@query(
    "dash_rows_by_reason",
    """SELECT reason, coalesce(sum(row_count) FILTER (ingest_source = 'BATCH'), 0)::BIGINT AS batch_rows,
              coalesce(sum(row_count) FILTER (ingest_source = 'STREAM'), 0)::BIGINT AS stream_rows
       FROM reason_history WHERE run_id = '20240201T000000Z' GROUP BY ALL""",
)
def dash_rows_by_reason(ws):
    return D.rows_by_reason(ws.lake.reasons())


@query(
    "dash_rule_table",
    """SELECT rule, max(outcome) FILTER (dataset = 'raw_transactions') AS raw_outcome,
              max(outcome) FILTER (dataset = 'curated_transactions') AS curated_outcome
       FROM newest_rules GROUP BY ALL""",
)
def dash_rule_table(ws):
    return D.rule_table(marts.rule_results(ws.lake.outcomes()))


@query(
    "dash_run_trend",
    """SELECT run_ts, pipeline_status, round(quarantine_rate * 100, 4) AS quarantine_pct, 5.0::DOUBLE AS reference_pct,
              quarantine_rate > 0.05 AS above_reference, raw_dq_score, curated_dq_score FROM summary""",
)
def dash_run_trend(ws):
    return D.run_trend(marts.run_history(ws.lake.summary()))
