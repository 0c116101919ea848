"""Dataset rules, metrics, gate, summary, scorecard, reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger import fixture_defects as D
from brassledger import fixtures as X
from brassledger.catalogue.core import query
from brassledger.operators import quality, rules
from brassledger.plans import profiles

MAIN = "run_id = '20240201T000000Z'"


def _rule(name: str, kinds: tuple[str, ...], where: str) -> None:
    """One query per rule type, on the raw rows."""

    @query(
        f"rule_{name}",
        f"""SELECT rule, outcome, failure_reason, evaluated_metrics FROM outcome_history
            WHERE {MAIN} AND dataset = 'raw_transactions' AND {where}""",
    )
    def evaluate_kind(ws):
        chosen = tuple(r for r in rules.DEFAULT_RULES if r.kind in kinds)
        df = ws.from_files.std.select(*K.RULE_COLUMNS)
        s = ws.from_files.settings
        outcomes = rules.evaluate(df, K.RAW_DATASET, s.run_id, s.as_of, s.as_of, chosen)
        return outcomes.select("rule", "outcome", "failure_reason", "evaluated_metrics")


_rule("row_count", ("rows",), "rule LIKE 'RowCount%'")
_rule("is_complete", ("complete",), "rule LIKE 'IsComplete%'")
_rule("is_unique", ("unique",), "rule LIKE 'IsUnique%'")
_rule("column_gt", ("greater",), "rule LIKE 'ColumnValues%> 0'")
_rule("column_in", ("within",), "rule LIKE 'ColumnValues% in [%'")
_rule("completeness_threshold", ("completeness",), "rule LIKE 'Completeness%'")
_rule("custom_sql", ("sql",), "rule LIKE 'CustomSql%'")


@query("dq_evaluate_rules", f"SELECT * FROM outcome_history WHERE {MAIN}")
def dq_evaluate_rules(ws):
    run = ws.run
    published = ws.fact.select(*K.RULE_COLUMNS)
    s = run.settings
    curated = rules.evaluate(published, K.CURATED_DATASET, s.run_id, s.as_of, s.as_of)
    return run.raw_outcomes.unionByName(curated)


@query(
    "dq_score",
    """SELECT dataset, round(avg(if(outcome = 'Passed', 1.0::DOUBLE, 0.0::DOUBLE)), 4) AS score
       FROM outcome_history WHERE run_id = '20240201T000000Z' GROUP BY ALL""",
)
def dq_score(ws):
    outcomes = ws.lake.outcomes().filter(F.col("run_id") == "20240201T000000Z")
    parts = [
        rules.score(outcomes.filter(F.col("dataset") == d)).select(F.lit(d).alias("dataset"), "score")
        for d in (K.RAW_DATASET, K.CURATED_DATASET)
    ]
    return parts[0].unionAll(parts[1])


@query(
    "dq_quarantine_rate",
    f"SELECT raw_rows, curated_rows, bad_rows AS quarantined_rows, rate AS quarantine_rate FROM run_totals WHERE {MAIN}",
)
def dq_quarantine_rate(ws):
    return quality.row_totals(ws.run.flagged)


@query(
    "dq_quality_gate",
    """SELECT s.run_id, s.pipeline_status, count(o.rule) AS curated_rules,
              s.run_id = (SELECT max(run_id) FROM summary WHERE pipeline_status = 'PUBLISHED') AS is_current
       FROM summary s LEFT JOIN outcome_history o ON o.run_id = s.run_id AND o.dataset = 'curated_transactions'
       GROUP BY ALL""",
)
def dq_quality_gate(ws):
    """Three runs: the blocked one leaves history but no curated outcomes and never becomes current."""
    curated = ws.lake.outcomes().filter(F.col("dataset") == K.CURATED_DATASET)
    counted = curated.groupBy("run_id").agg(F.count("rule").alias("n"))
    joined = ws.lake.summary().join(counted, "run_id", "left")
    return joined.select(
        "run_id",
        "pipeline_status",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("curated_rules"),
        (F.col("run_id") == ws.lake.published_run()).alias("is_current"),
    )


@query("dq_run_summary", "SELECT * FROM summary")
def dq_run_summary(ws):
    return ws.lake.summary()


# ---------------------------------------------------------------- metrics


@query("metric_row_count", "SELECT count(*) AS row_count FROM fact")
def metric_row_count(ws):
    return ws.current.fact.agg(quality.row_count().alias("row_count"))


@query(
    "metric_duplicate_count",
    "SELECT count(transaction_id) - count(DISTINCT transaction_id) AS duplicates FROM std",
)
def metric_duplicate_count(ws):
    return quality.duplicate_count(ws.from_files.std, "transaction_id")


@query(
    "metric_null_count",
    """SELECT count(*) FILTER (source_account_id IS NULL) AS null_accounts,
              count(*) FILTER (channel IS NULL) AS null_channels FROM std""",
)
def metric_null_count(ws):
    return ws.from_files.std.agg(
        quality.null_count("source_account_id").alias("null_accounts"),
        quality.null_count("channel").alias("null_channels"),
    )


@query("metric_non_positive_amount", "SELECT count(*) FILTER (amount <= 0) AS non_positive_amounts FROM std")
def metric_non_positive_amount(ws):
    return ws.from_files.std.agg(quality.non_positive_count("amount").alias("non_positive_amounts"))


@query(
    "metric_future_timestamp",
    "SELECT count(*) FILTER (transaction_ts > TIMESTAMP '2024-02-01') AS future_timestamps FROM std",
)
def metric_future_timestamp(ws):
    return ws.from_files.std.agg(quality.future_count("transaction_ts", X.AS_OF).alias("future_timestamps"))


@query(
    "metric_invalid_channel",
    """SELECT count(*) FILTER (coalesce(channel, '') NOT IN ('MOBILE', 'ONLINE', 'ATM', 'BRANCH', 'POS'))
              AS invalid_channels FROM std""",
)
def metric_invalid_channel(ws):
    return ws.from_files.std.agg(quality.outside_domain_count("channel").alias("invalid_channels"))


@query(
    "metric_on_demand",
    """SELECT count(transaction_id) - count(DISTINCT transaction_id) AS dup_txn_ids,
              count(*) FILTER (amount <= 0) AS non_positive_amounts FROM fact""",
)
def metric_on_demand(ws):
    repeats = quality.duplicate_count(ws.current.fact, "transaction_id").scalar()
    counted = ws.current.fact.agg(quality.non_positive_count("amount").alias("non_positive_amounts"))
    return counted.select(repeats.alias("dup_txn_ids"), "non_positive_amounts")


@query(
    "metric_merged",
    """SELECT cast(transaction_ts AS date) AS transaction_date, transaction_type, count(*) AS row_count,
              count(*) FILTER (transaction_id IS NULL) AS null_ids,
              count(*) FILTER (source_account_id IS NULL) AS null_accounts,
              count(*) FILTER (channel IS NULL) AS null_channels,
              count(*) FILTER (amount <= 0) AS non_positive_amounts,
              count(*) FILTER (coalesce(channel, '') NOT IN ('MOBILE', 'ONLINE', 'ATM', 'BRANCH', 'POS'))
                  AS invalid_channels
       FROM std GROUP BY ALL""",
)
def metric_merged(ws):
    """All counting metrics of the raw zone from the states of its folders."""
    return profiles.metrics(ws.raw_profile(), *profiles.BY).drop("distinct_ids", "duplicates")


@query(
    "metric_state_total",
    """SELECT count(*) AS row_count, count(*) FILTER (amount <= 0) AS non_positive_amounts,
              sum(amount)::DECIMAL(38,2) AS amount_total FROM fact""",
)
def metric_state_total(ws):
    """The published fact's totals from the states written with it; the fact is not read."""
    return profiles.merged(ws.newest.profile()).select("row_count", "non_positive_amounts", "amount_total")


# ---------------------------------------------------------------- checks


@query(
    "check_referential_integrity",
    """SELECT 'fact.source_account_id -> dim_account' AS check_name,
              count(*) FILTER (a.account_id IS NULL) AS failing_rows, count(*) AS evaluated_rows
       FROM fact LEFT JOIN dim_account a ON source_account_id = a.account_id
       UNION ALL
       SELECT 'dim_account.customer_id -> dim_customer', count(*) FILTER (c.customer_id IS NULL), count(*)
       FROM dim_account a LEFT JOIN dim_customer c ON a.customer_id = c.customer_id""",
)
def check_referential_integrity(ws):
    return quality.referential_integrity(ws.current.fact, ws.current.dim_account, ws.current.dim_customer)


@query(
    "check_load_reconciliation",
    """SELECT run_id, raw_rows, curated_rows AS summary_curated_rows, (SELECT count(*) FROM fact) AS loaded_fact_rows,
              quarantined_rows AS summary_quarantined_rows,
              (SELECT count(*) FROM quarantine) AS loaded_quarantine_rows,
              raw_rows - (SELECT count(*) FROM fact) - (SELECT count(*) FROM quarantine) AS unexplained_diff
       FROM summary ORDER BY run_ts DESC LIMIT 1""",
)
def check_load_reconciliation(ws):
    return quality.load_reconciliation(ws.lake.summary(), ws.fact, ws.newest.quarantined())


@query("dq_scorecard", "SELECT * FROM scorecard")
def dq_scorecard(ws):
    return quality.scorecard(ws.lake.summary(), ws.lake.reasons())


MANIFEST = """
    SELECT CASE WHEN n % 2000 = 0 THEN 'NULL_TXN_ID' WHEN n % 2000 <= 4 THEN 'NULL_ACCOUNT'
                WHEN n % 2000 <= 8 THEN 'ORPHAN_ACCOUNT' WHEN n % 2000 <= 12 THEN 'NON_POSITIVE_AMOUNT'
                WHEN n % 2000 <= 15 THEN 'INVALID_TYPE' WHEN n % 2000 <= 18 THEN 'FUTURE_TIMESTAMP'
                WHEN n % 2000 = 19 THEN 'INVALID_TIMESTAMP' WHEN n % 2000 <= 24 THEN 'NULL_CHANNEL'
                ELSE 'DUPLICATE_TXN_ID' END AS defect, count(*) AS defect_rows
    FROM clean WHERE n % 2000 < 32 GROUP BY ALL"""


@query(
    "defect_reconciliation",
    f"""SELECT coalesce(h.reason, m.defect) AS reason, coalesce(h.n, 0)::BIGINT AS caught_rows,
               coalesce(m.defect_rows, 0)::BIGINT AS injected_rows,
               coalesce(h.n, 0) = coalesce(m.defect_rows, 0) AS matches
        FROM (SELECT reason, sum(row_count) AS n FROM reason_history WHERE {MAIN} GROUP BY ALL) h
        FULL JOIN ({MANIFEST}) m ON h.reason = m.defect""",
)
def defect_reconciliation(ws):
    caught = ws.lake.reasons().filter(F.col("run_id") == "20240201T000000Z")
    manifest = D.defect_manifest(X.clean_transactions(ws.spark, ws.sf_dir), X.NUMBER)
    return quality.defect_reconciliation(caught, manifest)
