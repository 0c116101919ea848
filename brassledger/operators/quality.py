"""Column metrics, integrity checks, gate, run summary, scorecard, reconciliation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger.functions import columns as C
from brassledger.functions.relations import over
from brassledger.operators.standardise import instant


class QualityGateBlocked(RuntimeError):
    """Raised after the history is written, when a run must not be published."""


# ---------------------------------------------------------------- metrics
def row_count() -> Column:
    return F.count(F.lit(1))


def null_count(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def non_positive_count(column: str) -> Column:
    return F.count_if(F.col(column) <= 0)


def future_count(column: str, as_of: dt.datetime) -> Column:
    return F.count_if(F.col(column) > instant(as_of))


def outside_domain_count(column: str, domain=K.CHANNELS) -> Column:
    """NULL counts as outside."""
    return F.count_if(~F.coalesce(F.col(column).isin(*domain), F.lit(False)))


def duplicate_count(df: DataFrame, column: str, name: str = "duplicates") -> DataFrame:
    """Rows beyond the first of each non-NULL value, as one row."""
    sizes = df.filter(F.col(column).isNotNull()).groupBy(column).agg(row_count().alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias(name))


# ---------------------------------------------------------------- integrity
def unmatched(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, label: str) -> DataFrame:
    """One row: child rows whose key has no parent, and all child rows.

    The child is counted per key first, so a hot key (or a third of all keys
    missing) reaches the join as one row.
    """
    per_key = child.groupBy(F.col(child_key).alias("_k")).agg(row_count().alias("n"))
    known = parent.select(F.col(parent_key).alias("_p")).distinct()
    joined = per_key.join(known, F.col("_k") == F.col("_p"), "left")
    missing = F.sum(F.when(F.col("_p").isNull(), F.col("n")).otherwise(F.lit(0)))
    return joined.agg(
        F.lit(label).alias("check_name"),
        F.coalesce(missing, F.lit(0)).cast("bigint").alias("failing_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("evaluated_rows"),
    )


def referential_integrity(fact: DataFrame, dim_account: DataFrame, dim_customer: DataFrame) -> DataFrame:
    account = unmatched(
        fact, "source_account_id", dim_account, "account_id", "fact.source_account_id -> dim_account"
    )
    customer = unmatched(
        dim_account, "customer_id", dim_customer, "customer_id", "dim_account.customer_id -> dim_customer"
    )
    return account.unionAll(customer)


# ---------------------------------------------------------------- gate and summary
def quarantine_rate(quarantined: Column, raw: Column) -> Column:
    """Six decimals; no raw rows rate 0, so an empty run publishes."""
    return F.coalesce(F.round(C.share(quarantined, raw), 6), F.lit(0.0))


def with_rate(counted: DataFrame) -> DataFrame:
    """(raw_rows, quarantined_rows) -> also curated rows and the rate."""
    raw_rows, bad_rows = F.col("raw_rows"), F.col("quarantined_rows")
    return counted.select(
        "raw_rows",
        (raw_rows - bad_rows).alias("curated_rows"),
        "quarantined_rows",
        quarantine_rate(bad_rows, raw_rows).alias("quarantine_rate"),
    )


def row_totals(flagged: DataFrame) -> DataFrame:
    """One row from one pass: raw, curated and quarantined rows, and the rate."""
    bad = F.size("dq_fail_reasons") > 0
    return with_rate(flagged.agg(row_count().alias("raw_rows"), F.count_if(bad).alias("quarantined_rows")))


def gate(rate: Column, limit: Column) -> Column:
    return F.when(rate <= limit, K.PUBLISHED).otherwise(K.BLOCKED)


def run_summary(
    totals: DataFrame,
    raw_score: DataFrame,
    curated_score: DataFrame | None,
    accounts_rejected: DataFrame,
    run_id: str,
    run_ts: dt.datetime,
    max_rate: float,
) -> DataFrame:
    """The 11-column summary as a frame.  Inputs: one-row frames (and the rejected accounts), read as scalar subqueries.

    Only the rate decides; the scores inform.  A blocked run has no curated score.
    """
    rejected = accounts_rejected.agg(row_count()).scalar()
    curated = F.lit(None).cast("double") if curated_score is None else curated_score.scalar()
    status = gate(F.col("quarantine_rate"), F.lit(max_rate))
    return totals.select(
        F.lit(run_id).alias("run_id"),
        instant(run_ts).alias("run_ts"),
        "raw_rows",
        "curated_rows",
        "quarantined_rows",
        "quarantine_rate",
        F.lit(float(max_rate)).alias("max_quarantine_rate"),
        raw_score.scalar().alias("raw_dq_score"),
        F.when(status == K.PUBLISHED, curated).alias("curated_dq_score"),
        rejected.alias("accounts_quarantined"),
        status.alias("pipeline_status"),
    )


def status_line(summary: DataFrame) -> DataFrame:
    """The notification text of the newest run."""
    newest = latest_run(summary)
    parts = ("pipeline_status", "raw_rows", "quarantine_rate", "raw_dq_score", "curated_dq_score")
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in parts]
    # --- fixed value: the message text
    template = "Status: %s | raw rows: %s | quarantine rate: %s | raw DQ score: %s | curated DQ score: %s"
    return newest.select(F.format_string(template, *shown).alias("message"))


# ---------------------------------------------------------------- scorecard
def reason_table(spark: SparkSession) -> DataFrame:
    """The 12 reason codes with dimension and business rule (a fixed table)."""
    rows = [(reason, *meaning) for reason, meaning in K.REASONS.items()]
    return C.fixed_rows(spark, ("reason", "dq_dimension", "business_rule"), rows)


def latest_run(summary: DataFrame) -> DataFrame:
    """Newest run; a bounded top-1, not a global sort."""
    return summary.orderBy(F.col("run_ts").desc(), F.col("run_id").desc()).limit(1)


def newest_by_rank(df: DataFrame, keys: list[str]) -> DataFrame:
    """Newest row per key through a ranking window (history tables only)."""
    w = Window.partitionBy(*keys).orderBy(F.col("run_ts").desc(), F.col("run_id").desc())
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def _reason_values() -> str:
    codes = {**K.REASONS, **K.LINE_REASONS}
    rows = ", ".join(f"('{code}', '{dim}', '{rule}', {code in K.REASONS})" for code, (dim, rule) in codes.items())
    return f"SELECT * FROM VALUES {rows} AS t(rule_code, dq_dimension, business_rule, always)"


#: Pass rate per reason code for the newest run, over named relations; codes without rows pass at 100.  The reason of
#: malformed lines has a row when it occurs.
SCORECARD = f"""
    WITH newest AS (SELECT max(struct(run_ts, run_id, raw_rows)) AS run FROM {{run_summary}}),
    failing AS (SELECT reason, CAST(sum(row_count) AS bigint) AS failing FROM {{quarantine_reasons}}
                WHERE run_id = (SELECT run.run_id FROM newest) GROUP BY reason),
    codes AS (SELECT *, (SELECT run FROM newest) AS run FROM ({_reason_values()}))
    SELECT dq_dimension, rule_code, business_rule, coalesce(failing, 0L) AS failing_rows, run.raw_rows AS evaluated_rows,
           round(100D * CAST(run.raw_rows - coalesce(failing, 0L) AS double) / nullif(CAST(run.raw_rows AS double), 0D), 4)
               AS pass_rate_pct, run.run_id AS run_id
    FROM codes LEFT JOIN failing ON reason = rule_code WHERE run IS NOT NULL AND (always OR failing > 0)"""


def scorecard(summary: DataFrame, reasons: DataFrame) -> DataFrame:
    return over(SCORECARD, run_summary=summary, quarantine_reasons=reasons)


def load_reconciliation(summary: DataFrame, fact: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Newest summary against the rows actually loaded; 0 means nothing is lost."""
    loaded, held = fact.agg(row_count()).scalar(), quarantine.agg(row_count()).scalar()
    return latest_run(summary).select(
        "run_id",
        "raw_rows",
        F.col("curated_rows").alias("summary_curated_rows"),
        loaded.alias("loaded_fact_rows"),
        F.col("quarantined_rows").alias("summary_quarantined_rows"),
        held.alias("loaded_quarantine_rows"),
        (F.col("raw_rows") - loaded - held).alias("unexplained_diff"),
    )


def line_reconciliation(delivered: DataFrame, malformed: DataFrame, quarantine: DataFrame, fact: DataFrame) -> DataFrame:
    """Delivered lines per path against what became of them; 0 means that none is lost.

    All four have `ingest_source`.  Malformed lines are also quarantined, under a reason of their own; the other rows
    of the quarantine are counted beside them.
    """
    parts = {
        "delivered_lines": delivered,
        "malformed_lines": malformed,
        "other_quarantined_rows": quarantine.filter(~F.col("dq_fail_reasons").isin(*K.LINE_REASONS)),
        "fact_rows": fact,
    }
    counted = None
    for name, rows in parts.items():
        part = rows.groupBy("ingest_source").agg(row_count().alias("n")).withColumn("part", F.lit(name))
        counted = part if counted is None else counted.unionByName(part)
    totals = counted.groupBy("ingest_source").agg(
        *[F.coalesce(F.sum(F.when(F.col("part") == name, F.col("n"))), F.lit(0)).cast("bigint").alias(name) for name in parts]
    )
    delivered_lines, *others = [F.col(name) for name in parts]
    return totals.withColumn("unexplained_diff", delivered_lines - sum(others[1:], others[0]))


def defect_reconciliation(reasons: DataFrame, manifest: DataFrame) -> DataFrame:
    """Caught against injected rows per reason, from either side."""
    caught = reasons.groupBy("reason").agg(F.sum("row_count").alias("caught_rows"))
    expected = manifest.select(F.col("defect").alias("reason"), F.col("defect_rows").alias("injected_rows"))
    joined = caught.join(expected, "reason", "full_outer")
    caught_rows = F.coalesce("caught_rows", F.lit(0)).cast("bigint")
    injected_rows = F.coalesce("injected_rows", F.lit(0)).cast("bigint")
    return joined.select(
        "reason",
        caught_rows.alias("caught_rows"),
        injected_rows.alias("injected_rows"),
        (caught_rows == injected_rows).alias("matches"),
    )
