"""Full refresh of a warehouse from the lake, all tables at once, with an audit of what was loaded."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from brassledger import contracts as K
from brassledger.operators import quality
from brassledger.plans import marts
from brassledger.plans.run import Lake
from brassledger.sources.loads import Load, Loads

AUDITED = (
    "curated.fact_transactions",
    "curated.dim_customer",
    "curated.dim_account",
    "dq.quarantine_transactions",
)
TABLES = {
    "curated.fact_transactions": K.FACT_DDL,
    "curated.dim_customer": K.CUSTOMER_DDL,
    "curated.dim_account": K.ACCOUNT_DDL,
    "curated.dim_branch": K.BRANCH_DDL,
    "dq.quarantine_transactions": K.QUARANTINE_DDL,
    "dq.rule_outcomes": K.OUTCOME_DDL,
    "dq.run_summary": K.SUMMARY_DDL,
    "dq.quarantine_reasons": K.REASON_COUNT_DDL,
}


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.loads = Loads(spark, root)

    def audit(self) -> DataFrame:
        return self.loads.audit()

    def refresh(self, lake: Lake, loaded_at: dt.datetime) -> dict[str, DataFrame]:
        """Load all eight tables from one snapshot of the lake, by column name; readers see them when all are there.

        A refresh that fails changes nothing, one that is repeated adds a load of the same rows.
        """
        now = lake.snapshot()  # one run for all tables
        frames = {
            "curated.fact_transactions": now.fact(),
            "curated.dim_customer": now.dimension("dim_customer"),
            "curated.dim_account": now.dimension("dim_account"),
            "curated.dim_branch": now.dimension("dim_branch"),
            "dq.quarantine_transactions": now.quarantined(),
            "dq.rule_outcomes": now.outcomes(),
            "dq.run_summary": now.summary(),
            "dq.quarantine_reasons": now.reasons(),
        }
        sources = {name: (frame, TABLES[name]) for name, frame in frames.items()}
        load = self.loads.load(sources, loaded_at, AUDITED, now.run_id)
        return {name: load.table(name, ddl) for name, ddl in TABLES.items()}

    def current(self) -> Load:
        """The newest load; tables taken from it belong together."""
        return self.loads.current()

    def table(self, name: str) -> DataFrame:
        return self.current().table(name, TABLES[name])

    def marts_as(self, role: str) -> dict[str, DataFrame]:
        """The ten marts the role may export, all of one load."""
        load = self.current()
        t = {name: load.table(name, ddl) for name, ddl in TABLES.items()}
        seen = marts.SecureMarts(t["curated.fact_transactions"], t["curated.dim_customer"], role)
        summary, reasons = t["dq.run_summary"], t["dq.quarantine_reasons"]
        card = quality.scorecard(summary, reasons)
        return marts.all_secure(seen, t["curated.dim_branch"], card, t["dq.rule_outcomes"], summary, reasons)
