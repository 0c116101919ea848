"""Dataset-level rules: structured specs compiled into one aggregate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger.operators.standardise import instant

PASSED, FAILED = "Passed", "Failed"


@dataclass(frozen=True)
class Rule:
    """kind: rows | complete | unique | greater | within | completeness | sql."""

    kind: str
    column: str = ""
    bound: float = 0
    domain: tuple[str, ...] = ()
    query: str = ""
    #: Of a query that only counts the rows where it holds, given the clock; then it joins the shared pass.
    condition: Callable[[Column], Column] | None = None

    @property
    def label(self) -> str:
        quoted = f'"{self.column}"'
        listed = ", ".join(f'"{v}"' for v in self.domain)
        return {
            "rows": f"RowCount > {self.bound:g}",
            "complete": f"IsComplete {quoted}",
            "unique": f"IsUnique {quoted}",
            "greater": f"ColumnValues {quoted} > {self.bound:g}",
            "within": f"ColumnValues {quoted} in [{listed}]",
            "completeness": f"Completeness {quoted} > {self.bound:g}",
            "sql": f'CustomSql "{self.query}" = {self.bound:g}',
        }[self.kind]


# --- fixed values: the default rule set, in reporting order
DEFAULT_RULES = (
    Rule("rows", bound=1000),
    Rule("complete", "transaction_id"),
    Rule("unique", "transaction_id"),
    Rule("complete", "source_account_id"),
    Rule("complete", "transaction_ts"),
    Rule("complete", "channel"),
    Rule("greater", "amount", bound=0),
    Rule("within", "transaction_type", domain=K.TRANSACTION_TYPES),
    Rule("within", "channel", domain=K.CHANNELS),
    Rule("within", "transaction_status", domain=K.TRANSACTION_STATUSES),
    Rule("completeness", "channel", bound=0.98),
    Rule(
        "sql",
        query="select count(*) from primary where transaction_ts > :as_of",
        condition=lambda as_of: F.col("transaction_ts") > as_of,
        bound=0,
    ),
)


def _violates(rule: Rule, null_fails: bool) -> Column:
    c = F.col(rule.column)
    breach = c <= rule.bound if rule.kind == "greater" else ~c.isin(*rule.domain)
    return F.coalesce(breach, F.lit(null_fails))


def _measure(rule: Rule, null_fails: bool, as_of: dt.datetime) -> Column | None:
    """The rule's share of the single pass; None where it needs its own."""
    if rule.kind == "rows":
        return F.count(F.lit(1))
    if rule.kind in ("complete", "completeness"):
        return F.count_if(F.col(rule.column).isNull())
    if rule.kind in ("greater", "within"):
        return F.count_if(_violates(rule, null_fails))
    if rule.kind == "sql" and rule.condition:
        return F.count_if(rule.condition(instant(as_of)))
    return None


def _own_pass(df: DataFrame, rule: Rule, as_of: dt.datetime) -> Column:
    """A scalar subquery for the rules a plain aggregate cannot express."""
    if rule.kind == "unique":
        # Values held by more than one row; NULL is the completeness rule's business.
        sizes = df.filter(F.col(rule.column).isNotNull()).groupBy(rule.column).agg(F.count(F.lit(1)).alias("n"))
        return sizes.agg(F.count_if(F.col("n") > 1)).scalar()
    # `primary` names the evaluated frame; the clock is bound as a text literal, which
    # compares with a timestamp column as a timestamp.
    bound = rule.query.replace("from primary", "from {primary}")
    return df.sparkSession.sql(bound, args={"as_of": as_of.isoformat(sep=" ")}, primary=df).scalar()


def _verdict(rule: Rule, m: Column, rows: Column) -> tuple[Column, Column, Column]:
    """(passes, failure text, metrics as JSON) from the measured number."""
    name, n = rule.column, m.cast("string")
    if rule.kind == "rows":
        return m > rule.bound, F.concat(n, F.lit(" rows")), F.to_json(F.struct(m.alias("rows")))
    if rule.kind == "complete":
        return m == 0, F.concat(n, F.lit(f" rows without {name}")), F.to_json(F.struct(m.alias("nulls")))
    if rule.kind == "unique":
        return m == 0, F.concat(n, F.lit(f" repeated values of {name}")), F.to_json(F.struct(m.alias("repeated")))
    if rule.kind == "completeness":
        filled = F.round(1 - m / F.nullif(rows, F.lit(0)), 6)
        shown = filled.cast("decimal(9,6)")
        text = F.concat(F.lit(f"completeness of {name} is "), shown.cast("string"))
        return filled > rule.bound, text, F.to_json(F.struct(shown.alias("completeness")))
    if rule.kind == "sql":
        return m == rule.bound, F.concat(F.lit("query returned "), n), F.to_json(F.struct(m.alias("result")))
    return m == 0, F.concat(n, F.lit(f" rows break the rule on {name}")), F.to_json(F.struct(m.alias("violations")))


def evaluate(
    df: DataFrame,
    dataset: str,
    run_id: str,
    run_ts: dt.datetime,
    as_of: dt.datetime,
    rules: tuple[Rule, ...] = DEFAULT_RULES,
    null_fails: bool = False,
) -> DataFrame:
    """One outcome row per rule.

    All counting rules share one pass over `df`, SQL rules with a plain
    condition as well; each uniqueness rule adds a grouped pass over its column,
    each other SQL rule its query.  Decisions of this
    library: NULL does not break a ColumnValues rule unless `null_fails`, and
    IsUnique looks at non-NULL values.
    """
    shared = {f"m{i}": _measure(r, null_fails, as_of) for i, r in enumerate(rules)}
    counted = [c.alias(name) for name, c in shared.items() if c is not None]
    if counted:
        profile = df.agg(F.count(F.lit(1)).alias("rows"), *counted)
    else:  # only rules with a pass of their own
        profile = df.sparkSession.range(1).select(F.lit(0).cast("long").alias("rows"))
    extra = {f"m{i}": _own_pass(df, r, as_of) for i, r in enumerate(rules) if shared[f"m{i}"] is None}
    profile = profile.withColumns(extra)

    outcomes = []
    for i, rule in enumerate(rules):
        passes, reason, metrics = _verdict(rule, F.col(f"m{i}"), F.col("rows"))
        ok = F.coalesce(passes, F.lit(False))
        outcomes.append(
            F.struct(
                F.lit(rule.label).alias("rule"),
                F.when(ok, PASSED).otherwise(FAILED).alias("outcome"),
                F.when(~ok, reason).alias("failure_reason"),
                metrics.alias("evaluated_metrics"),
            )
        )
    return profile.select(F.inline(F.array(*outcomes))).select(
        F.lit(run_id).alias("run_id"),
        instant(run_ts).alias("run_ts"),
        F.lit(dataset).alias("dataset"),
        "rule",
        "outcome",
        "failure_reason",
        "evaluated_metrics",
    )


def score(outcomes: DataFrame, name: str = "score") -> DataFrame:
    """One row: share of rules passed, four decimals; no rules score 0."""
    passed = F.when(F.col("outcome") == PASSED, F.lit(1.0)).otherwise(F.lit(0.0))
    return outcomes.agg(F.round(F.coalesce(F.avg(passed), F.lit(0.0)), 4).alias(name))
