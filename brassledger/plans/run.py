"""One run from raw rows to star schema and quality history, as lazy frames, and its publication."""

from __future__ import annotations

import datetime as dt
import functools
import operator
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger.functions import columns as C
from brassledger.operators import enrich, governance, quality, rules, standardise, validate
from brassledger.plans import profiles
from brassledger.session import discard, exists, staged
from brassledger.sources import files


@dataclass(frozen=True)
class RawZone:
    """Raw frames: contract columns plus `source_file` on the transactions, and `malformed_line` if they come from files."""

    transactions: DataFrame
    accounts: DataFrame
    customers: DataFrame
    branches: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, root: str) -> RawZone:
        return cls.of(files.read_raw(spark, f"{root}/transactions", K.RAW_TRANSACTION, keep_malformed=True), root)

    @classmethod
    def of(cls, transactions: DataFrame, root: str) -> RawZone:
        """These transactions with the masters below `root`."""
        spark = transactions.sparkSession
        return cls(
            transactions,
            files.read_raw(spark, f"{root}/accounts", K.RAW_ACCOUNT),
            files.read_raw(spark, f"{root}/customers", K.RAW_CUSTOMER),
            files.read_raw(spark, f"{root}/branches", K.RAW_BRANCH),
        )


@dataclass(frozen=True)
class Settings:
    """Everything that would otherwise be a clock or a constant."""

    as_of: dt.datetime
    max_quarantine_rate: float = 0.05
    rules: tuple[rules.Rule, ...] = rules.DEFAULT_RULES

    @property
    def run_id(self) -> str:
        return self.as_of.strftime("%Y%m%dT%H%M%SZ")


class Run:
    """The frames of one run.  Nothing executes until a frame is used.

    `stage_in` gives the same run over tables written once: the raw rows are
    read a single time, however many branches use the checked or flagged rows.
    Runs over the same raw files can share what does not depend on their
    settings: `prepare_in` writes it, `under` takes it up.
    """

    def __init__(self, raw: RawZone, settings: Settings):
        self.raw = raw
        self.settings = settings
        self.timeless: DataFrame | None = None  # prepared rows, checked but for the clock

    def prepare_in(self, folder: str) -> Run:
        """Write what does not depend on the settings below `folder`: masters, and rows checked but for the clock.

        Nothing is cached, so a lost executor only repeats its own tasks, and
        the planner gets true sizes: a small account master is broadcast, a
        large one is not.
        """
        run = Run(self.raw, self.settings)
        run.checked_accounts = staged(run.checked_accounts, "accounts", folder)
        run.typed_customers = staged(run.typed_customers, "customers", folder)
        run.account_master = staged(run.account_master, "account_master", folder)
        timeless = validate.check_rows(run.std, run.account_master, None)
        run.timeless = staged(timeless.drop(validate.LANE), "checked", folder, compression="zstd")
        return run.under(self.settings)

    def under(self, settings: Settings, wanted: Column | None = None) -> Run:
        """A run under other settings over this one's prepared rows, or over those of them that are `wanted`."""
        run = Run(self.raw, settings)
        run.checked_accounts, run.typed_customers = self.checked_accounts, self.typed_customers
        run.account_master = self.account_master
        run.timeless = self.timeless if wanted is None else self.timeless.filter(wanted)
        laned = run.timeless.withColumn(validate.LANE, F.monotonically_increasing_id())
        run.checked = validate.check_clock(laned, settings.as_of)
        return run

    def stage_in(self, folder: str) -> Run:
        """Write what several outputs need below `folder`: prepared rows, repeated ids and their ranked rows.

        Most rows are written once, when they are prepared.  Flagged rows are those of ids that occur once, as they
        are, and the ranked rows of the few other ids.
        """
        run = (self.prepare_in(folder) if self.timeless is None else self).under(self.settings)
        run.repeated = staged(run.repeated, "repeated_ids", folder)
        run._settle(folder, run.checked)
        run.rule_rows = run.checked
        return run

    def settle_in(self, folder: str) -> Run:
        """Write below `folder` only what rows cannot do without: the account master, repeated ids, their ranked rows.

        For a few outputs over raw rows that are cheap to read again, such as a table; all other rows go from there to
        the output without being written.
        """
        run = Run(self.raw, self.settings)
        run.account_master = staged(run.account_master, "account_master", folder)
        run.repeated = staged(run.repeated, "repeated_ids", folder)
        # Rows of other ids are left out before they are typed and looked up.
        again = F.col("_rid") == C.code("transaction_id")
        few = standardise.transactions(self.raw.transactions.join(run.repeated, again, "left_semi"))
        run._settle(folder, validate.check_rows(few, run.account_master, self.settings.as_of))
        return run

    def _settle(self, folder: str, rivals: DataFrame) -> None:
        """Write the rows of repeated ids, found among `rivals`, as they rank."""
        ranked = staged(validate.ranked_repeats(rivals, self.repeated), "ranked", folder, compression="zstd")
        self.flagged = validate.settled_rows(self.checked, self.repeated).unionByName(ranked)
        self.totals = quality.with_rate(validate.count_quarantined(self.checked, self.repeated))

    # ------------------------------------------------------------ dimensions
    @cached_property
    def checked_accounts(self) -> DataFrame:
        return standardise.accounts(self.raw.accounts)

    @cached_property
    def account_master(self) -> DataFrame:
        return standardise.account_master(self.checked_accounts)

    @cached_property
    def dim_account(self) -> DataFrame:
        return standardise.valid_accounts(self.checked_accounts)

    @cached_property
    def account_quarantine(self) -> DataFrame:
        s = self.settings
        return standardise.rejected_accounts(self.checked_accounts, s.run_id, s.as_of)

    @cached_property
    def typed_customers(self) -> DataFrame:
        return standardise.typed_customers(self.raw.customers)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return standardise.customers(self.typed_customers, self.settings.as_of)

    @cached_property
    def dim_branch(self) -> DataFrame:
        return standardise.branches(self.raw.branches)

    # ------------------------------------------------------------ transactions
    @cached_property
    def std(self) -> DataFrame:
        return standardise.transactions(self.raw.transactions)

    @cached_property
    def checked(self) -> DataFrame:
        return validate.check_rows(self.std, self.account_master, self.settings.as_of)

    @cached_property
    def repeated(self) -> DataFrame:
        return validate.repeated_ids(self.checked)

    @cached_property
    def flagged(self) -> DataFrame:
        return validate.mark_repeats(self.checked, self.repeated)

    @cached_property
    def valid(self) -> DataFrame:
        return validate.valid_rows(self.flagged)

    @cached_property
    def quarantine(self) -> DataFrame:
        return validate.quarantined_rows(self.flagged, self.settings.run_id, self.settings.as_of)

    @cached_property
    def malformed_lines(self) -> DataFrame:
        """From the rows before repeats are sought: a malformed line has no values, so no id.

        All values are asked for, since Spark tells whether a line fits only where it reads all columns of its file.
        """
        values = [F.col(c).isNull() for c in K.layout_columns(K.QUARANTINE_DDL)[: len(K.RAW_TRANSACTION)]]
        empty = self.rule_rows.filter(functools.reduce(operator.and_, values))
        return validate.malformed_lines(empty, self.settings.run_id, self.settings.as_of)

    @cached_property
    def fact(self) -> DataFrame:
        return enrich.fact_rows(self.valid, self.settings.run_id)

    # ------------------------------------------------------------ quality history
    @cached_property
    def reasons(self) -> DataFrame:
        return validate.reason_counts(self.quarantine, self.settings.run_id, self.settings.as_of)

    def _evaluate(self, df: DataFrame, dataset: str) -> DataFrame:
        s = self.settings
        return rules.evaluate(df.select(*K.RULE_COLUMNS), dataset, s.run_id, s.as_of, s.as_of, s.rules)

    @cached_property
    def rule_rows(self) -> DataFrame:
        """Rows the raw rules look at; checked rows hold all their columns."""
        return self.std

    @cached_property
    def raw_outcomes(self) -> DataFrame:
        return self._evaluate(self.rule_rows, K.RAW_DATASET)

    @cached_property
    def curated_outcomes(self) -> DataFrame:
        return self._evaluate(self.fact, K.CURATED_DATASET)

    @cached_property
    def totals(self) -> DataFrame:
        return quality.row_totals(self.flagged)

    def check_gate(self) -> None:
        """Count the rows, and raise `QualityGateBlocked` where publishing this run would."""
        totals = self.totals
        row = totals.first()  # one row
        self.totals = totals.sparkSession.createDataFrame([row], totals.schema)
        rate, limit = row["quarantine_rate"], self.settings.max_quarantine_rate
        if rate > limit:
            raise quality.QualityGateBlocked(f"run {self.settings.run_id}: quarantine rate {rate:.4%} exceeds {limit:.2%}")

    @cached_property
    def outcomes(self) -> DataFrame:
        """Raw outcomes always; curated ones only where the gate lets the run pass."""
        rate = self.totals.select("quarantine_rate").scalar()
        curated = self.curated_outcomes.filter(rate <= F.lit(self.settings.max_quarantine_rate))
        return self.raw_outcomes.unionByName(curated)

    @cached_property
    def summary(self) -> DataFrame:
        s = self.settings
        return quality.run_summary(
            self.totals,
            rules.score(self.raw_outcomes),
            rules.score(self.curated_outcomes),
            self.account_quarantine,
            s.run_id,
            s.as_of,
            s.max_quarantine_rate,
        )


DIMENSIONS = {"dim_account": K.ACCOUNT_DDL, "dim_customer": K.CUSTOMER_DDL, "dim_branch": K.BRANCH_DDL}


# ---------------------------------------------------------------- publication
class NothingPublished(LookupError):
    """A lake was read before a run was published in it."""


class Lake:
    """Folder layout of a lake, and what its runs have committed.

    Everything a run writes lies below a folder of its own (``run=<id>``), and
    its summary row is written last.  Readers look at the summary first: they
    follow the newest PUBLISHED run, and take history of runs with a summary
    only, so a run that broke off is not seen at all.  A run that is repeated
    withdraws its summary, overwrites its folders, and commits again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ------------------------------------------------------------ folders
    def curated(self, run_id: str, table: str) -> str:
        return f"{self.root}/curated/run={run_id}/{table}"

    def quarantine(self, run_id: str, table: str) -> str:
        return f"{self.root}/quarantine/run={run_id}/{table}"

    def history(self, table: str, run_id: str | None = None) -> str:
        return f"{self.root}/dq-results/{table}" + (f"/run={run_id}" if run_id else "")

    def stage(self, run_id: str) -> str:
        """A fresh folder for the tables of one attempt; shared like the lake itself, and deleted at its end."""
        return f"{self.root}/stage/{run_id}-{uuid.uuid4().hex}"

    # ------------------------------------------------------------ what is committed
    def summary(self) -> DataFrame:
        if not exists(self.spark, self.history("run_summary")):
            raise NothingPublished(f"no run has been committed in {self.root}")
        return files.read_table(self.spark, self.history("run_summary"), K.SUMMARY_DDL)

    def _committed(self, table: str, ddl: str) -> DataFrame:
        rows = files.read_table(self.spark, self.history(table), ddl)
        return rows.join(self.summary().select("run_id"), "run_id", "left_semi").select(*rows.columns)

    def outcomes(self) -> DataFrame:
        return self._committed("rule_outcomes", K.OUTCOME_DDL)

    def reasons(self) -> DataFrame:
        return self._committed("quarantine_reasons", K.REASON_COUNT_DDL)

    def snapshot(self) -> Snapshot:
        run = F.struct("run_ts", "run_id")
        newest = F.max(run).alias("newest")
        published = F.max(F.when(F.col("pipeline_status") == K.PUBLISHED, run)).alias("published")
        row = self.summary().agg(newest, published).first()  # one row
        if row["published"] is None:
            raise NothingPublished(f"no run has been published in {self.root}")
        return Snapshot(self, row["published"]["run_id"], row["newest"]["run_id"], row["newest"]["run_ts"])

    def published_run(self) -> str:
        return self.snapshot().run_id

    def quarantined(self) -> DataFrame:
        return self.snapshot().quarantined()

    def fact(self) -> DataFrame:
        return self.snapshot().fact()

    def dimension(self, table: str) -> DataFrame:
        return self.snapshot().dimension(table)


@dataclass(frozen=True)
class Snapshot:
    """The lake at one moment.  Runs were looked up once; all tables taken from here belong together.

    Curated tables are those of the newest published run.  Quarantine and
    history go up to the newest run, which may have been blocked.
    """

    lake: Lake
    run_id: str
    newest_run: str
    newest_ts: dt.datetime

    def fact(self) -> DataFrame:
        """The published fact with its year/month folders, so date filters can prune."""
        return files.read_fact(self.lake.spark, self.lake.curated(self.run_id, "fact_transactions"))

    def profile(self) -> DataFrame:
        """Counts and sketches of the published fact by day and type (see `profiles`), written with it."""
        return files.read_table(self.lake.spark, self.lake.curated(self.run_id, "fact_profile"), profiles.STATE_DDL)

    def dimension(self, table: str) -> DataFrame:
        return files.read_table(self.lake.spark, self.lake.curated(self.run_id, table), DIMENSIONS[table])

    def quarantined(self) -> DataFrame:
        path = self.lake.quarantine(self.newest_run, "transactions")
        return files.read_table(self.lake.spark, path, K.QUARANTINE_DDL)

    def malformed_lines(self) -> DataFrame:
        """Lines of the newest run whose fields do not fit the contract; each is one quarantined row."""
        path = self.lake.quarantine(self.newest_run, "malformed_lines")
        return files.read_table(self.lake.spark, path, K.MALFORMED_DDL)

    def _until_now(self, rows: DataFrame) -> DataFrame:
        return rows.filter(F.col("run_ts") <= standardise.instant(self.newest_ts))

    def summary(self) -> DataFrame:
        return self._until_now(self.lake.summary())

    def outcomes(self) -> DataFrame:
        return self._until_now(self.lake.outcomes())

    def reasons(self) -> DataFrame:
        return self._until_now(self.lake.reasons())


def documented(df: DataFrame, table: str) -> DataFrame:
    """Column comments and classification tags as schema metadata."""
    return governance.tag_columns(governance.describe_columns(df, K.COMMENTS[table]), table)


def together(*actions) -> None:
    """Run independent writes at the same time, so that small ones fill idle cores."""
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        for job in [pool.submit(action) for action in actions]:
            job.result()


def publish(raw: RawZone, settings: Settings, lake: Lake) -> dict:
    """Run the pipeline into the lake; raises `QualityGateBlocked` after writing the history.

    The raw files are read once.  Outputs that do not depend on each other are
    written at the same time, each into its own folder; the rule outcomes of raw
    and curated rows share a folder and are one write.  Repeating a run with the
    same settings gives the same lake.
    """
    return publish_run(Run(raw, settings), lake)


def publish_run(run: Run, lake: Lake) -> dict:
    """`publish` for a run; prepared rows are used as they stand and stay, so several runs can share them."""
    settings = run.settings
    spark, run_id, limit = lake.spark, settings.run_id, settings.max_quarantine_rate
    discard(spark, lake.history("run_summary", run_id))  # from here until the commit, readers see the run before
    stage = lake.stage(run_id)
    try:
        row = _write_run(run.stage_in(stage), lake)
    finally:
        discard(spark, stage)
    if row["pipeline_status"] != K.PUBLISHED:
        raise quality.QualityGateBlocked(
            f"run {run_id}: quarantine rate {row['quarantine_rate']:.4%} exceeds {limit:.2%}; "
            "curated tables keep their previous run"
        )
    return row


def _write_run(run: Run, lake: Lake) -> dict:
    spark, run_id, limit = lake.spark, run.settings.run_id, run.settings.max_quarantine_rate
    counted = run.totals
    totals = counted.first()  # one row
    run.totals = spark.createDataFrame([totals], counted.schema)
    passed = totals["quarantine_rate"] <= limit

    def write_quarantine() -> None:
        path = lake.quarantine(run_id, "transactions")
        files.write_table(run.quarantine, path)
        run.quarantine = files.read_table(spark, path, K.QUARANTINE_DDL)
        files.write_table(run.reasons, lake.history("quarantine_reasons", run_id))

    def write_malformed_lines() -> None:
        files.write_table(run.malformed_lines, lake.quarantine(run_id, "malformed_lines"))

    def write_account_quarantine() -> None:
        path = lake.quarantine(run_id, "accounts")
        rejected = run.account_quarantine
        files.write_table(rejected, path)
        run.account_quarantine = spark.read.schema(rejected.schema).parquet(path)

    def write_fact() -> None:
        path = lake.curated(run_id, "fact_transactions")
        files.write_fact(documented(run.fact, "fact_transactions"), path)
        run.fact = files.read_fact(spark, path)
        files.write_table(profiles.measure(run.fact), lake.curated(run_id, "fact_profile"))

    def write_dimensions() -> None:
        for table in DIMENSIONS:
            files.write_table(documented(getattr(run, table), table), lake.curated(run_id, table))

    # Quarantine and history are written whatever the gate says, curated tables only if it passes.
    always = (write_quarantine, write_account_quarantine, write_malformed_lines)
    together(*([write_fact, write_dimensions] if passed else []), *always)

    outcomes = run.raw_outcomes.unionByName(run.curated_outcomes) if passed else run.raw_outcomes
    files.write_table(outcomes, lake.history("rule_outcomes", run_id))
    written = files.read_table(spark, lake.history("rule_outcomes", run_id), K.OUTCOME_DDL)
    raw_score = rules.score(written.filter(F.col("dataset") == K.RAW_DATASET))
    curated_score = rules.score(written.filter(F.col("dataset") == K.CURATED_DATASET)) if passed else None
    summary = quality.run_summary(
        run.totals, raw_score, curated_score, run.account_quarantine, run_id, run.settings.as_of, limit
    )
    row = summary.first()  # one row
    files.write_table(spark.createDataFrame([row], summary.schema), lake.history("run_summary", run_id))  # commit point
    return row.asDict()
