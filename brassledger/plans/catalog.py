"""The lake in the catalog: partitioned external tables with statistics, open views, and views that follow their reader.

Tables.  `Catalog.register` gives the nine folders of a lake their names.  A table is made aside, with its partitions
and statistics, and then takes the name over, so readers see the table of one run or of the next and never a mix; files
are not touched.  Partitions of the fact are its month folders, those of history tables the committed runs, so a run
that broke off has none.  Row counts, sizes and (for keys and filters) column statistics are there for the planner:
`spark.sql.cbo.enabled` lets it use them for the order and the build side of joins.

Roles.  Masks and the row policy are SQL functions and a view over customers; who reads is asked when a view is read,
not when it is made.  Lasting views look their reader up in `role_members` (one role per user; nobody's role sees no
customer and no identifier).  A job that acts for a role has the same views in its session, with the role in a session
variable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brassledger import contracts as K
from brassledger.operators import governance as G
from brassledger.plans import mart_sql as M
from brassledger.plans.run import DIMENSIONS, Lake
from brassledger.sources import files

HISTORY = {"run_summary": K.SUMMARY_DDL, "rule_outcomes": K.OUTCOME_DDL, "quarantine_reasons": K.REASON_COUNT_DDL}
TABLES = ("fact_transactions", *DIMENSIONS, "quarantine_transactions", "quarantine_accounts", *HISTORY)
#: Columns of the fact that joins and filters use; statistics of all would read the whole fact.
FACT_STATISTICS = (
    "transaction_id", "transaction_date", "source_account_id", "customer_id", "transaction_type", "channel",
    "merchant_category", "branch_id",
)
COUNTABLE = ("string", "boolean", "date", "int", "bigint", "double", "decimal", "timestamp")
ROLE = "bank_role"  # the session variable


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Catalog:
    """A schema for one lake."""

    def __init__(self, spark: SparkSession, lake: Lake, schema: str):
        self.spark, self.lake, self.schema = spark, lake, schema

    def name(self, table: str) -> str:
        return f"{self.schema}.{table}"

    @property
    def tables(self) -> dict[str, str]:
        return {t: self.name(t) for t in TABLES}

    # ------------------------------------------------------------ tables
    def register(self) -> dict[str, str]:
        """All tables as of the newest runs; again after every publication."""
        lake, now = self.lake, self.lake.snapshot()
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema} LOCATION {_quoted(lake.root + '/catalog')}")
        self._external("fact_transactions", lake.curated(now.run_id, "fact_transactions"), f"{K.FACT_DDL}, year int, month int", ("year", "month"))
        for table, ddl in DIMENSIONS.items():
            self._external(table, lake.curated(now.run_id, table), ddl)
        self._external("quarantine_transactions", lake.quarantine(now.newest_run, "transactions"), K.QUARANTINE_DDL)
        accounts = lake.quarantine(now.newest_run, "accounts")
        self._external("quarantine_accounts", accounts, self.spark.read.parquet(accounts).schema.toDDL())
        runs = [r["run_id"] for r in now.summary().select("run_id").collect()]  # a row per run
        for table, ddl in HISTORY.items():
            self._external(table, lake.history(table), f"{ddl}, run string", ("run",), runs)
        return self.tables

    def _external(self, table: str, path: str, ddl: str, partitions: tuple = (), runs: list[str] | None = None) -> None:
        sql, old, new = self.spark.sql, self.name(table), self.name(f"{table}__next")
        comments, tags = K.COMMENTS.get(table, {}), G.TAGS.get(table, {})
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {_quoted(comments[f.name])}" if f.name in comments else "")
            for f in K.layout(ddl).fields
        )
        facts = {"location_run": path, **{f"{G.CLASSIFICATION}.{c}": label for c, label in tags.items()}}
        if table in G.OWNERS:
            facts["data_owner"] = G.OWNERS[table]
        properties = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in facts.items())
        by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        sql(f"DROP TABLE IF EXISTS {new}")
        sql(f"CREATE TABLE {new} ({columns}) USING parquet {by} LOCATION {_quoted(path)} TBLPROPERTIES ({properties})")
        if runs is not None:
            for run in runs:
                sql(f"ALTER TABLE {new} ADD PARTITION (run = {_quoted(run)}) LOCATION {_quoted(f'{path}/run={run}')}")
        elif partitions:
            sql(f"MSCK REPAIR TABLE {new}")
        self._analyze(new, table, ddl, partitions)
        sql(f"DROP TABLE IF EXISTS {old}")  # external: its files stay
        sql(f"ALTER TABLE {new} RENAME TO {old}")

    def _analyze(self, name: str, table: str, ddl: str, partitions: tuple) -> None:
        countable = [f.name for f in K.layout(ddl).fields if f.dataType.simpleString().startswith(COUNTABLE) and f.name not in partitions]
        columns = [c for c in countable if table != "fact_transactions" or c in FACT_STATISTICS]
        if partitions:
            self.spark.sql(f"ANALYZE TABLE {name} PARTITION ({', '.join(partitions)}) COMPUTE STATISTICS")
        self.spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(f'`{c}`' for c in columns)}")

    def partitions(self, table: str) -> list[str]:
        return [r["partition"] for r in self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()]

    # ------------------------------------------------------------ open views
    def open_views(self) -> dict[str, str]:
        """The ten open marts; any session of the catalog can query them."""
        names = {mart: self.name(mart) for mart in M.OPEN}
        for mart, name in names.items():
            self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {M.OPEN[mart].format(**self.tables)}")
        return names

    # ------------------------------------------------------------ policies
    def set_members(self, members: list[tuple[str, str]]) -> None:
        """Which user has which role; views that exist follow at once."""
        self._policy_table("role_members", ("user_name", "role_name"), members)

    def _policy_table(self, table: str, columns: tuple[str, ...], rows) -> None:
        path = f"{self.lake.root}/governance/{table}"
        ddl = ", ".join(f"{c} string" for c in columns)
        files.write_table(self.spark.createDataFrame(list(rows), ddl), path)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({ddl}) USING parquet LOCATION {_quoted(path)}")
        self.spark.catalog.refreshTable(self.name(table))

    def secure_views(self) -> dict[str, str]:
        """Lasting views for whoever reads them: three masked tables and the ten marts with row policy and masks."""
        self._policy_table("entitlements", ("role_name", "state"), G.ENTITLEMENTS)
        if not self.spark.catalog.tableExists(self.name("role_members")):
            self.set_members([])
        mine = f"SELECT min(role_name) FROM {self.name('role_members')} WHERE user_name = current_user()"
        return self._secure("", self.name, f"({mine})")

    def session_views(self, role: str) -> dict[str, str]:
        """The same views in this session only, for `role` or whatever `act_as` names later."""
        self._policy_table("entitlements", ("role_name", "state"), G.ENTITLEMENTS)
        self.spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE} STRING")
        self.act_as(role)
        return self._secure("TEMPORARY", lambda table: table, f"session.{ROLE}")

    def act_as(self, role: str) -> None:
        self.spark.sql(f"SET VARIABLE {ROLE} = {_quoted(role)}")

    def _secure(self, kind: str, name, reader: str) -> dict[str, str]:
        def function(what: str, body: str) -> None:
            self.spark.sql(f"CREATE OR REPLACE {kind} FUNCTION {name(what)} {body}")

        def view(what: str, query: str) -> str:
            self.spark.sql(f"CREATE OR REPLACE {kind} VIEW {name(what)} AS {query}")
            return name(what)

        raw = ", ".join(map(_quoted, sorted(G.SEES_RAW)))
        every = ", ".join(map(_quoted, sorted(G.SEES_ALL_ROWS)))
        function("reader_role", f"() RETURNS STRING RETURN {reader}")
        shown = f"RETURN CASE WHEN {name('reader_role')}() IN ({raw}) THEN value"
        function("mask_identifier", f"(value STRING) RETURNS STRING {shown} ELSE concat('H_', left(sha2(value, 256), 16)) END")
        function("mask_balance", f"(value {K.MONEY}) RETURNS {K.MONEY} {shown} ELSE CAST(round(value, -3) AS {K.MONEY}) END")
        states = f"SELECT state FROM {self.name('entitlements')} WHERE role_name = {name('reader_role')}()"
        visible = view(
            "visible_customers",
            f"SELECT * FROM {self.name('dim_customer')} WHERE {name('reader_role')}() IN ({every}) OR state IN ({states})",
        )
        names = {}
        for table, masks in G.MASKED.items():
            columns = self.spark.table(self.name(table)).columns
            picked = [f"{name(f'mask_{masks[c]}')}({c}) AS {c}" if c in masks else c for c in columns]
            of = visible if table == "dim_customer" else self.name(table)
            names[table] = view(f"{table}_secure", f"SELECT {', '.join(picked)} FROM {of}")
        places = {**self.tables, "visible": visible, "mask_identifier": name("mask_identifier")}
        for mart, text in M.SECURE.items():
            names[mart] = view(f"{mart}_secure", text.format(**places))
        return names


def estimated_rows(df: DataFrame) -> int | None:
    """What the planner expects a frame to return, by the statistics it has."""
    stats = df._jdf.queryExecution().optimizedPlan().stats().rowCount()
    return int(str(stats.get())) if stats.isDefined() else None

