"""Scans, sources, sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger import fixtures as X
from brassledger.catalogue.core import query
from brassledger.operators import governance as G
from brassledger.operators.validate import reason_counts
from brassledger.plans import marts
from brassledger.plans.warehouse import Warehouse
from brassledger.sources import files
from brassledger.sources.loads import Loads
from brassledger.streaming import events as E
from brassledger.streaming import landing

RAW_AS_READ = ", ".join(f"nullif({c}, '') AS {c}" for c in K.RAW_TRANSACTION)


def zone(column: str = "source_file"):
    """The part of a file path that does not depend on where the lake lies."""
    return F.regexp_extract(column, r"(source=[a-z]+)", 1)


@query("scan_raw_csv", f"SELECT {RAW_AS_READ} FROM raw")
def scan_raw_csv(ws):
    return ws.raw.transactions.drop("source_file", K.RAW_LINE)


@query(
    "string_schema",
    " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS position, '{c}' AS column_name, 'string' AS data_type, "
        f"count(nullif({c}, '')) AS filled_values FROM raw"
        for i, c in enumerate(K.RAW_TRANSACTION)
    ),
)
def string_schema(ws):
    fields = ws.raw.transactions.drop("source_file", K.RAW_LINE).schema.fields
    filled = ws.raw.transactions.agg(*[F.count(f.name).alias(f.name) for f in fields])
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f.name).alias("filled_values"),
        )
        for i, f in enumerate(fields)
    ]
    return filled.select(F.inline(F.array(*lines)))


@query(
    "source_lineage",
    "SELECT regexp_extract(source_file, '(source=[a-z]+)', 1) AS zone, count(*) AS row_count FROM raw GROUP BY ALL",
)
def source_lineage(ws):
    return ws.raw.transactions.groupBy(zone().alias("zone")).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "write_fact_partitioned",
    """SELECT "year", "month", count(*) AS row_count, sum(signed_amount)::DECIMAL(28,2) AS net_flow
       FROM fact GROUP BY ALL""",
)
def write_fact_partitioned(ws):
    path = ws.fresh("fact")
    files.write_fact(ws.run.fact, path)
    back = ws.spark.read.parquet(path)
    return back.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("signed_amount").cast("decimal(28,2)").alias("net_flow")
    )


@query(
    "write_dimensions",
    """SELECT 'dim_account' AS table_name, count(*) AS row_count, count(DISTINCT account_id) AS key_count
       FROM dim_account
       UNION ALL SELECT 'dim_customer', count(*), count(DISTINCT customer_id) FROM dim_customer
       UNION ALL SELECT 'dim_branch', count(*), count(DISTINCT branch_id) FROM dim_branch""",
)
def write_dimensions(ws):
    run, root, parts = ws.run, ws.fresh("dimensions"), []
    for name, key in (("dim_account", "account_id"), ("dim_customer", "customer_id"), ("dim_branch", "branch_id")):
        files.write_table(getattr(run, name), f"{root}/{name}")
        back = ws.spark.read.parquet(f"{root}/{name}")
        parts.append(
            back.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("key_count")).select(
                F.lit(name).alias("table_name"), "*"
            )
        )
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query(
    "write_quarantine",
    """SELECT * REPLACE (regexp_extract(source_file, '(source=[a-z]+)', 1) AS source_file) FROM quarantine""",
)
def write_quarantine(ws):
    root = ws.fresh("quarantine")
    files.write_table(ws.run.quarantine, f"{root}/transactions")
    files.write_table(ws.run.account_quarantine, f"{root}/accounts")
    back = files.read_table(ws.spark, f"{root}/transactions", K.QUARANTINE_DDL)
    return back.withColumn("source_file", zone())


@query("append_dq_history", "SELECT reason, ingest_source, row_count, run_id, run_ts FROM reason_history")
def append_dq_history(ws):
    """Three runs, each below its own folder; the last one is written twice, as by a retry."""
    path, history = ws.fresh("history"), ws.lake.reasons()
    newest = reason_counts(ws.run.quarantine, "20240201T000000Z", X.AS_OF)
    for run_id in ("20240130T000000Z", "20240131T000000Z"):
        files.write_table(history.filter(F.col("run_id") == run_id), f"{path}/run={run_id}")
    for _ in range(2):
        files.write_table(newest, f"{path}/run=20240201T000000Z")
    return files.read_table(ws.spark, path, K.REASON_COUNT_DDL)


@query("run_summary_row", "SELECT * FROM summary WHERE run_id = '20240201T000000Z'")
def run_summary_row(ws):
    return ws.run.summary


@query(
    "catalog_register",
    """SELECT 'fact_transactions' AS table_name, count(*) AS row_count FROM fact
       UNION ALL SELECT 'dim_account', count(*) FROM dim_account
       UNION ALL SELECT 'dim_customer', count(*) FROM dim_customer
       UNION ALL SELECT 'dim_branch', count(*) FROM dim_branch
       UNION ALL SELECT 'quarantine_transactions', count(*) FROM quarantine
       UNION ALL SELECT 'quarantine_accounts', count(*) FROM all_account
                 WHERE coalesce(account_status, '') NOT IN ('ACTIVE', 'DORMANT', 'CLOSED', 'FROZEN')
       UNION ALL SELECT 'run_summary', count(*) FROM summary
       UNION ALL SELECT 'rule_outcomes', count(*) FROM outcome_history
       UNION ALL SELECT 'quarantine_reasons', count(*) FROM reason_history""",
)
def catalog_register(ws):
    """The lake's nine tables: partitioned, with statistics, by their names in the catalog."""
    return counted(ws, ws.catalog.register(), "table_name", "row_count")


def counted(ws, names: dict[str, str], label: str, number: str):
    parts = [f"SELECT '{shown}' AS {label}, count(*) AS {number} FROM {name}" for shown, name in names.items()]
    return ws.spark.sql(" UNION ALL ".join(parts))


@query(
    "refresh_by_name",
    """SELECT transaction_id, customer_id, amount, transaction_ts, NULL::INTEGER AS is_fraud_flag FROM fact""",
)
def refresh_by_name(ws):
    """Upper-case names in another order, one column absent, loaded twice."""
    root = ws.fresh("refresh")
    source = ws.current.fact.drop("is_fraud_flag", "year", "month")
    files.copy_table(source.select(*[F.col(c).alias(c.upper()) for c in reversed(source.columns)]), f"{root}/in")
    loads, given = Loads(ws.spark, f"{root}/out"), ws.spark.read.parquet(f"{root}/in")
    for _ in range(2):
        loads.load({"fact": (given, K.FACT_DDL)}, X.AS_OF)
    loaded = loads.current().table("fact", K.FACT_DDL)
    return loaded.select("transaction_id", "customer_id", "amount", "transaction_ts", "is_fraud_flag")


@query(
    "load_audit",
    """SELECT TIMESTAMP '2024-02-01' AS loaded_at, 'curated.fact_transactions' AS table_name,
              count(*) AS rows_loaded FROM fact
       UNION ALL SELECT TIMESTAMP '2024-02-01', 'curated.dim_customer', count(*) FROM dim_customer
       UNION ALL SELECT TIMESTAMP '2024-02-01', 'curated.dim_account', count(*) FROM dim_account
       UNION ALL SELECT TIMESTAMP '2024-02-01', 'dq.quarantine_transactions', count(*) FROM quarantine""",
)
def load_audit(ws):
    """From the tables to a published run, and from its lake to the warehouse's eight tables."""
    house = Warehouse(ws.spark, ws.fresh("warehouse"))
    house.refresh(ws.own_lake(), X.AS_OF)
    return house.audit()


MART_SIZES = """
    SELECT 'mart_daily_transactions' AS mart, count(*) AS {n} FROM daily
    UNION ALL SELECT 'mart_monthly_kpis', count(*) FROM kpis
    UNION ALL SELECT 'mart_monthly_segment', count(*) FROM segment
    UNION ALL SELECT 'mart_customer_value', count(*) FROM customer_value
    UNION ALL SELECT 'mart_merchant_monthly', count(*) FROM merchant
    UNION ALL SELECT 'mart_branch_activity', count(DISTINCT (branch_id, channel, month_start)) FROM fact
              WHERE branch_id IS NOT NULL
    UNION ALL SELECT 'mart_account_book', count(DISTINCT (year(open_date), account_type, account_status))
              FROM dim_account
    UNION ALL SELECT 'mart_dq_rule_results', count(*) FROM newest_rules
    UNION ALL SELECT 'mart_dq_run_history', count(*) FROM summary
    UNION ALL SELECT 'mart_quarantine_reasons', count(*) FROM reason_history"""


@query("create_mart_views", MART_SIZES.format(n="row_count"))
def create_mart_views(ws):
    return counted(ws, ws.catalog.open_views(), "mart", "row_count")


@query(
    "export_mart_csv",
    "SELECT * REPLACE ('H_' || sha256(customer_id)[:16] AS customer_id) FROM customer_value "
    "WHERE customer_id IN (SELECT customer_id FROM dim_customer)",
)
def export_mart_csv(ws):
    """The customer mart as the analyst exports it, read back from CSV."""
    path, mart = ws.fresh("export"), ws.current_secure(G.ANALYST).customer_value()
    files.export_csv(mart, path)
    return files.read_export(ws.spark, path, mart.schema)


SECURE_SIZES = """
    SELECT 'mart_daily_transactions' AS mart, count(*) AS rows_exported FROM daily
    UNION ALL SELECT 'mart_monthly_kpis', count(*) FROM kpis
    UNION ALL SELECT 'mart_monthly_segment', count(*) FROM segment
    UNION ALL SELECT 'mart_customer_value', count(*) FROM customer_value
    UNION ALL SELECT 'mart_merchant_monthly', count(*) FROM merchant
    UNION ALL SELECT 'mart_branch_activity', count(DISTINCT (branch_id, channel, month_start)) FROM fact
              WHERE branch_id IS NOT NULL
    UNION ALL SELECT 'mart_dq_scorecard', count(*) FROM scorecard
    UNION ALL SELECT 'mart_dq_rule_results', count(*) FROM newest_rules
    UNION ALL SELECT 'mart_dq_run_history', count(*) FROM summary
    UNION ALL SELECT 'mart_quarantine_reasons', count(*) FROM reason_history"""


@query("export_row_counts", SECURE_SIZES)
def export_row_counts(ws):
    """All ten marts of the analyst, counted in the files."""
    exported = files.export_all(marts.marts_as(ws.now, G.ANALYST), ws.fresh("exports"))
    return files.export_counts(ws.spark, exported)


DECODED = ", ".join(f"if(undecodable, '', coalesce({c}, '')) AS {c}" for c in K.RAW_TRANSACTION)


@query("stream_source_json", f"SELECT {DECODED}, undecodable FROM stream_events")
def stream_source_json(ws):
    path = ws.fresh("decoded")
    decoded = E.decode(landing.read_events(ws.spark, ws.events_root)).withColumnRenamed(E.BAD, "undecodable")
    job = decoded.writeStream.format("parquet").option("checkpointLocation", f"{path}/state")
    job.trigger(availableNow=True).start(f"{path}/rows").awaitTermination()
    return ws.spark.read.parquet(f"{path}/rows")


@query(
    "stream_landing_csv",
    f"SELECT {', '.join(K.RAW_TRANSACTION)} FROM stream_events WHERE NOT undecodable",
)
def stream_landing_csv(ws):
    return ws.landed().drop("source_file")
