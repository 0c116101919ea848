"""Injected defects against caught defects, the gate, and publication."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger import fixture_defects as D
from brassledger import fixtures as X
from brassledger.catalogue.workspace import Workspace
from brassledger.operators import quality, validate
from brassledger.plans import analysis, marts
from brassledger.plans.run import Lake, RawZone, Run, Settings, publish
from brassledger.sources import files

# Known counts per scale: raw rows, quarantined, fact rows, bad accounts, rate, and rows per reason.
EXPECTED = {
    "0.001": (2514, 64, 2450, 3, 0.025457, [2, 8, 8, 8, 6, 6, 2, 10, 14]),
    "0.01": (25091, 416, 24675, 6, 0.016580, [13, 52, 52, 52, 39, 39, 13, 65, 91]),
    "0.1": (250875, 4000, 246875, 45, 0.015944, [125, 500, 500, 500, 375, 375, 125, 625, 875]),
}
ORDER = tuple(D.RESIDUES)


@pytest.mark.parametrize("sf", list(EXPECTED))
def test_caught_equals_injected(spark, sf):
    raw_rows, held, fact_rows, bad_accounts, rate, per_reason = EXPECTED[sf]
    d = f"/root/testdata/sf{sf}"
    run = X.run(spark, d)
    totals = run.totals.first()
    assert tuple(totals) == (raw_rows, raw_rows - held, held, rate)
    reasons = run.reasons.groupBy("reason").agg(F.sum("row_count").alias("n")).collect()
    assert {r["reason"]: r["n"] for r in reasons} == dict(zip(ORDER, per_reason))
    manifest = D.defect_manifest(X.clean_transactions(spark, d), X.NUMBER).collect()
    assert {r["defect"]: r["defect_rows"] for r in manifest} == dict(zip(ORDER, per_reason))
    assert run.account_quarantine.count() == bad_accounts

    f = run.fact
    seen = f.agg(
        F.count("*").alias("rows"),
        F.count_distinct("transaction_id").alias("ids"),
        F.count_if(~F.col("channel").isin(*K.CHANNELS)).alias("channels"),
        F.count_if(~F.col("transaction_type").isin(*K.TRANSACTION_TYPES)).alias("types"),
        F.count_if(F.col("customer_id").isNull()).alias("ownerless"),
    ).first()
    assert tuple(seen) == (fact_rows, fact_rows, 0, 0, 0)


@pytest.fixture(scope="module")
def space(spark, small_dir):
    return Workspace.of(spark, small_dir)


def test_gate_keeps_the_published_run(spark, space, tmp_path):
    lake = Lake(spark, str(tmp_path))
    first = publish(space.raw_batch_only(), Settings(dt.datetime(2024, 1, 30)), lake)
    assert first["pipeline_status"] == K.PUBLISHED and first["curated_dq_score"] == 1.0
    before = lake.fact().count()
    with pytest.raises(quality.QualityGateBlocked):
        publish(space.raw, Settings(X.AS_OF, max_quarantine_rate=0.01), lake)
    assert lake.published_run() == first["run_id"]
    assert lake.fact().count() == before
    # history of the blocked run is there, curated outcomes are not
    newest = quality.latest_run(lake.summary()).first()
    assert (newest["pipeline_status"], newest["curated_dq_score"]) == (K.BLOCKED, None)
    assert lake.outcomes().filter(F.col("run_id") == newest["run_id"]).select("dataset").distinct().count() == 1
    assert lake.quarantined().select("run_id").distinct().first()["run_id"] == newest["run_id"]
    # the fact is the older run's, so a difference is due, and it is visible
    assert analysis.reconcile(lake.summary(), lake.fact()).first()["unexplained_diff"] != 0


def test_published_lake_reconciles_and_prunes(spark, space):
    lake = space.lake
    assert quality.load_reconciliation(lake.summary(), lake.fact(), lake.quarantined()).first()["unexplained_diff"] == 0
    plan = analysis.recent(lake.fact(), 3)._jdf.queryExecution().executedPlan().toString()
    found = re.findall(r"PartitionFilters: \[(.*?)PushedFilters", plan)
    assert any("year" in f and "month" in f for f in found), found


def test_published_columns_carry_comments_and_tags(spark, space):
    lake = space.lake
    fact = spark.read.parquet(lake.curated(lake.published_run(), "fact_transactions"))
    assert all("comment" in fact.schema[c].metadata for c in K.layout_columns(K.FACT_DDL))
    assert fact.schema["customer_id"].metadata["data_classification"] == "DIRECT_IDENTIFIER"


def test_lazy_and_published_agree(space):
    lazy = space.run.fact.drop("source_file", "run_id")
    published = space.fact.drop("source_file", "run_id")
    assert lazy.exceptAll(published).count() == 0 and published.exceptAll(lazy).count() == 0


def test_early_counts_equal_flagged_counts(space):
    run = space.run
    early = validate.count_quarantined(run.checked, validate.repeated_ids(run.checked)).first()
    late = run.totals.first()
    assert (early["raw_rows"], early["quarantined_rows"]) == (late["raw_rows"], late["quarantined_rows"])


def test_many_duplicates_trip_the_default_gate(spark, small_dir, tmp_path):
    """Line items keyed by (order, line) repeat naturally: about a quarter are second versions."""
    line = X.table(spark, small_dir, "lineitem")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    rows = line.select(
        key.alias("transaction_id"),
        F.lit("2001-01-01 00:00:00").alias("transaction_timestamp"),
        F.lit("ACC0000005").alias("source_account_id"),
        F.lit("C1").alias("counterparty_id"),
        F.lit("DEBIT").alias("transaction_type"),
        F.col("l_quantity").cast("string").alias("amount"),
        F.lit("POS").alias("channel"),
        F.lit("").alias("merchant_category"),
        F.lit("").alias("branch_id"),
        F.lit("POSTED").alias("transaction_status"),
        F.lit("0").alias("balance_before"),
        F.lit("0").alias("balance_after"),
        F.lit("0").alias("is_fraud_flag"),
        F.lit("raw/source=batch/x.csv").alias("source_file"),
    )
    distinct = rows.select("transaction_id").distinct().count()
    lake = Lake(spark, str(tmp_path))
    with pytest.raises(quality.QualityGateBlocked):
        publish(X.raw_zone(spark, small_dir, rows), Settings(X.AS_OF), lake)
    summary = lake.summary().first()
    assert summary["curated_rows"] == distinct
    assert summary["quarantined_rows"] == rows.count() - distinct


def test_empty_raw_publishes_empty_tables(spark, small_dir, tmp_path):
    zone = X.raw_zone(spark, small_dir)
    empty = RawZone(zone.transactions.limit(0), zone.accounts, zone.customers, zone.branches)
    lake = Lake(spark, str(tmp_path))
    row = publish(empty, Settings(X.AS_OF), lake)
    assert (row["raw_rows"], row["quarantine_rate"], row["pipeline_status"]) == (0, 0.0, K.PUBLISHED)
    assert marts.monthly_kpis(lake.fact()).count() == 0


def test_raw_values_survive_the_csv_round_trip(spark, tmp_path):
    values = [' lead and trail ', 'say "hi", twice', "back\\slash", "comma,comma"]
    rows = spark.createDataFrame([(v,) for v in values], "a string")
    files.write_raw(rows, str(tmp_path / "x"), ["a"])
    back = files.read_raw(spark, str(tmp_path / "x"), ["a"])
    assert sorted(r["a"] for r in back.collect()) == sorted(values)
    assert all("/x/" in r["source_file"] for r in back.collect())


def test_run_object_is_lazy(spark, small_dir):
    run = Run(X.raw_zone(spark, small_dir), Settings(X.AS_OF))
    assert run.settings.run_id == "20240201T000000Z"
    assert run.fact.columns[-2:] == ["year", "month"]
    assert run.fact.columns[:24] == K.layout_columns(K.FACT_DDL)
    assert run.fact.select(*K.layout_columns(K.FACT_DDL)).dtypes == spark.createDataFrame([], K.layout(K.FACT_DDL)).dtypes
