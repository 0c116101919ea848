"""Catalog tables, their partitions and statistics, and views that follow the role of their reader."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brassledger.catalogue.workspace import Workspace
from brassledger.operators import governance as G
from brassledger.plans import marts
from brassledger.plans.catalog import TABLES, Catalog, estimated_rows
from brassledger.plans.run import Lake, Settings, publish

FIRST, SECOND = dt.datetime(2024, 1, 30), dt.datetime(2024, 2, 1)


@pytest.fixture(scope="module")
def space(spark, small_dir):
    return Workspace.of(spark, small_dir)


@pytest.fixture(scope="module")
def twice(spark, space, tmp_path_factory):
    """A catalog registered after a first and after a second publication."""
    root = tmp_path_factory.mktemp("lake")
    lake = Lake(spark, str(root))
    publish(space.raw_batch_only(), Settings(FIRST), lake)
    catalog = Catalog(spark, lake, "bank_twice")
    catalog.register()
    first = catalog.partitions("fact_transactions"), spark.table(catalog.name("fact_transactions")).count(), catalog.partitions("rule_outcomes")
    publish(space.raw, Settings(SECOND), lake)
    catalog.register()
    return root, lake, catalog, first


def rows(df):
    return sorted(map(str, df.collect()))


def test_partitions_follow_a_second_publication(spark, twice):
    root, lake, catalog, (months, count, runs) = twice
    folder = root / "curated" / f"run={lake.published_run()}" / "fact_transactions"
    folders = sorted(f"{m.parent.name}/{m.name}" for m in folder.glob("year=*/month=*"))
    assert sorted(catalog.partitions("fact_transactions")) == folders
    assert runs == ["run=20240130T000000Z"]
    for table in ("run_summary", "rule_outcomes", "quarantine_reasons"):
        assert catalog.partitions(table) == ["run=20240130T000000Z", "run=20240201T000000Z"]
    assert spark.table(catalog.name("fact_transactions")).count() == lake.fact().count() > count
    assert sorted(t.name for t in spark.catalog.listTables(catalog.schema) if t.tableType == "EXTERNAL" and "__" not in t.name) >= sorted(TABLES)


def test_a_filter_lists_partitions_of_the_catalog_only(spark, twice):
    _, _, catalog, _ = twice
    month = catalog.partitions("fact_transactions")[0]
    year, number = (part.split("=")[1] for part in month.split("/"))
    some = spark.table(catalog.name("fact_transactions")).filter(f"year = {year} AND month = {number}")
    assert some.count() > 0 and all(month in r[0] for r in some.select("_metadata.file_path").distinct().collect())
    assert "PartitionFilters: [isnotnull(year" in some._jdf.queryExecution().toString()


def test_history_of_a_run_that_broke_off_has_no_partition(spark, space, twice, monkeypatch):
    from brassledger.plans import run

    root, lake, catalog, _ = twice

    def fail(*args, **kwargs):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as patch:
        patch.setattr(run.quality, "run_summary", fail)
        with pytest.raises(RuntimeError):
            publish(space.raw, Settings(dt.datetime(2024, 2, 2)), lake)
    assert (root / "dq-results" / "rule_outcomes" / "run=20240202T000000Z").exists()
    catalog.register()
    assert "run=20240202T000000Z" not in catalog.partitions("rule_outcomes")
    assert rows(spark.table(catalog.name("rule_outcomes")).drop("run")) == rows(lake.outcomes())


def build_side(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return "BuildLeft" if "BuildLeft" in text else "BuildRight" if "BuildRight" in text else "none"


def test_statistics_change_the_build_side(spark, twice):
    """One transaction joined to all customers: only column statistics tell that it is one row."""
    _, lake, catalog, _ = twice
    fact, customers = catalog.name("fact_transactions"), catalog.name("dim_customer")
    one = spark.table(fact).select("transaction_id").first()[0]
    query = f"SELECT * FROM {fact} f JOIN {customers} c ON f.customer_id = c.customer_id WHERE f.transaction_id = '{one}'"
    known = spark.sql(query)
    assert estimated_rows(spark.table(fact)) == lake.fact().count()
    assert estimated_rows(spark.table(fact).filter(F.col("transaction_id") == one)) <= 2
    now = lake.snapshot()
    unknown = now.fact().alias("f").join(now.dimension("dim_customer").alias("c"), "customer_id").filter(F.col("transaction_id") == one)
    assert (build_side(unknown), build_side(known)) == ("BuildRight", "BuildLeft")
    assert known.count() == unknown.count() == 1


def test_comments_and_tags_are_in_the_catalog(spark, twice):
    _, _, catalog, _ = twice
    described = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE {catalog.name('dim_customer')}").collect()}
    assert described["state"] == "State of residence"
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {catalog.name('dim_customer')}").collect()}
    assert properties["data_classification.state"] == "QUASI_IDENTIFIER" and properties["data_owner"] == G.OWNERS["dim_customer"]


def secure_by_hand(lake, role):
    now = lake.snapshot()
    return marts.marts_as(now, role), {
        "fact_transactions": G.apply_masking(now.fact(), "fact_transactions", role),
        "dim_account": G.apply_masking(now.dimension("dim_account"), "dim_account", role),
        "dim_customer": G.apply_masking(G.visible_rows(now.dimension("dim_customer"), role), "dim_customer", role),
    }


def test_session_views_follow_the_variable(spark, twice):
    _, lake, catalog, _ = twice
    names = catalog.session_views(G.ANALYST)
    assert len(names) == 13
    for role in (G.REGIONAL, G.STEWARD, G.ANALYST):
        catalog.act_as(role)
        by_role, tables = secure_by_hand(lake, role)
        for name, expected in {**by_role, **tables}.items():
            view = spark.table(names[name])
            assert view.columns == expected.columns and rows(view) == rows(expected), (role, name)
    catalog.act_as("SOMEBODY")
    assert spark.table(names["mart_customer_value"]).count() == 0 == spark.table(names["dim_customer"]).count()
    assert spark.table(names["dim_account"]).filter(~F.col("account_id").startswith("H_")).count() == 0


def test_lasting_views_follow_their_reader(spark, twice):
    """Made once; the role of the reading user is looked up at every query."""
    _, lake, catalog, _ = twice
    names = catalog.secure_views()
    me = spark.sql("SELECT current_user()").first()[0]
    assert spark.table(names["mart_customer_value"]).count() == 0  # no role yet
    for role in (G.REGIONAL, G.ENGINEER):
        catalog.set_members([(me, role), ("another", G.STEWARD)])
        by_role, tables = secure_by_hand(lake, role)
        for name in ("mart_customer_value", "mart_monthly_kpis", "mart_branch_activity", "mart_dq_scorecard"):
            assert rows(spark.table(names[name])) == rows(by_role[name]), (role, name)
        assert rows(spark.table(names["dim_account"])) == rows(tables["dim_account"])
    other = spark.newSession()
    assert rows(other.table(names["mart_customer_value"])) == rows(by_role["mart_customer_value"])
    catalog.set_members([])


def test_secure_views_join_aggregates(spark, twice):
    """Where customers are too many to broadcast, the row policy meets one row per customer and key, not the fact."""
    _, _, catalog, _ = twice
    names = catalog.session_views(G.REGIONAL)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for mart in ("mart_daily_transactions", "mart_monthly_kpis", "mart_customer_value", "mart_monthly_segment"):
            text = spark.table(names[mart])._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in text and "CartesianProduct" not in text
            below = text[text.index("SortMergeJoin") :]
            assert below.index("HashAggregate") < below.index(f"FileScan parquet spark_catalog.{catalog.schema}.fact"), mart
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
