import datetime as dt

import pytest
from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger import job
from brassledger.catalogue.workspace import Workspace
from brassledger.operators import governance as G
from brassledger.operators import quality
from brassledger.plans import marts
from brassledger.plans.run import Lake, Settings, publish
from brassledger.plans.warehouse import TABLES, Warehouse
from brassledger.sources import files
from brassledger.sources.loads import NothingLoaded


@pytest.fixture(scope="module")
def space(spark, small_dir):
    return Workspace.of(spark, small_dir)


def test_refresh_is_idempotent_but_audited(spark, space, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    for hour in (1, 2):
        loaded = house.refresh(space.lake, dt.datetime(2024, 2, 1, hour))
    assert len(loaded) == 8
    fact = loaded["curated.fact_transactions"]
    assert fact.columns == K.layout_columns(K.FACT_DDL) and fact.count() == 2450
    audit = house.audit()
    assert audit.count() == 8
    per_table = audit.groupBy("table_name").agg(F.count_distinct("rows_loaded").alias("n"))
    assert {r["n"] for r in per_table.collect()} == {1}


def as_seen(house):
    load = house.current()
    return {name: sorted(map(str, load.table(name, ddl).collect())) for name, ddl in TABLES.items()}


def test_a_refresh_that_breaks_off_changes_nothing(spark, space, tmp_path, monkeypatch):
    """All eight tables stay those of the load before, whichever table the refresh had reached."""
    lake = Lake(spark, str(tmp_path / "lake"))
    publish(space.raw_batch_only(), Settings(dt.datetime(2024, 1, 30)), lake)
    house = Warehouse(spark, str(tmp_path / "house"))
    with pytest.raises(NothingLoaded):
        house.table("curated.dim_branch")
    house.refresh(lake, dt.datetime(2024, 1, 30))
    before, audited = as_seen(house), house.audit().count()
    publish(space.raw, Settings(dt.datetime(2024, 2, 1)), lake)
    write, done = files.write_table, []

    def break_off(df, path):
        if len(done) == 3:
            raise RuntimeError("lost the driver")
        write(df, path)
        done.append(path)

    with monkeypatch.context() as patch:
        patch.setattr(files, "write_table", break_off)
        with pytest.raises(RuntimeError):
            house.refresh(lake, dt.datetime(2024, 2, 1))
    assert len(done) >= 3 and as_seen(house) == before and house.audit().count() == audited
    assert len(list((tmp_path / "house").glob("load=*"))) == 1  # nothing is left of it

    house.refresh(lake, dt.datetime(2024, 2, 1))
    after = as_seen(house)
    assert all(after[t] != before[t] for t in ("curated.fact_transactions", "dq.run_summary", "dq.rule_outcomes"))
    assert house.audit().count() == 2 * audited


def test_a_reader_keeps_its_load_and_old_ones_expire(spark, space, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    house.refresh(space.lake, dt.datetime(2024, 2, 1))
    reader = house.current()
    fact = reader.table("curated.fact_transactions", K.FACT_DDL)
    house.refresh(space.lake, dt.datetime(2024, 2, 2))
    assert house.current().load_id != reader.load_id and fact.count() == 2450
    assert house.loads.expire(keep=2) == []
    house.refresh(space.lake, dt.datetime(2024, 2, 3))
    assert house.loads.expire(keep=2) == [reader.load_id]
    assert house.table("curated.fact_transactions").count() == 2450 and house.audit().count() == 12


def test_by_name_matching(spark):
    df = spark.createDataFrame([("b", "1", "gone")], "B string, a string, extra string")
    out = files.match_by_name(df, "a int, b string, c date")
    assert out.dtypes == [("a", "int"), ("b", "string"), ("c", "date")]
    assert tuple(out.first()) == (1, "b", None)


@pytest.mark.parametrize("source", ["lake", "warehouse"])
def test_analyst_export_is_masked(spark, space, tmp_path, source):
    if source == "lake":
        chosen = marts.marts_as(space.now, G.ANALYST)
    else:
        house = Warehouse(spark, str(tmp_path / "house"))
        house.refresh(space.lake, dt.datetime(2024, 2, 1))
        chosen = house.marts_as(G.ANALYST)
    paths = files.export_all(chosen, str(tmp_path / "out"))
    counts = {r["mart"]: r["rows_exported"] for r in files.export_counts(spark, paths).collect()}
    assert len(counts) == 10 and counts["mart_dq_scorecard"] == 12 and counts["mart_customer_value"] == 150
    value = chosen["mart_customer_value"]
    back = files.read_export(spark, paths["mart_customer_value"], value.schema)
    assert back.filter(~F.col("customer_id").startswith("H_")).count() == 0
    assert back.exceptAll(value).count() == 0


def test_job_runs_from_files(spark, space, tmp_path, capsys):
    out = f"{tmp_path}/out"
    job.main(["--raw", space.raw_root, "--lake", str(tmp_path), "--as-of", "2024-02-01", "--export", out, "--role", G.ANALYST])
    exported = spark.read.option("header", "true").csv(f"{out}/mart_customer_value")
    assert exported.filter(F.col("customer_id").startswith("H_")).count() == exported.count() > 0
    assert capsys.readouterr().out.startswith("Status: PUBLISHED | raw rows: 2514 | quarantine rate: 0.025457")
    assert Lake(spark, str(tmp_path)).published_run() == "20240201T000000Z"
    with pytest.raises(quality.QualityGateBlocked):
        job.main(
            ["--raw", space.raw_root, "--lake", str(tmp_path), "--max-quarantine-rate", "0.001", "--as-of", "2024-02-02"]
        )
    assert Lake(spark, str(tmp_path)).published_run() == "20240201T000000Z"
