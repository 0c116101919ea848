"""Publication that is repeated, breaks off, or happens while somebody reads."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from brassledger import fixtures as X
from brassledger import session as S
from brassledger.catalogue.workspace import Workspace
from brassledger.operators import quality
from brassledger.plans import analysis, marts, run
from brassledger.plans.catalog import Catalog
from brassledger.plans.run import Lake, NothingPublished, RawZone, Settings, publish
from brassledger.sources import files

FIRST, SECOND = dt.datetime(2024, 1, 30), dt.datetime(2024, 2, 1)


@pytest.fixture(scope="module")
def space(spark, small_dir):
    return Workspace.of(spark, small_dir)


def seen(lake):
    """All that readers get, as text."""
    now = lake.snapshot()
    card = quality.scorecard(now.summary(), now.reasons())
    frames = (now.summary(), now.outcomes(), now.reasons(), card, now.quarantined(), now.fact(), now.dimension("dim_customer"))
    return [sorted(map(str, df.collect())) for df in frames]


def test_a_repeated_run_changes_nothing(spark, space, tmp_path):
    lake = Lake(spark, str(tmp_path))
    publish(space.raw_batch_only(), Settings(FIRST), lake)
    publish(space.raw, Settings(SECOND), lake)
    before = seen(lake)
    publish(space.raw, Settings(SECOND), lake)
    assert seen(lake) == before
    assert lake.outcomes().count() == 48 and lake.summary().count() == 2
    assert not list((tmp_path / "stage").iterdir())


def test_a_run_that_breaks_off_is_not_seen(spark, space, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    publish(space.raw_batch_only(), Settings(FIRST), lake)
    before, rules = seen(lake), sorted(map(str, marts.rule_results(lake.outcomes()).collect()))
    reasons = sorted(map(str, analysis.latest_reasons(lake.reasons()).collect()))

    def fail(*args, **kwargs):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(run.quality, "run_summary", fail)
    with pytest.raises(RuntimeError):
        publish(space.raw, Settings(SECOND), lake)
    assert seen(lake) == before
    assert sorted(map(str, marts.rule_results(lake.outcomes()).collect())) == rules
    assert sorted(map(str, analysis.latest_reasons(lake.reasons()).collect())) == reasons
    assert not list((tmp_path / "stage").iterdir())


def test_a_snapshot_stays_at_one_run_and_views_follow(spark, space, tmp_path):
    lake = Lake(spark, str(tmp_path))
    publish(space.raw_batch_only(), Settings(FIRST), lake)
    old = lake.snapshot()
    fact = old.fact()
    catalog = Catalog(spark, lake, "bank_follow")
    names, shown = catalog.register(), catalog.open_views()
    assert len(names) == 9 and len(shown) == 10
    publish(space.raw, Settings(SECOND), lake)
    customers = old.dimension("dim_customer")
    assert {r.run_id for r in fact.select("run_id").distinct().collect()} == {"20240130T000000Z"}
    assert "run=20240130T000000Z" in customers.inputFiles()[0]
    assert old.summary().count() == 1 and lake.snapshot().summary().count() == 2

    now = lake.snapshot()
    for _ in range(2):  # again without a drop
        names = catalog.register()
    assert spark.table(names["fact_transactions"]).count() == now.fact().count() > fact.count()
    open_marts = marts.all_open(
        now.fact(), now.dimension("dim_customer"), now.dimension("dim_account"), now.dimension("dim_branch"),
        now.outcomes(), now.summary(), now.reasons(),
    )
    assert set(shown) == set(open_marts)
    for mart, df in open_marts.items():
        view = spark.table(shown[mart])
        assert view.columns == df.columns, mart
        assert sorted(map(str, view.collect())) == sorted(map(str, df.collect())), mart


def test_runs_at_the_same_time_lose_nothing(spark, small_dir, tmp_path):
    zone = X.raw_zone(spark, small_dir)
    few = RawZone(zone.transactions.filter("source_account_id < 'ACC0000030'"), zone.accounts, zone.customers, zone.branches)
    lake = Lake(spark, str(tmp_path))
    days = [dt.datetime(2024, 3, d) for d in range(1, 5)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda day: publish(few, Settings(day, max_quarantine_rate=1.0), lake), days))
    assert lake.summary().count() == 4
    per_run = lake.outcomes().groupBy("run_id").agg(F.count("*").alias("n")).collect()
    assert [r.n for r in per_run] == [24] * 4


def test_an_empty_lake_says_so(spark, tmp_path):
    with pytest.raises(NothingPublished):
        Lake(spark, str(tmp_path)).fact()


def test_no_local_folder_on_a_cluster(monkeypatch):
    def fake(master, shared=None):
        conf = SimpleNamespace(get=lambda key, default=None: shared or default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://host"):
        with pytest.raises(ValueError):
            S.shared_folder(fake(master), "x")
    assert S.shared_folder(fake("yarn", "s3a://b/shared/"), "x").startswith("s3a://b/shared/brassledger/x-")


def test_package_code_stages_below_the_lake_only(spark, space, tmp_path, monkeypatch):
    def fail(*args, **kwargs):
        raise AssertionError("a temporary folder was asked for")

    raw = space.raw_batch_only()
    monkeypatch.setattr(S.tempfile, "mkdtemp", fail)
    publish(raw, Settings(FIRST), Lake(spark, str(tmp_path)))
    assert files.read_table(spark, f"{tmp_path}/dq-results/run_summary", "run_id string").count() == 1
