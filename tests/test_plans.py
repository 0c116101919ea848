"""What the physical plans must and must not contain."""

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger import fixtures as X
from brassledger.catalogue import queries, workspace
from brassledger.catalogue.workspace import Workspace
from brassledger.operators import governance as G
from brassledger.operators import validate
from brassledger.plans import analysis, marts
from brassledger.plans.run import Run, Settings
from brassledger.sources.loads import Loads


@pytest.fixture(scope="module")
def space(spark, small_dir):
    return Workspace.of(spark, small_dir)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def lazy(space) -> Run:
    """The main run with nothing staged."""
    return Run(space.raw, Settings(X.AS_OF))


def frames(space):
    fact, customer, branch, account = space.fact, space.dim_customer, space.dim_branch, space.dim_account
    secure = space.secure(G.REGIONAL)
    return {
        "kpis": marts.monthly_kpis(fact),
        "segment": marts.monthly_segment(fact, customer),
        "value": marts.customer_value(fact, customer),
        "branch": marts.branch_activity(fact, branch),
        "secure kpis": secure.monthly_kpis(),
        "secure value": secure.customer_value(),
        "top states": analysis.top_state_segment(fact, customer),
        "outflow": analysis.net_outflow_recent(fact, customer),
        "dormant": analysis.dormant_active(fact, account),
        "adoption": analysis.digital_adoption(fact, customer),
        "flagged": lazy(space).flagged,
        "fact": lazy(space).fact,
    }


def test_no_nested_loops_and_no_python(space):
    for name, df in frames(space).items():
        text = plan(df)
        for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert banned not in text, (name, banned)


def test_scans_read_only_what_is_asked(space):
    text = plan(analysis.hourly_profile(space.fact))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert read == "transaction_hour:int,channel:string"


def test_filters_reach_the_scan(space):
    text = plan(marts.merchant_monthly(space.fact))
    assert "IsNotNull(merchant_category)" in text


def test_top_k_is_bounded(space):
    assert "TakeOrderedAndProject" in plan(analysis.net_outflow_recent(space.fact, space.dim_customer))
    assert "TakeOrderedAndProject" in plan(analysis.busiest_branches(space.fact, space.dim_branch))


def test_the_fact_is_aggregated_before_it_is_joined(space):
    """Below every join of a mart sits an aggregate of the fact, not its rows."""
    for df in (marts.customer_value(space.fact, space.dim_customer), marts.branch_activity(space.fact, space.dim_branch)):
        text = plan(df)
        join = text.index("Join")
        assert "HashAggregate" in text[join:] and text[join:].index("HashAggregate") < text[join:].index("FileScan")


def test_large_dimensions_are_not_broadcast(spark, space):
    """Past the size threshold the same code plans shuffled joins, and results stay equal."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    small = marts.customer_value(space.fact, space.dim_customer).collect()
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        value = marts.customer_value(space.fact, space.dim_customer)
        assert "BroadcastHashJoin" not in plan(value)
        assert sorted(map(str, value.collect())) == sorted(map(str, small))
        flagged = lazy(space).flagged
        assert "BroadcastHashJoin" not in plan(flagged)
        counts = flagged.agg(F.count("*").alias("n"), F.count_if(F.size("dq_fail_reasons") > 0).alias("bad")).first()
        assert tuple(counts) == (2514, 64)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_single_ids_are_never_ranked(space):
    """Only the branch of repeated ids has windows; the settled branch has none."""
    text = plan(validate.mark_repeats(lazy(space).checked))
    settled = text[: text.index("Window")]
    assert "LeftAnti" in settled and "Sort [transaction_id" not in settled.split("LeftAnti")[0]


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_lanes_of_a_hot_id_go_to_different_tasks(spark, space, threshold):
    """Both rankings are preceded by their own exchange on (id, lane), whatever the join before."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        text = plan(validate.mark_repeats(lazy(space).checked))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"Exchange hashpartitioning\(transaction_id#\d+, _lane#\d+L?, \d+\)", text)) == 2


def test_secure_marts_aggregate_before_they_meet_customers(spark, space):
    """No aggregate may reuse the placement by customer that a join of raw rows would leave."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    secure = space.secure(G.REGIONAL)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for df in (secure.daily_transactions(), secure.monthly_kpis(), secure.merchant_monthly()):
            text = plan(df)
            below = text[text.index("LeftSemi") :]
            fact_side = below[: below.index("FileScan")]
            assert fact_side.count("HashAggregate") == 2, fact_side
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_fixed_tables_have_a_known_size(space):
    assert "BroadcastHashJoin" in plan(G.visible_rows(space.dim_customer, G.REGIONAL))


RAW_SCAN = re.compile(r"FileScan csv \[[^\]]*transaction_timestamp")


@pytest.mark.parametrize(
    "name",
    ["flag_transactions", "split_valid", "split_quarantine", "quarantine_reason_counts", "dq_quarantine_rate",
     "run_summary_row", "win_dedupe_row_number", "standardize_transactions", "dq_evaluate_rules"],
)
def test_raw_files_are_scanned_at_most_once(spark, small_dir, name):
    assert len(RAW_SCAN.findall(plan(queries()[name](spark, small_dir)))) <= 1


def test_staging_scans_the_raw_files_once(space):
    assert len(RAW_SCAN.findall(plan(lazy(space).checked))) == 1
    staged = space.run
    for frame in (staged.checked, staged.flagged, staged.fact, staged.reasons, staged.summary, staged.account_master):
        assert not RAW_SCAN.findall(plan(frame))


def test_the_newest_date_comes_from_the_newest_folder(space):
    text = plan(analysis.recent(space.fact, 3))
    assert re.search(r"PartitionFilters: \[[^\]]*year[^\]]*= *Subquery", text) or text.count("Subquery") >= 2


def test_no_sorting_aggregate_over_all_keys(space):
    """Only rows of keys that repeat reach the maximum over a struct."""
    text = plan(lazy(space).account_master)
    for at in [m.start() for m in re.finditer("SortAggregate", text)]:
        assert "LeftSemi" in text[at:]


def test_staged_runs_hold_most_rows_once(spark, space, tmp_path):
    """Beside the checked rows only rows of repeated ids are written; together they are the flagged rows."""
    folder = str(tmp_path / "run")
    run = Run(space.raw, Settings(X.AS_OF)).stage_in(folder)
    rows = {f.name: spark.read.parquet(str(f)).count() for f in Path(folder).iterdir()}
    checked, again = rows["checked"], run.repeated.agg(F.sum("_copies")).first()[0]
    masters = ("accounts", "account_master", "customers", "repeated_ids", "checked")
    assert sum(n for name, n in rows.items() if name not in masters) == again < checked / 10
    whole = lazy(space)
    assert sorted(map(str, run.flagged.collect())) == sorted(map(str, whole.flagged.collect()))
    assert run.totals.collect() == whole.totals.collect()


def test_curated_tables_need_no_history(spark, small_dir):
    """Fact and dimensions come from the newest run alone; earlier runs are filled in for history, with the same end."""
    space = Workspace(spark, small_dir)
    fact, before = space.fact.count(), [r["run_id"] for r in space.newest.summary().collect()]
    assert len(before) == 1 and "lake" not in vars(space)
    runs = {r["run_id"]: r["pipeline_status"] for r in space.lake.summary().collect()}
    assert len(runs) == 3 and sorted(runs.values()) == [K.BLOCKED, K.PUBLISHED, K.PUBLISHED]
    assert space.now.run_id == space.newest.run_id == before[0] and space.now.fact().count() == fact


def test_a_blocked_newest_run_leaves_the_curated_tables_of_an_earlier_one(spark, small_dir, monkeypatch):
    first, middle, last = workspace.RUNS
    monkeypatch.setattr(workspace, "RUNS", (first, middle, (*last[:2], 0.0)))
    space = Workspace(spark, small_dir)
    assert space.fact.select("run_id").distinct().collect()[0]["run_id"] == Settings(first[0]).run_id
    assert space.newest.newest_run == Settings(last[0]).run_id
    assert space.newest.quarantined().select("run_id").distinct().collect()[0]["run_id"] == Settings(last[0]).run_id


def test_loads_copy_tables_without_a_shuffle(spark, space, tmp_path, monkeypatch):
    from brassledger.sources import files

    seen, copy = [], files.copy_table
    monkeypatch.setattr(files, "copy_table", lambda df, path: (seen.append(plan(df)), copy(df, path)))
    Loads(spark, str(tmp_path)).load({"fact": (space.fact, K.FACT_DDL)}, X.AS_OF)
    assert seen and not any("Exchange" in text for text in seen)


def test_runs_over_the_same_files_share_the_rows_checked_but_for_the_clock(spark, space, tmp_path):
    """Each run finds the reasons that reading the files again would give it, the clock's one in its place."""
    prepared = Run(space.raw, Settings(X.AS_OF)).prepare_in(str(tmp_path / "prepared"))
    early = dt.datetime(1996, 1, 1)  # most rows lie in its future, defective ones too
    for as_of in (early, X.AS_OF):
        shared, alone = prepared.under(Settings(as_of)), Run(space.raw, Settings(as_of))
        assert "Scan csv" not in plan(shared.checked)
        columns = [c for c in alone.checked.columns if c != validate.LANE]
        differ = shared.checked.select(*columns).exceptAll(alone.checked.select(*columns))
        assert differ.isEmpty() and shared.checked.count() == alone.checked.count()
    both = prepared.under(Settings(early)).checked.filter(F.size("dq_fail_reasons") > 1)
    assert not both.filter(F.array_contains("dq_fail_reasons", "FUTURE_TIMESTAMP")).isEmpty()


def test_what_needs_no_run_starts_none(spark, small_dir, monkeypatch):
    """Questions on customers lay out no transactions, questions on typed rows stage nothing."""
    space = Workspace(spark, small_dir)
    monkeypatch.setattr(Workspace, "of", classmethod(lambda cls, *_: space))
    for name in ("agg_listagg_distinct", "access_matrix"):
        assert queries()[name](spark, small_dir).count()
    assert "raw_root" not in vars(space)
    assert queries()["keep_raw_originals"](spark, small_dir).count()
    assert not {"prepared", "run", "_begun"} & set(vars(space))


@pytest.mark.parametrize("name", ["topk", "mart_branch_activity", "refresh_by_name", "load_audit"])
def test_questions_on_the_fact_lay_out_no_files_and_fill_no_shared_lake(spark, small_dir, monkeypatch, name):
    space = Workspace(spark, small_dir)
    monkeypatch.setattr(Workspace, "of", classmethod(lambda cls, *_: space))
    assert queries()[name](spark, small_dir).count()
    assert not {"raw_root", "prepared", "run", "_begun"} & set(vars(space))


def test_the_fact_from_the_tables_is_the_published_one(spark, small_dir):
    space = Workspace(spark, small_dir)
    direct, before = space.current, space.newest.summary().first()
    totals = direct.totals.first()
    assert direct is not space and space.current is space  # once a lake is there it is read
    assert (totals["raw_rows"], totals["quarantined_rows"]) == (before["raw_rows"], before["quarantined_rows"])
    for table in ("fact", "dim_customer", "dim_account", "dim_branch"):
        rows, published = (getattr(x, table).drop("source_file") for x in (direct, space))
        assert sorted(rows.columns) == sorted(published.columns) and rows.count() == published.count()
        assert rows.select(*published.columns).exceptAll(published).isEmpty()


def test_odd_rows_give_the_published_fact_too(spark, small_dir, monkeypatch, tmp_path):
    """Nulls in every column but the first, and rows that come twice."""
    for name in ("orders", "events", "customer", "nation", "region"):
        rows = spark.read.parquet(f"{small_dir}/{name}.parquet")
        key, *rest = rows.columns
        if name in ("orders", "events", "customer"):
            gap = [F.when(F.pmod(F.xxhash64(key, F.lit(c)), F.lit(9)) != 0, F.col(c)).alias(c) for c in rest]
            rows = rows.select(key, *gap)
            rows = rows.unionByName(rows.filter(F.col(key) % 5 == 0))
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(workspace, "RUNS", tuple((*run[:2], 1.0) for run in workspace.RUNS))
    space = Workspace(spark, str(tmp_path))
    direct, published = space.current, space.newest.fact()
    rows = direct.fact.select(*published.columns).drop("source_file")
    assert direct is not space and rows.count() == published.count() > 1000
    assert rows.exceptAll(published.drop("source_file")).isEmpty()
    for table in ("dim_customer", "dim_account"):
        wanted = space.newest.dimension(table)
        assert getattr(direct, table).select(*wanted.columns).exceptAll(wanted).isEmpty()


def test_a_blocked_newest_run_is_not_taken_from_the_tables(spark, small_dir, monkeypatch):
    first, middle, last = workspace.RUNS
    monkeypatch.setattr(workspace, "RUNS", (first, middle, (*last[:2], 0.0)))
    space = Workspace(spark, small_dir)
    assert space.current is space
    assert space.current.fact.select("run_id").distinct().collect()[0]["run_id"] == Settings(first[0]).run_id


def test_rows_that_settle_unwritten_are_the_flagged_ones(spark, space, tmp_path):
    folder = str(tmp_path / "settled")
    run, whole = Run(space.raw, Settings(X.AS_OF)).settle_in(folder), lazy(space)
    assert sorted(f.name for f in Path(folder).iterdir()) == ["account_master", "ranked", "repeated_ids"]
    assert sorted(map(str, run.flagged.collect())) == sorted(map(str, whole.flagged.collect()))
    assert run.totals.collect() == whole.totals.collect()


def test_malformed_lines_need_neither_run_nor_lake(spark, small_dir, monkeypatch):
    """One scan of the delivered files; reconciling them writes no lake."""
    space = Workspace(spark, small_dir)
    monkeypatch.setattr(Workspace, "of", classmethod(lambda cls, *_: space))
    lines = queries()["dq_malformed_line"](spark, small_dir)
    assert lines.count() and not any(word in plan(lines) for word in ("Exchange", "Join"))
    monkeypatch.setattr(workspace, "Lake", None)
    assert {r["unexplained_diff"] for r in queries()["malformed_reconciliation"](spark, small_dir).collect()} == {0}
