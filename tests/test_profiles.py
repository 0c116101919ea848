"""Metric states: equal to a full pass, measured once per folder, quantiles within their rank error."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from brassledger.catalogue.workspace import Workspace
from brassledger.operators import quality
from brassledger.plans import profiles as P
from brassledger.sources import files


@pytest.fixture(scope="module")
def space(spark, small_dir):
    return Workspace.of(spark, small_dir)


def rows_of(values, spark, ids=None):
    """Typed transactions with these amounts."""
    data = [(str(i) if ids is None else ids[i], "A1", "TRANSFER", None if v is None else Decimal(v), "ATM") for i, v in enumerate(values)]
    ddl = "transaction_id string, source_account_id string, transaction_type string, amount decimal(18,2), channel string"
    return spark.createDataFrame(data, ddl).withColumn("transaction_ts", F.lit("2024-01-05 10:00:00").cast("timestamp_ntz"))


def test_merged_states_equal_a_full_pass(spark, space):
    std = space.run.std
    row = P.metrics(space.raw_profile()).first()
    assert row["row_count"] == std.count()
    assert row["null_ids"] == std.filter("transaction_id IS NULL").count() > 0
    assert row["null_accounts"] == std.filter("source_account_id IS NULL").count() > 0
    assert row["non_positive_amounts"] == std.filter("amount <= 0").count() > 0
    distinct = std.select("transaction_id").dropna().distinct().count()
    assert abs(row["distinct_ids"] - distinct) <= 0.03 * distinct
    exact = quality.duplicate_count(std, "transaction_id").first()[0]
    assert abs(row["duplicates"] - exact) <= 0.03 * distinct


def test_only_new_or_changed_folders_are_read(spark, tmp_path):
    raw, opened = str(tmp_path / "raw zone"), []

    def add(folder, first, count):
        part = spark.range(first, first + count).select(F.col("id").cast("string").alias("transaction_id"))
        part = part.withColumns({"amount": F.lit("1.00"), "transaction_type": F.lit("CASH OUT"), "transaction_timestamp": F.lit("2024-01-05 10:00:00")})
        part = part.withColumns({c: F.lit("x") for c in files.K.RAW_TRANSACTION if c not in part.columns})
        part.select(*files.K.RAW_TRANSACTION).coalesce(1).write.mode("append").options(**files.CSV_DIALECT).csv(f"{raw}/{folder}")

    def read(paths):
        opened.extend(paths)
        rows = files.read_raw(spark, paths, files.K.RAW_TRANSACTION)
        return rows.select(
            "transaction_id", "source_account_id", "transaction_type", F.col("amount").cast("decimal(18,2)"), "channel",
            F.col("transaction_timestamp").cast("timestamp_ntz").alias("transaction_ts"),
        )

    def count(store):
        listed = P.folders_of(spark, raw)
        del opened[:]
        new = store.refresh(listed, read)
        return len(new), len(opened), P.metrics(store.state(listed)).first()

    store = P.Profiles(spark, str(tmp_path / "states"))
    add("day=1", 0, 10)
    add("day=2", 10, 20)
    new, read_files, row = count(store)
    assert (new, read_files, row["row_count"], row["distinct_ids"]) == (2, 2, 30, 30)
    assert count(store)[:2] == (0, 0)
    add("day=3", 25, 10)  # five ids come again
    new, read_files, row = count(store)
    assert (new, read_files, row["row_count"], row["duplicates"]) == (1, 1, 40, 5)
    add("day=1", 100, 7)  # a folder that grew is measured anew, and counted once
    new, read_files, row = count(P.Profiles(spark, str(tmp_path / "states")))
    assert (new, read_files, row["row_count"]) == (1, 2, 47)


def test_a_refresh_that_breaks_off_leaves_whole_states(spark, tmp_path):
    store = P.Profiles(spark, str(tmp_path / "states"))
    good = rows_of([1, 2, 3], spark)
    broken = good.withColumn("amount", F.raise_error(F.lit("lost")).cast("decimal(18,2)"))
    folders = {"a": ["a/1"], "b": ["b/1"]}
    with pytest.raises(Exception, match="lost"):
        store.refresh(folders, lambda paths: broken if paths == ["b/1"] else good)
    assert P.metrics(store.state(folders)).first()["row_count"] in (0, 3)
    store.refresh(folders, lambda paths: good)
    assert P.metrics(store.state(folders)).first()["row_count"] == 6


def test_empty_null_and_tied_rows(spark, tmp_path):
    store = P.Profiles(spark, str(tmp_path / "none"))
    empty = P.metrics(store.state({})).first()
    assert (empty["row_count"], empty["distinct_ids"], empty["duplicates"]) == (0, 0, 0)
    nulls = rows_of([None, None], spark, [None, None])
    shown = P.value_percentiles(P.measure(nulls), "transaction_type").first()
    assert (shown["txn_count"], shown["median_value"], shown["p95_value"]) == (2, None, None)
    assert P.metrics(P.measure(nulls)).first()["distinct_ids"] == 0
    tied = P.value_percentiles(P.measure(rows_of([5] * 50, spark, ["same"] * 50)), "transaction_type").first()
    assert (str(tied["median_value"]), str(tied["p95_value"])) == ("5.00", "5.00")
    assert P.metrics(P.measure(rows_of([5] * 50, spark, ["same"] * 50))).first()["duplicates"] == 49


@pytest.mark.parametrize("rows", [40_000, 1_500_000])
def test_ranks_of_merged_quantiles(spark, rows):
    """Amounts are a permutation of 0..rows-1 in cents over 30 days, so a value's rank is the value."""
    step = 1_000_003  # prime to both sizes
    cents = F.pmod(F.col("id") * step, F.lit(rows))
    data = spark.range(0, rows, 1, 16).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.lit("A").alias("source_account_id"),
        F.lit("TRANSFER").alias("transaction_type"),
        F.lit("ATM").alias("channel"),
        (cents.cast("decimal(18,2)") / 100).cast("decimal(18,2)").alias("amount"),
        F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(cast(id % 30 as int))").alias("transaction_ts"),
    )
    state = P.measure(data)
    assert state.count() == 30
    got = P.value_percentiles(state, "transaction_type").first()
    for rank, value in ((0.5, got["median_value"]), (0.95, got["p95_value"])):
        assert abs(float(value) * 100 / rows - rank) <= 2 * P.RANK_ERROR, (rank, value)
    distinct = P.metrics(state).first()["distinct_ids"]
    assert abs(distinct - rows) <= 0.03 * rows
    assert max(len(r[0]) for r in P.merged(state, "transaction_type").select("amount_sketch").collect()) < 200_000


def test_published_percentiles_do_not_read_the_fact(spark, space):
    shown = P.value_percentiles(space.now.profile(), "transaction_type")
    assert all("/fact_profile/" in path for path in shown.inputFiles())
    got = {r["transaction_type"]: r for r in shown.collect()}
    cut = F.sum(F.expr("int(amount <= cut)")) / F.count("amount")
    for name, row in got.items():
        some = space.fact.filter(F.col("transaction_type") == name)
        for rank, column in ((0.5, "median_value"), (0.95, "p95_value")):
            reached = some.withColumn("cut", F.lit(row[column])).agg(cut).first()[0]
            assert reached >= rank - 2 * P.RANK_ERROR
        assert row["txn_count"] == some.count()


def test_percentiles_of_large_groups_are_exact(spark):
    """A group above the sketch's size, one with no key, and a small one, each against a sorted list."""
    wide, lone = 3 * P.SKETCH_ROWS + 7, P.SKETCH_ROWS + 1
    amounts = {"TRANSFER": [(i * 7919) % wide for i in range(wide)], None: [i // 3 for i in range(lone)], "DEBIT": [5, 1, 9]}
    data = [(name, Decimal(v)) for name, values in amounts.items() for v in values] + [("TRANSFER", None)]
    rows = spark.createDataFrame(data, "transaction_type string, amount decimal(18,2)").withColumns(
        {
            "transaction_id": F.lit("T"),
            "source_account_id": F.lit("A"),
            "channel": F.lit("ATM"),
            "transaction_ts": F.lit("2024-01-05 10:00:00").cast("timestamp_ntz"),
            "transaction_date": F.lit("2024-01-05").cast("date"),
        }
    )
    found = P.exact_percentiles(P.measure(rows), rows, *P.BY).collect()
    assert len(found) == 3
    for row in found:
        values = sorted(amounts[row["transaction_type"]])
        cut = {r: values[-(-len(values) * r // 100) - 1] for r in (50, 95)}
        assert (row["median_value"], row["p95_value"]) == (cut[50], cut[95])
        assert row["txn_count"] == len(values) + (row["transaction_type"] == "TRANSFER")
