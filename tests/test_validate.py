"""Row checks and repeats on small frames, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger.operators import enrich, standardise, validate

AS_OF = dt.datetime(2024, 2, 1)
GOOD = {
    "transaction_id": "T1",
    "transaction_timestamp": "2024-01-01 10:00:00",
    "source_account_id": "A1",
    "counterparty_id": "C1",
    "transaction_type": "DEPOSIT",
    "amount": "10.00",
    "channel": "ATM",
    "merchant_category": "",
    "branch_id": "",
    "transaction_status": "POSTED",
    "balance_before": "0",
    "balance_after": "10",
    "is_fraud_flag": "0",
    "source_file": "raw/source=batch/a.csv",
}


def raw(spark, rows):
    names = [*K.RAW_TRANSACTION, "source_file"]
    return spark.createDataFrame([tuple({**GOOD, **r}[n] for n in names) for r in rows], K.text_schema(names))


def master(spark, ids=("A1", "A2")):
    rows = [(i, f"C{i}", "CHECKING", None, "ACTIVE", None) for i in ids]
    return spark.createDataFrame(rows, K.layout(K.ACCOUNT_DDL))


def flagged(spark, rows, **kw):
    checked = validate.check_rows(standardise.transactions(raw(spark, rows)), master(spark), AS_OF)
    return validate.mark_repeats(checked, **kw)


@pytest.mark.parametrize(
    ("change", "reasons"),
    [
        ({}, []),
        ({"transaction_id": "  "}, ["NULL_TXN_ID"]),
        ({"source_account_id": ""}, ["NULL_ACCOUNT"]),
        ({"source_account_id": "A9"}, ["ORPHAN_ACCOUNT"]),
        ({"source_account_id": " a2 "}, []),
        ({"amount": "abc"}, ["INVALID_AMOUNT"]),
        ({"amount": "0"}, ["NON_POSITIVE_AMOUNT"]),
        ({"amount": "-0.01"}, ["NON_POSITIVE_AMOUNT"]),
        ({"transaction_timestamp": "2024-01-01"}, ["INVALID_TIMESTAMP"]),
        ({"transaction_timestamp": "2024-02-01 00:00:01"}, ["FUTURE_TIMESTAMP"]),
        ({"transaction_timestamp": "2024-02-01 00:00:00"}, []),
        ({"transaction_type": "GIFT"}, ["INVALID_TYPE"]),
        ({"transaction_type": ""}, ["INVALID_TYPE"]),
        ({"channel": ""}, ["NULL_CHANNEL"]),
        ({"channel": "FAX"}, ["INVALID_CHANNEL"]),
        ({"channel": " mobile "}, []),
        ({"transaction_status": None}, ["INVALID_STATUS"]),
        ({"transaction_status": "PENDING"}, ["INVALID_STATUS"]),
        (
            {"transaction_id": "", "source_account_id": "", "amount": "x", "channel": "", "transaction_type": "?"},
            ["NULL_TXN_ID", "NULL_ACCOUNT", "INVALID_AMOUNT", "INVALID_TYPE", "NULL_CHANNEL"],
        ),
    ],
)
def test_reasons(spark, change, reasons):
    assert flagged(spark, [change]).first()["dq_fail_reasons"] == reasons


def test_several_reasons_count_separately(spark):
    f = flagged(spark, [{"channel": "", "amount": "x"}, {"channel": ""}])
    held = validate.quarantined_rows(f, "r", AS_OF)
    counts = {r["reason"]: r["row_count"] for r in validate.reason_counts(held, "r", AS_OF).collect()}
    assert counts == {"INVALID_AMOUNT": 1, "NULL_CHANNEL": 2}
    assert held.count() == 2


def test_duplicate_accounts_do_not_multiply_rows(spark):
    accounts = standardise.accounts(
        spark.createDataFrame(
            [
                ("A1", "C1", "CHECKING", "2020-01-01", "ACTIVE", "1"),
                ("a1 ", "C2", "SAVINGS", "2021-01-01", "bogus", "2"),
                ("", "C3", "SAVINGS", "2021-01-01", "ACTIVE", "2"),
            ],
            K.text_schema(K.RAW_ACCOUNT),
        )
    )
    known = standardise.account_master(accounts)
    assert [(r["account_id"], r["customer_id"]) for r in known.collect()] == [("A1", "C2")]
    assert [(r["account_id"], r["customer_id"]) for r in standardise.valid_accounts(accounts).collect()] == [("A1", "C1")]
    bad = standardise.rejected_accounts(accounts, "r", AS_OF).collect()
    assert sorted(r["dq_fail_reason"] for r in bad) == ["INVALID_ACCOUNT_STATUS", "NULL_ACCOUNT_ID"]
    checked = validate.check_rows(standardise.transactions(raw(spark, [{}, {"transaction_id": "T2"}])), known, AS_OF)
    fact = enrich.fact_rows(validate.valid_rows(validate.mark_repeats(checked)), "r")
    assert sorted((r["transaction_id"], r["customer_id"]) for r in fact.collect()) == [("T1", "C2"), ("T2", "C2")]


def expected_survivors(rows):
    """Brute force: newest timestamp, then file, among good rows of an id."""
    best = {}
    for r in rows:
        if r["channel"] == "":
            continue
        best.setdefault(r["transaction_id"], []).append(r)
    out = []
    for versions in best.values():
        newest = max(v["transaction_timestamp"] for v in versions)
        file = min(v["source_file"] for v in versions if v["transaction_timestamp"] == newest)
        out.append((versions[0]["transaction_id"], newest, file))
    return sorted(out)


@pytest.mark.parametrize("lane_rows", [1, 7, 1_000_000])
def test_repeats_with_a_hot_id_match_brute_force(spark, lane_rows):
    """A third of all rows share one id, most of them exact copies."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        hot = i % 3 == 0
        rows.append(
            {
                "transaction_id": "HOT" if hot else f"T{rng.randrange(400)}",
                "transaction_timestamp": f"2024-01-01 10:00:{rng.randrange(3):02d}",
                "source_file": f"raw/source=batch/{rng.choice('ab')}.csv",
                "channel": "" if rng.random() < 0.1 else "ATM",
            }
        )
    df = flagged(spark, rows, lane_rows=lane_rows)
    assert df.count() == len(rows)
    kept = validate.valid_rows(df).select("transaction_id", F.col("transaction_ts").cast("string").alias("ts"), "source_file")
    assert sorted(tuple(r) for r in kept.collect()) == expected_survivors(rows)
    good = sum(r["channel"] != "" for r in rows)
    repeats = df.filter(F.array_contains("dq_fail_reasons", "DUPLICATE_TXN_ID")).count()
    assert repeats == good - len(expected_survivors(rows))


def test_rows_without_account_survive_the_lookup(spark):
    """A third of the rows without account, all alike: none is lost or matched."""
    rows = [{"transaction_id": f"T{i}", "source_account_id": "" if i % 3 == 0 else "A1"} for i in range(300)]
    out = validate.with_owner(standardise.transactions(raw(spark, rows)), master(spark))
    assert out.count() == 300
    assert out.filter(F.col("owner").isNull()).count() == 100


def test_filler_keys_never_match(spark):
    """Even an account that looks like a filler does not attract rows without account."""
    fillers = [f"~{i}" for i in range(4096)]
    out = validate.with_owner(
        standardise.transactions(raw(spark, [{"source_account_id": ""}])), master(spark, fillers)
    )
    assert out.first()["owner"] is None
