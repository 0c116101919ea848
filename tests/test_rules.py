import datetime as dt
from decimal import Decimal

from brassledger import contracts as K
from brassledger.operators import quality, rules

AS_OF = dt.datetime(2024, 2, 1)
DDL = (
    "transaction_id string, transaction_ts timestamp_ntz, source_account_id string, transaction_type string, "
    "amount decimal(18,2), channel string, transaction_status string"
)


def row(i, **change):
    base = {
        "transaction_id": f"T{i}",
        "transaction_ts": dt.datetime(2024, 1, 1),
        "source_account_id": "A1",
        "transaction_type": "DEBIT",
        "amount": Decimal("1.00"),
        "channel": "POS",
        "transaction_status": "POSTED",
    }
    return tuple({**base, **change}[c] for c in K.RULE_COLUMNS)


def outcomes(spark, rows, **kw):
    df = spark.createDataFrame(rows, DDL)
    return rules.evaluate(df, "d", "r", AS_OF, AS_OF, **kw)


def failed(frame):
    return {r["rule"].split('"')[0].strip() + " " + (r["rule"].split('"')[1] if '"' in r["rule"] else "") for r in frame.collect() if r["outcome"] == "Failed"}


def test_clean_data_passes_all(spark):
    out = outcomes(spark, [row(i) for i in range(1001)])
    assert out.count() == 12
    assert failed(out) == set()
    assert rules.score(out).first()["score"] == 1.0


def test_row_count_is_exclusive(spark):
    assert failed(outcomes(spark, [row(i) for i in range(1000)])) == {"RowCount > 1000 "}


def test_null_under_column_values(spark):
    rows = [row(i) for i in range(2000)] + [row(5000, channel=None)]
    assert failed(outcomes(spark, rows)) == {"IsComplete channel"}
    assert failed(outcomes(spark, rows, null_fails=True)) == {"IsComplete channel", "ColumnValues channel"}


def test_each_breach_is_reported_with_its_number(spark):
    rows = [row(i) for i in range(1200)]
    rows += [row(1), row(7000, amount=Decimal("0.00")), row(7001, transaction_ts=dt.datetime(2030, 1, 1))]
    rows += [row(7002, transaction_status="GONE"), row(None, transaction_id=None)]
    by_rule = {r["rule"]: r for r in outcomes(spark, rows).collect()}
    assert by_rule['IsUnique "transaction_id"']["evaluated_metrics"] == '{"repeated":1}'
    assert by_rule['IsComplete "transaction_id"']["failure_reason"] == "1 rows without transaction_id"
    assert by_rule['ColumnValues "amount" > 0']["outcome"] == "Failed"
    assert sum(r["outcome"] == "Failed" for r in by_rule.values()) == 5


def test_empty_data(spark):
    out = outcomes(spark, [])
    assert failed(out) == {"RowCount > 1000 ", "Completeness channel"}
    nothing = spark.createDataFrame([], "dq_fail_reasons array<string>")
    totals = quality.row_totals(nothing).first()
    assert (totals["raw_rows"], totals["quarantine_rate"]) == (0, 0.0)


def test_score_of_no_rules_is_zero(spark):
    assert rules.score(outcomes(spark, [row(1)]).limit(0)).first()["score"] == 0.0


def test_own_rule_set(spark):
    mine = (rules.Rule("complete", "amount"), rules.Rule("sql", query="select count(*) from primary where amount > 5"))
    out = outcomes(spark, [row(1), row(2, amount=Decimal("9"))], rules=mine)
    assert [(r["outcome"], r["failure_reason"]) for r in out.collect()] == [
        ("Passed", None),
        ("Failed", "query returned 1"),
    ]
