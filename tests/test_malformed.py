"""Lines with too few or too many fields: kept whole, one reason, nothing lost, in files that mix them with good ones."""

import datetime as dt
import gzip

import pytest
from test_validate import GOOD, master

from brassledger import contracts as K
from brassledger.operators import quality, standardise, validate
from brassledger.plans.run import Lake, RawZone, Settings, publish
from brassledger.sources import files

AS_OF = dt.datetime(2024, 2, 1)
HEADER = ",".join(K.RAW_TRANSACTION)


def line(**change):
    return ",".join({**GOOD, **change}[c] for c in K.RAW_TRANSACTION)


SHORT = ",".join(line(transaction_id="T2").split(",")[:-3])
LONG = line(transaction_id="T3", amount="12,50")  # a comma that should have been quoted
QUOTED = line(transaction_id="T4", counterparty_id='"C,4"')
BLANKS = line(transaction_id="T5", balance_before="", balance_after="", is_fraud_flag="")
BROKEN_QUOTE = 'T6,"2024-01-01 10:00:00'
LINES = [line(), SHORT, LONG, "", QUOTED, BLANKS, ",", BROKEN_QUOTE, SHORT, SHORT]
MALFORMED = sorted([SHORT, LONG, ",", BROKEN_QUOTE, SHORT, SHORT])


@pytest.fixture()
def folder(tmp_path):
    for source, lines in {"batch": LINES, "stream": [line(transaction_id="T7"), SHORT]}.items():
        target = tmp_path / "transactions" / f"source={source}"
        target.mkdir(parents=True)
        with gzip.open(target / "part-0.csv.gz", "wt") as out:
            out.write("\n".join([HEADER, *lines]) + "\n")
    return tmp_path


def read(spark, folder):
    return files.read_raw(spark, f"{folder}/transactions", K.RAW_TRANSACTION, keep_malformed=True)


def zone(spark, folder):
    accounts = spark.createDataFrame([("A1", "CA1", "CHECKING", "2020-01-01", "ACTIVE", "1")], K.text_schema(K.RAW_ACCOUNT))
    return RawZone(
        read(spark, folder),
        accounts,
        spark.createDataFrame([], K.text_schema(K.RAW_CUSTOMER)),
        spark.createDataFrame([], K.text_schema(K.RAW_BRANCH)),
    )


def test_only_lines_that_do_not_fit_are_kept(spark, folder):
    rows = read(spark, f"{folder}").collect()
    assert sorted(r.malformed_line for r in rows if r.malformed_line is not None) == sorted([*MALFORMED, SHORT])
    assert sorted(r.transaction_id for r in rows if r.malformed_line is None) == ["T1", "T4", "T5", "T7"]
    assert [r.counterparty_id for r in rows if r.transaction_id == "T4"] == ["C,4"]


def test_reading_without_them_is_as_before(spark, folder):
    rows = files.read_raw(spark, f"{folder}/transactions", K.RAW_TRANSACTION)
    assert rows.columns == [*K.RAW_TRANSACTION, "source_file"]
    assert rows.count() == 11


def test_one_reason_and_no_shifted_values(spark, folder):
    std = standardise.transactions(read(spark, folder))
    checked = validate.check_rows(std, master(spark), AS_OF)
    bad = validate.mark_repeats(checked).filter(f"{K.RAW_LINE} IS NOT NULL").drop(validate.LANE, "owner")
    kept = {"ingest_source", "source_file", K.RAW_LINE, validate.REASON_COLUMN}
    rows = [r.asDict() for r in bad.collect()]
    assert len(rows) == 7
    assert all(r[validate.REASON_COLUMN] == ["MALFORMED_LINE"] for r in rows)
    assert all(v is None for r in rows for c, v in r.items() if c not in kept)


def test_good_rows_are_judged_as_without_the_column(spark, folder):
    raw = read(spark, folder).filter(f"{K.RAW_LINE} IS NULL")
    judged = []
    for rows in (raw, raw.drop(K.RAW_LINE)):
        flagged = validate.flag(standardise.transactions(rows), master(spark), AS_OF).drop(validate.LANE, K.RAW_LINE)
        judged.append(sorted(map(str, flagged.collect())))
    assert judged[0] == judged[1]


def test_published_counted_and_reconciled(spark, folder):
    lake = Lake(spark, f"{folder}/lake")
    row = publish(zone(spark, folder), Settings(AS_OF, max_quarantine_rate=0.9), lake)
    now = lake.snapshot()
    assert (row["raw_rows"], row["quarantined_rows"], row["curated_rows"]) == (11, 7, 4)
    lines = now.malformed_lines().collect()
    assert sorted(r.malformed_line for r in lines) == sorted([*MALFORMED, SHORT])
    assert {r.run_id for r in lines} == {"20240201T000000Z"}
    counts = {(r.reason, r.ingest_source): r.row_count for r in now.reasons().collect()}
    assert counts == {("MALFORMED_LINE", "BATCH"): 6, ("MALFORMED_LINE", "STREAM"): 1}
    assert now.quarantined().columns == K.layout_columns(K.QUARANTINE_DDL)
    card = {r.rule_code: r.failing_rows for r in quality.scorecard(now.summary(), now.reasons()).collect()}
    assert card["MALFORMED_LINE"] == 7
    assert set(card) == {*K.REASONS, *K.LINE_REASONS}
    delivered = standardise.transactions(read(spark, folder).drop(K.RAW_LINE))
    balance = quality.line_reconciliation(delivered, now.malformed_lines(), now.quarantined(), now.fact())
    assert {tuple(r) for r in balance.collect()} == {("BATCH", 9, 6, 0, 3, 0), ("STREAM", 2, 1, 0, 1, 0)}


def test_many_malformed_lines_trip_the_gate(spark, folder):
    lake = Lake(spark, f"{folder}/lake")
    with pytest.raises(quality.QualityGateBlocked):
        publish(zone(spark, folder), Settings(AS_OF), lake)
    path = lake.quarantine("20240201T000000Z", "malformed_lines")
    assert files.read_table(spark, path, K.MALFORMED_DDL).count() == 7  # kept, whatever the gate says


def test_frames_without_the_column_have_no_malformed_lines(spark, folder):
    raw = read(spark, folder).filter(f"{K.RAW_LINE} IS NULL").drop(K.RAW_LINE)
    flagged = validate.flag(standardise.transactions(raw), master(spark), AS_OF)
    lines = validate.malformed_lines(flagged, "r", AS_OF)
    assert lines.columns == K.layout_columns(K.MALFORMED_DDL)
    assert lines.count() == 0


def test_the_scorecard_names_them_only_where_they_occur(spark):
    summary = spark.createDataFrame([("r", AS_OF, 10)], "run_id string, run_ts timestamp_ntz, raw_rows bigint")
    none = spark.createDataFrame([], K.layout(K.REASON_COUNT_DDL))
    codes = {r.rule_code for r in quality.scorecard(summary, none).collect()}
    assert codes == set(K.REASONS)
