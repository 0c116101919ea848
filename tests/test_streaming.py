import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger import fixture_defects as D
from brassledger.sources import files
from brassledger.streaming import events as E
from brassledger.streaming import landing

DAY = dt.date(2024, 2, 1)


@pytest.mark.parametrize(
    ("value", "bad"),
    [
        ('{"transaction_id": "T1"}', False),
        ("{}", False),
        ('{"transaction_id": null, "unknown": 1}', False),
        ("{bad", True),
        ("[1]", True),
        ('[{"transaction_id": "T1"}]', True),
        ('"text"', True),
        ("5", True),
        ("", True),
        (None, True),
    ],
)
def test_what_is_undecodable(spark, value, bad):
    row = E.decode(spark.createDataFrame([(value,)], "value string")).first()
    assert row[E.BAD] is bad


def test_missing_and_null_become_blank_and_numbers_text(spark):
    value = json.dumps({"transaction_id": None, "amount": 12.5, "channel": " pos "})
    row = E.decode(spark.createDataFrame([(value,)], "value string")).first()
    assert (row["transaction_id"], row["amount"], row["channel"], row["branch_id"]) == ("", "12.5", " pos ", "")


def test_encode_decode_round_trip(spark):
    rows = spark.createDataFrame([tuple("" if i % 3 else f'v"{i},' for i in range(13))], K.text_schema(K.RAW_TRANSACTION))
    back = E.decode(E.blank_to_null(rows).select(E.encode(rows).alias("value")))
    assert tuple(back.drop(E.BAD).first()) == tuple(rows.first())


def test_key_prefers_account_then_id_then_number(spark):
    rows = spark.createDataFrame([("A", "T", 1), ("", "T", 2), (None, "", 3)], "source_account_id string, transaction_id string, n int")
    assert [r["k"] for r in rows.select(E.event_key(F.col("n")).alias("k")).collect()] == ["A", "T", "3"]


def test_hashed_pick_hits_about_its_share(spark):
    picks = spark.range(20_000).select(D.hashed_pick(F.col("id").cast("string"), 20).alias("p")).filter("p is not null")
    by_way = {r["p"]: r["count"] for r in picks.groupBy("p").count().collect()}
    assert set(by_way) == {0, 1, 2, 3} and 300 < sum(by_way.values()) < 500


def test_landing_resumes_and_lands_once(spark, tmp_path):
    source, root, metrics, state = (str(tmp_path / n) for n in ("in", "raw", "metrics", "state"))

    def deliver(name, ids):
        lines = [json.dumps({"transaction_id": i, "amount": "1"}) for i in ids] + ["{bad"]
        spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.mode("append").text(source)

    def drain():
        stream = landing.read_events(spark, source, files_per_batch=1)
        landing.land(stream, root, metrics, state, DAY).awaitTermination()

    deliver("a", ["T1", "T2"])
    drain()
    drain()  # nothing new
    deliver("b", ["T3"])
    drain()
    landed = files.read_raw(spark, root, K.RAW_TRANSACTION)
    assert sorted(r["transaction_id"] for r in landed.collect()) == ["T1", "T2", "T3"]
    per_batch = landing.read_metrics(spark, metrics).orderBy("batch_id").collect()
    assert [tuple(r) for r in per_batch] == [(0, 3, 2, 1), (1, 2, 1, 1)]
    assert landed.filter(F.col("source_file").contains("source=stream/ingest_date=2024-02-01/batch=")).count() == 3
    assert landed.filter(~F.col("source_file").endswith(".csv.gz")).count() == 0


def test_a_batch_that_runs_again_lands_once(spark, tmp_path):
    """Losing the checkpoint replays batch 0 over its own folder."""
    source, root, metrics = (str(tmp_path / n) for n in ("in", "raw", "metrics"))
    spark.createDataFrame([('{"transaction_id": "T1"}',)], "value string").write.text(source)
    for state in ("state-1", "state-2"):
        stream = landing.read_events(spark, source)
        landing.land(stream, root, metrics, str(tmp_path / state), DAY).awaitTermination()
    assert files.read_raw(spark, root, K.RAW_TRANSACTION).count() == 1
    assert landing.read_metrics(spark, metrics).count() == 1
