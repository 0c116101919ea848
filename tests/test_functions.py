import datetime as dt

import pytest
from pyspark.sql import functions as F

from brassledger.functions import columns as C


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "c string").select(fn("c").alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("value", "expected"),
    [(" atm ", "ATM"), ("", None), ("   ", None), (None, None), ("\tatm", "\tATM")],
)
def test_code_trims_blanks_only(spark, value, expected):
    assert one(spark, value, C.code) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("2025-02-28 10:00:00", dt.datetime(2025, 2, 28, 10)),
        ("  2025-02-28 10:00:00 ", dt.datetime(2025, 2, 28, 10)),
        ("2025-02-30 10:00:00", None),
        ("2025-02-28", None),
        ("2025-02-28T10:00:00", None),
        ("2025-02-28 10:00:00.5", None),
        ("2025-1-1 10:00:00.1", None),
        ("2025-02-28 25:00:00", None),
        ("31/13/2025 25:61", None),
        ("", None),
        (None, None),
    ],
)
def test_timestamp_is_strict_and_lenient(spark, value, expected):
    assert one(spark, value, C.timestamp) == expected


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parsing_ignores_session_settings(spark, ansi, zone):
    before = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled", "spark.sql.session.timeZone")}
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        spark.conf.set("spark.sql.session.timeZone", zone)
        # 02:30 does not exist in New York on that day
        assert one(spark, "2025-03-09 02:30:00", C.timestamp) == dt.datetime(2025, 3, 9, 2, 30)
        assert one(spark, "nonsense", C.timestamp) is None
        assert one(spark, "12,5", C.money) is None
        assert one(spark, "x", C.integer) is None
        assert one(spark, "2025-02-30", C.date) is None
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize(
    ("value", "expected"),
    [("1.005", "1.01"), ("1e3", "1000.00"), (" 7 ", "7.00"), ("abc", None), ("99999999999999999", None)],
)
def test_money(spark, value, expected):
    got = one(spark, value, C.money)
    assert (None if got is None else str(got)) == expected


def test_padded_keeps_long_numbers(spark):
    row = spark.range(1).select(
        C.padded("A", F.lit(7), 3).alias("short"), C.padded("A", F.lit(123456), 3).alias("long")
    ).first()
    assert (row["short"], row["long"]) == ("A007", "A123456")


def test_whole_hours_are_elapsed_hours(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 30), dt.datetime(2024, 1, 1, 5, 20))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(C.whole_hours("a", "b").alias("h")).first()["h"] == 4
