"""Known defects for the fixtures: what tests plant in rows, and how much of it.

Every choice depends on a row's own number, so it needs no row order, repeats
exactly, and runs without a shuffle.  Nothing here is registered or part of a run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brassledger.functions import columns as C

# --- fixed values: defect kinds, and the residues (row number modulo 2000) that
# carry them; 4 residues are a rate of 0.002
CYCLE = 2000
RESIDUES = {
    "NULL_TXN_ID": (0, 0),
    "NULL_ACCOUNT": (1, 4),
    "ORPHAN_ACCOUNT": (5, 8),
    "NON_POSITIVE_AMOUNT": (9, 12),
    "INVALID_TYPE": (13, 15),
    "FUTURE_TIMESTAMP": (16, 18),
    "INVALID_TIMESTAMP": (19, 19),
    "NULL_CHANNEL": (20, 24),
    "DUPLICATE_TXN_ID": (25, 31),
}
NEAR_COPIES = (25, 27)
FIRST_CLEAN = 32
FUTURE_YEAR = "2028"
BAD_TYPES = ("UNKNOWN", "XFER", "CHARGEBACK")
BAD_TIMESTAMPS = ("not-a-date", "31/13/2025 25:61", "2025-02-30 10:00:00")
BAD_STATUSES = ("ACTV", "UNKNOWN", "")
# Kinds the standard injection leaves out; used to exercise the remaining checks.
EXTRA_RESIDUES = {"INVALID_AMOUNT": (32, 33), "INVALID_CHANNEL": (34, 35), "INVALID_STATUS": (36, 38)}

# Rows delivered under another column layout: two fields short, or one too many.
LINE_RESIDUES = {"short": (40, 41), "long": (42, 43)}


def _residue(number: str) -> Column:
    return F.pmod(F.col(number), F.lit(CYCLE))


def _has(number: str, span: tuple[int, int]) -> Column:
    return _residue(number).between(*span)


def _choice(number: Column, options) -> Column:
    picked = F.lit(options[-1])
    for i, option in list(enumerate(options))[:-1]:
        picked = F.when(number == i, F.lit(option)).otherwise(picked)
    return picked


def defect_kind(number: str, residues: dict[str, tuple[int, int]] = RESIDUES) -> Column:
    """The one defect a row carries, or NULL.  Residue spans do not overlap."""
    kind = F.lit(None).cast("string")
    for name, span in residues.items():
        kind = F.when(_has(number, span), name).otherwise(kind)
    return kind


def add_cosmetic_noise(txns: DataFrame, number: str) -> DataFrame:
    """Case and padding only; standardising must undo all of it."""
    n, channel = F.col(number), F.col("channel")
    clean = _residue(number) >= FIRST_CLEAN
    turn = F.pmod(n, F.lit(40))
    noisy_channel = (
        F.when(clean & (turn == 7), F.concat(F.lit(" "), F.lower(channel), F.lit(" ")))
        .when(clean & (turn == 27), F.initcap(channel))
        .otherwise(channel)
    )
    kind = F.col("transaction_type")
    noisy_kind = F.when(clean & (turn == 11), F.lower(kind)).otherwise(kind)
    return txns.withColumns({"channel": noisy_channel, "transaction_type": noisy_kind})


def break_rows(txns: DataFrame, number: str) -> DataFrame:
    """The eight in-place defects, on disjoint rows."""
    n, r = F.col(number), _residue(number)
    ts, amount = F.col("transaction_timestamp"), F.col("amount")

    def on(kind, value, column):
        return F.when(_has(number, RESIDUES[kind]), value).otherwise(column)

    account = on("NULL_ACCOUNT", F.lit(""), F.col("source_account_id"))
    stray = C.padded("ACC9", F.pmod(n, F.lit(1_000_000)), 6)
    first = RESIDUES["INVALID_TYPE"][0]
    not_positive = F.when(r == RESIDUES["NON_POSITIVE_AMOUNT"][0], F.lit("0")).otherwise(F.concat(F.lit("-"), amount))
    moved = on("FUTURE_TIMESTAMP", F.overlay(ts, F.lit(FUTURE_YEAR), 1, 4), ts)
    return txns.withColumns(
        {
            "transaction_id": on("NULL_TXN_ID", F.lit(""), F.col("transaction_id")),
            "source_account_id": on("ORPHAN_ACCOUNT", stray, account),
            "amount": on("NON_POSITIVE_AMOUNT", not_positive, amount),
            "transaction_type": on("INVALID_TYPE", _choice(r - first, BAD_TYPES), F.col("transaction_type")),
            "transaction_timestamp": on("INVALID_TIMESTAMP", _choice(F.pmod(n, F.lit(3)), BAD_TIMESTAMPS), moved),
            "channel": on("NULL_CHANNEL", F.lit(""), F.col("channel")),
        }
    )


def break_more(txns: DataFrame, number: str) -> DataFrame:
    """Amounts, channels and statuses outside their domains, on further rows."""
    n = F.col(number)

    def on(kind, options, column):
        bad = _choice(F.pmod(n, F.lit(len(options))), options)
        return F.when(_has(number, EXTRA_RESIDUES[kind]), bad).otherwise(F.col(column))

    return txns.withColumns(
        {
            "amount": on("INVALID_AMOUNT", ("12,50", "abc"), "amount"),
            "channel": on("INVALID_CHANNEL", ("FAX", "KIOSK"), "channel"),
            "transaction_status": on("INVALID_STATUS", ("PENDING", ""), "transaction_status"),
        }
    )


def copies(txns: DataFrame, number: str) -> DataFrame:
    """Second deliveries: some a minute later, the others exact."""
    again = txns.filter(_has(number, RESIDUES["DUPLICATE_TXN_ID"]))
    ts = F.col("transaction_timestamp")
    later = F.timestamp_add("SECOND", F.lit(60), ts.cast("timestamp_ntz")).cast("string")
    return again.withColumn("transaction_timestamp", F.when(_has(number, NEAR_COPIES), later).otherwise(ts))


def inject_defects(txns: DataFrame, number: str) -> DataFrame:
    """Noise, in-place defects, and appended copies."""
    broken = break_rows(add_cosmetic_noise(txns, number), number)
    return broken.unionByName(copies(broken, number))


def inject_account_defects(accounts: DataFrame, number: str) -> DataFrame:
    """A status outside the domain on 3 rows in 1000."""
    r = F.pmod(F.col(number), F.lit(1000))
    bad = F.when(r < len(BAD_STATUSES), _choice(r, BAD_STATUSES)).otherwise(F.col("account_status"))
    return accounts.withColumn("account_status", bad)


def defect_manifest(txns: DataFrame, number: str) -> DataFrame:
    """Injected rows per kind (ground truth), counted on the clean rows."""
    kinds = txns.select(defect_kind(number).alias("defect")).filter(F.col("defect").isNotNull())
    return kinds.groupBy("defect").agg(F.count(F.lit(1)).alias("defect_rows"))


def corrupt(events: DataFrame, pick: Column) -> DataFrame:
    """Test-data job: break an event in one of four ways where `pick` is 0..3, else keep it."""
    nothing = F.lit(None).cast("string")
    return events.withColumns(
        {
            "source_account_id": F.when(pick == 0, nothing).otherwise(F.col("source_account_id")),
            "amount": F.when(pick == 1, F.concat(F.lit("-"), F.col("amount"))).otherwise(F.col("amount")),
            "transaction_type": F.when(pick == 2, "UNKNOWN").otherwise(F.col("transaction_type")),
            "channel": F.when(pick == 3, nothing).otherwise(F.col("channel")),
        }
    )


def layout_kind(number: str) -> Column:
    """'short' or 'long' for rows to be delivered under another layout, else NULL."""
    return defect_kind(number, LINE_RESIDUES)


def hashed_pick(key: Column, per_thousand: int) -> Column:
    """Which of the four ways, for about `per_thousand` of 1000 events; NULL for the others."""
    h = F.pmod(F.xxhash64(key), F.lit(1000))
    return F.when(h < per_thousand, F.pmod(F.xxhash64(key, F.lit("way")), F.lit(4)))
