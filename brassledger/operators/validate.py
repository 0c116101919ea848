"""Row checks with reason codes, owner lookup, repeats, and the valid/quarantine split."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger.functions import columns as C
from brassledger.operators.standardise import instant

REASON_COLUMN = "dq_fail_reasons"
LANE = "_lane"
CLOCK_REASON = "FUTURE_TIMESTAMP"


def _outside(name: str, domain) -> Column:
    return ~F.col(name).isin(*domain)


def row_checks(as_of: dt.datetime | None) -> dict[str, Column]:
    """Reason code -> failing condition, in reporting order; without a clock nothing lies in the future.

    A condition that evaluates to NULL adds no reason.  `owner` is the struct
    `with_owner` adds; NULL there means the account is not in the master.
    """
    account, ts, amount = F.col("source_account_id"), F.col("transaction_ts"), F.col("amount")
    kind, channel, status = F.col("transaction_type"), F.col("channel"), F.col("transaction_status")
    return {
        "NULL_TXN_ID": F.col("transaction_id").isNull(),
        "NULL_ACCOUNT": account.isNull(),
        "ORPHAN_ACCOUNT": account.isNotNull() & F.col("owner").isNull(),
        "INVALID_AMOUNT": amount.isNull(),
        "NON_POSITIVE_AMOUNT": amount <= 0,
        "INVALID_TIMESTAMP": ts.isNull(),
        CLOCK_REASON: F.lit(False) if as_of is None else ts > instant(as_of),
        "INVALID_TYPE": kind.isNull() | _outside("transaction_type", K.TRANSACTION_TYPES),
        "NULL_CHANNEL": channel.isNull(),
        "INVALID_CHANNEL": _outside("channel", K.CHANNELS),
        "INVALID_STATUS": status.isNull() | _outside("transaction_status", K.TRANSACTION_STATUSES),
    }


def reason_array(checks: dict[str, Column]) -> Column:
    """The codes of all failing checks, in order; an empty array for a good row.

    `concat_ws` skips the NULLs of the passing checks and, unlike a lambda over
    an array, keeps the whole stage compiled; only bad rows pay for the split.
    """
    found = F.concat_ws(",", *[F.when(failing, F.lit(reason)) for reason, failing in checks.items()])
    return F.when(found == "", F.array().cast("array<string>")).otherwise(F.split(found, ","))


def found_reasons(rows: DataFrame, as_of: dt.datetime | None) -> Column:
    """The reasons of every row; a malformed line has that one reason, since it has no values to check."""
    found = reason_array(row_checks(as_of))
    if K.RAW_LINE not in rows.columns:
        return found
    return F.when(F.col(K.RAW_LINE).isNotNull(), F.array(*map(F.lit, K.LINE_REASONS))).otherwise(found)


def with_owner(txns: DataFrame, master: DataFrame) -> DataFrame:
    """Left lookup of the account owner as one struct column `owner`.

    `master` has one row per account id, so rows never multiply.  The lookup
    serves the orphan test and the later enrichment, which makes it the only
    join of the whole fact with the account table.  Whether it broadcasts is
    left to the size the planner sees; beyond that it is a shuffled join whose
    rows without an account are spread, and whose hot accounts AQE splits.
    """
    owner = master.select(
        F.col("account_id").alias("_account"),
        F.struct("account_id", "customer_id", "account_type").alias("owner"),
    )
    has_account = F.col("source_account_id").isNotNull()
    plain = [c for c in txns.columns if c != LANE]
    keyed = txns.withColumn("_key", C.spread(F.col("source_account_id"), has_account, plain))
    on = (F.col("_key") == F.col("_account")) & has_account
    return keyed.join(owner, on, "left").drop("_key", "_account")


def check_rows(std: DataFrame, master: DataFrame, as_of: dt.datetime | None) -> DataFrame:
    """All checks that need one row only, plus the owner.  Repeats come later.

    Without `as_of` the checks against the clock are left for `check_clock`, and what comes out serves every run over
    the same raw files and masters.
    """
    # The lane is taken before any shuffle, so a task that runs twice numbers
    # its rows alike.  It only serves to split large groups of copies.
    laned = std.withColumn(LANE, F.monotonically_increasing_id())
    return with_owner(laned, master).withColumn(REASON_COLUMN, found_reasons(std, as_of))


def check_clock(checked: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Rows checked without a clock, with the reason of those that lie in its future put in its place among the others.

    A short expression, unlike all the checks: it is repeated by every output that reads the rows.
    """
    codes = F.array(*map(F.lit, row_checks(as_of)))  # the intersection keeps their order
    with_future = F.array_intersect(codes, F.array_append(REASON_COLUMN, F.lit(CLOCK_REASON)))
    late = F.col("transaction_ts") > instant(as_of)
    return checked.withColumn(REASON_COLUMN, F.when(late, with_future).otherwise(F.col(REASON_COLUMN)))


def _row_ok() -> Column:
    return F.size(REASON_COLUMN) == 0


def repeated_ids(checked: DataFrame) -> DataFrame:
    """Ids that several good rows share, with their number.  Counts combine on the map side."""
    counts = checked.filter(_row_ok()).groupBy(F.col("transaction_id").alias("_rid"))
    return counts.agg(F.count(F.lit(1)).alias("_copies")).filter(F.col("_copies") > 1)


def count_quarantined(checked: DataFrame, repeated: DataFrame) -> DataFrame:
    """(raw_rows, quarantined_rows): failed rows plus all but one version of each repeated id."""
    extra = repeated.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0))).scalar()
    counted = checked.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(~_row_ok()).alias("failed"))
    return counted.select("raw_rows", (F.col("failed") + extra).alias("quarantined_rows"))


def mark_repeats(checked: DataFrame, repeated: DataFrame | None = None, lane_rows: int = 1_000_000) -> DataFrame:
    """Add DUPLICATE_TXN_ID to every good row that is not the newest of its id.

    Order: newest timestamp, then file, then all other columns.  Rejected rows
    and ids that occur once (nearly all rows) are never ranked or sorted.  The
    rest is ranked in two steps: within lanes of about `lane_rows` rows of one
    id, then among the lane winners, so an id with a third of all rows still
    spreads over as many tasks as its count asks for.
    """
    if repeated is None:
        repeated = repeated_ids(checked)
    settled = settled_rows(checked, repeated)
    return settled.unionByName(ranked_repeats(checked, repeated, lane_rows).select(*settled.columns))


def settled_rows(checked: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rejected rows and good rows whose id occurs once, as they are."""
    keyed = checked.withColumn("_key", C.spread(F.col("transaction_id"), _row_ok(), _plain(checked)))
    return keyed.join(repeated, (F.col("_key") == F.col("_rid")) & _row_ok(), "left_anti").drop("_key", LANE)


def ranked_repeats(checked: DataFrame, repeated: DataFrame, lane_rows: int = 1_000_000) -> DataFrame:
    """Good rows whose id occurs again, all but the newest of an id with their reason."""
    plain = _plain(checked)
    rivals = checked.filter(_row_ok()).join(repeated, F.col("transaction_id") == F.col("_rid"))
    lanes = F.ceil(F.col("_copies") / F.lit(lane_rows))
    rivals = rivals.withColumn(LANE, F.pmod(F.col(LANE), lanes))
    # After a shuffled join the rows are already placed by id, which would
    # satisfy both windows and keep a hot id in one task.  Placing them by id
    # and lane undoes that, and lets AQE split the join's hot partitions.
    rivals = rivals.repartition("transaction_id", LANE)

    rest = [F.col(c).asc_nulls_last() for c in plain if c not in ("transaction_id", "transaction_ts", "source_file")]
    newest = [F.col("transaction_ts").desc_nulls_last(), F.col("source_file").asc(), *rest]
    in_lane = Window.partitionBy("transaction_id", LANE).orderBy(*newest)
    ranked = rivals.withColumn("_first", F.row_number().over(in_lane))
    # Lane winners of one id meet in lane -1; everyone else stays where they are.
    ranked = ranked.withColumn(LANE, F.when(F.col("_first") == 1, F.lit(-1)).otherwise(F.col(LANE)))
    ranked = ranked.withColumn("_second", F.row_number().over(in_lane))

    loses = (F.col("_first") > 1) | (F.col("_second") > 1)
    marked = ranked.withColumn(
        REASON_COLUMN, F.when(loses, F.array(F.lit("DUPLICATE_TXN_ID"))).otherwise(F.col(REASON_COLUMN))
    )
    return marked.select(*[c for c in checked.columns if c != LANE])


def _plain(checked: DataFrame) -> list[str]:
    return [c for c in checked.columns if c not in (LANE, "owner", REASON_COLUMN)]


def flag(std: DataFrame, master: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Standardised rows + `owner` + `dq_fail_reasons` (empty array: valid)."""
    return mark_repeats(check_rows(std, master, as_of))


def valid_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(_row_ok()).drop(REASON_COLUMN, "raw_transaction_timestamp", "raw_amount", K.RAW_LINE)


def quarantined_rows(flagged: DataFrame, run_id: str, at: dt.datetime) -> DataFrame:
    bad = flagged.filter(F.size(REASON_COLUMN) > 0).drop("owner", K.RAW_LINE)
    return bad.withColumns(
        {
            REASON_COLUMN: F.concat_ws(",", REASON_COLUMN),
            "run_id": F.lit(run_id),
            "quarantined_at": instant(at),
        }
    )


def malformed_lines(flagged: DataFrame, run_id: str, at: dt.datetime) -> DataFrame:
    """The lines as delivered, with their files, so that they can be mended and delivered again."""
    if K.RAW_LINE not in flagged.columns:
        flagged = flagged.withColumn(K.RAW_LINE, F.lit(None).cast("string"))
    lines = flagged.filter(F.col(K.RAW_LINE).isNotNull()).select(K.RAW_LINE, "ingest_source", "source_file")
    return lines.withColumns({"run_id": F.lit(run_id), "quarantined_at": instant(at)})


def reason_counts(quarantine: DataFrame, run_id: str, run_ts: dt.datetime) -> DataFrame:
    """Rows per reason and path; a row with k reasons counts k times."""
    single = quarantine.select(F.explode(F.split(REASON_COLUMN, ",")).alias("reason"), "ingest_source")
    counted = single.groupBy("reason", "ingest_source").agg(F.count(F.lit(1)).alias("row_count"))
    return counted.withColumns({"run_id": F.lit(run_id), "run_ts": instant(run_ts)})
