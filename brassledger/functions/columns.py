"""Column expressions.  Only built-ins, so Catalyst sees through all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brassledger import contracts as K


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- cleaning
def text(c) -> Column:
    """Blanks off both ends; nothing left means NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def code(c) -> Column:
    """A cleaned text in upper case."""
    return F.upper(text(c))


# ------------------------------------------------- lenient parsing (NULL if bad)
# `try_cast` yields NULL whatever the ANSI setting.  The shape test makes the
# cast strict, and unlike `try_to_timestamp` the path never touches the session
# time zone, so wall-clock values inside a daylight-saving gap survive.
def _shaped(c, shape: str, target: str) -> Column:
    trimmed = F.trim(_col(c))
    return F.when(trimmed.rlike(shape), trimmed.try_cast(target))


def timestamp(c) -> Column:
    return _shaped(c, K.TIMESTAMP_SHAPE, "timestamp_ntz")


def date(c) -> Column:
    return _shaped(c, K.DATE_SHAPE, "date")


def money(c) -> Column:
    return F.trim(_col(c)).try_cast(K.MONEY)


def integer(c) -> Column:
    return F.trim(_col(c)).try_cast("int")


def yes(c) -> Column:
    """Y -> true, other codes -> false, nothing -> NULL."""
    return code(c) == "Y"


def ingest_path(c="source_file") -> Column:
    return F.when(_col(c).contains(K.STREAM_MARK), "STREAM").otherwise("BATCH")


# ---------------------------------------------------------------- calendar
def month_start(c) -> Column:
    return F.trunc(_col(c), "MM")


def year_start(c) -> Column:
    return F.trunc(_col(c), "YYYY")


def whole_hours(earlier, later) -> Column:
    """Complete hours elapsed (boundaries crossed do not count)."""
    return F.timestamp_diff("HOUR", _col(earlier), _col(later))


def tenure_years(since, as_of: Column) -> Column:
    return F.round(F.months_between(as_of, _col(since)) / 12, 1)


# ---------------------------------------------------------------- numbers
def share(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """part / whole as double, NULL when whole is zero."""
    return F.lit(scale) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def total(c) -> Column:
    """Sum of money in one fixed type, so that re-aggregation keeps it."""
    return F.sum(_col(c)).cast("decimal(28,2)")


def money_if(cond: Column, c="amount") -> Column:
    return F.when(cond, _col(c)).otherwise(F.lit(0).cast(K.MONEY))


# ---------------------------------------------------------------- keys
def padded(prefix: str, number, width: int) -> Column:
    """prefix + zero-padded number; longer numbers are kept whole."""
    digits = _col(number).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def stable_bucket(c, buckets: int) -> Column:
    """Engine-independent bucket of a text key: first 15 hex digits of SHA-256, modulo."""
    head = F.left(F.sha2(_col(c), 256), F.lit(15))
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(buckets).cast("bigint"))


def spread(key: Column, usable: Column, row: list[str]) -> Column:
    """The key where usable; elsewhere a filler made of the row's hash, which matches nothing.

    Rows that cannot match (no key, or already rejected) would otherwise all
    hash to one join task.  The join condition must also test `usable`, so a
    filler that happens to equal a key decides nothing.
    """
    filler = F.concat(F.lit("~"), F.xxhash64(*row).cast("string"))
    return F.when(usable, key).otherwise(filler)


# ---------------------------------------------------------------- fixed tables
def fixed_rows(spark: SparkSession, names: tuple[str, ...], rows) -> DataFrame:
    """A small text table from constants.

    Unlike rows shipped from Python, it has a size the planner knows, so joins
    with it are broadcast on their own.
    """
    lines = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*lines)))


# ---------------------------------------------------------------- masking
def hashed(c) -> Column:
    return F.concat(F.lit("H_"), F.left(F.sha2(_col(c), 256), F.lit(16)))


def banded(c) -> Column:
    return F.round(_col(c), -3).cast(K.MONEY)
