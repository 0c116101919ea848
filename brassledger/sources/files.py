"""Raw files in, tables and exports out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brassledger import contracts as K
from brassledger.operators.standardise import instant

# Quotes inside a quoted value are doubled, as CSV writers commonly do, and
# blanks are data (Spark's writer would strip them).
CSV_DIALECT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_raw(spark: SparkSession, path: str | list[str], columns, keep_malformed: bool = False) -> DataFrame:
    """Every CSV (plain or gzip) below `path`, as text, with the file each row came from.

    `keep_malformed` adds the column `malformed_line`: the whole line where it has more or fewer fields than `columns`,
    NULL elsewhere.  Spark then parses all fields of a line even if few are asked for, and refuses to read that column
    without any other column of the contract.
    """
    kept = [K.RAW_LINE] if keep_malformed else []
    reader = spark.read.schema(K.text_schema([*columns, *kept])).options(**CSV_DIALECT)
    reader = reader.options(recursiveFileLookup="true", mode="PERMISSIVE", columnNameOfCorruptRecord=K.RAW_LINE)
    return with_lineage(reader.csv(path))


def with_lineage(rows: DataFrame) -> DataFrame:
    return rows.select("*", F.col("_metadata.file_path").alias("source_file"))


def write_raw(rows: DataFrame, path: str, columns, rows_per_file: int = 500_000) -> None:
    """Contract columns as gzip CSV batches; used to lay out test input.

    Gzip files cannot be split on reading, so their size sets the parallelism
    of the later scan.
    """
    out = rows.select(*columns).write.mode("overwrite").options(**CSV_DIALECT)
    out.option("maxRecordsPerFile", rows_per_file).csv(path, compression="gzip")


# ---------------------------------------------------------------- table writers
# Bloom filters sized by what they hold (64 KB to 1 MB for a row group), so that a lookup of one id skips row groups whose range of ids includes it.
LOOKED_UP = ("transaction_id", "source_account_id")
BLOOM_FILTERS = {
    "parquet.bloom.filter.adaptive.enabled": "true",
    **{f"parquet.bloom.filter.enabled#{c}": "true" for c in LOOKED_UP},
}


def write_fact(fact: DataFrame, path: str, **options: str) -> None:
    """Overwrite the fact, foldered by year and month, each file sorted by account and with bloom filters on ids.

    The rebalance puts a month's rows together, yet lets AQE cut a large month
    into several tasks and files; a plain repartition would give each month to
    one task.  The writer has to sort by folder anyway; account and time behind
    it keep an account's rows in few row groups, which min and max then tell.
    """
    clustered = fact.hint("rebalance", "year", "month")
    sorted_ = clustered.sortWithinPartitions("year", "month", "source_account_id", "transaction_ts")
    sorted_.write.mode("overwrite").options(**BLOOM_FILTERS, **options).partitionBy("year", "month").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Overwrite; AQE merges small partitions, so small tables get few files without one task doing all."""
    df.hint("rebalance").write.mode("overwrite").parquet(path)


def copy_table(df: DataFrame, path: str) -> None:
    """Overwrite with a frame that comes from a table as it is: its files' tasks write, and no row is shuffled."""
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A table under its declared layout.

    A given schema spares the footer job and is matched by name: absent columns
    come back as NULL, extra ones (such as folder columns) are left out.
    """
    return spark.read.schema(K.layout(ddl)).parquet(path).select(*K.layout_columns(ddl))


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The fact with its folder columns, so that filters on them skip folders."""
    return spark.read.schema(K.layout(f"{K.FACT_DDL}, year int, month int")).parquet(path)


# ---------------------------------------------------------------- by-name refresh
def match_by_name(df: DataFrame, ddl: str) -> DataFrame:
    """Declared columns by case-insensitive name; absent ones become typed NULL, extra ones go."""
    have = {name.lower(): name for name in df.columns}

    def pick(field: T.StructField):
        source = have.get(field.name.lower())
        value = F.lit(None) if source is None else F.col(f"`{source}`")
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[pick(field) for field in K.layout(ddl).fields])


def load_audit(tables: dict[str, DataFrame], loaded_at: dt.datetime) -> DataFrame:
    """(loaded_at, table_name, rows_loaded) per loaded table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows_loaded")).select(
            instant(loaded_at).alias("loaded_at"), F.lit(name).alias("table_name"), "rows_loaded"
        )
        for name, df in tables.items()
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionAll(part)
    return stacked


# ---------------------------------------------------------------- exports
def export_csv(mart: DataFrame, path: str) -> None:
    """A mart as CSV with header; NULL stays empty, text is quoted where needed.

    AQE sizes the output: the usual small mart becomes one file, a mart with a
    row per customer as many as its size asks for.
    """
    mart.hint("rebalance").write.mode("overwrite").options(**CSV_DIALECT, emptyValue="").csv(path)


def export_all(marts: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Each mart into its own folder; returns the folders by name."""
    paths = {name: f"{root}/{name}" for name in marts}
    for name, mart in marts.items():
        export_csv(mart, paths[name])
    return paths


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_DIALECT).csv(path)


def export_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows per exported mart, counted from the files."""
    parts = []
    for name, path in paths.items():
        rows = spark.read.options(**CSV_DIALECT).csv(path)
        parts.append(rows.agg(F.count(F.lit(1)).alias("rows_exported")).select(F.lit(name).alias("mart"), "*"))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionAll(part)
    return stacked
