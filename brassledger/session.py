"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent

# Applied by `session()` only; the operators never change settings.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.cbo.enabled": "true",  # tables of the catalog have statistics
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def session(app: str = "brassledger", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application; the same as ``--py-files`` on the command line."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        base = f"{tempfile.mkdtemp(prefix='brassledger-')}/{PACKAGE.name}"
        spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", PACKAGE.parent, PACKAGE.name))
        _shipped.add(app)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    All intermediate tables live there, so a lost executor costs a re-read and
    not the run.  Where the setting is absent, a temporary folder is right only
    if driver and tasks are one process; on a cluster this raises instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="brassledger-")
    return f"{root.rstrip('/')}/brassledger/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, root: str | None = None, **options: str) -> DataFrame:
    """The frame written once as Parquet in the shared folder (or below `root`) and read back.

    Cuts lineage: what follows re-reads files instead of computing again, and the planner sees true sizes.
    """
    spark = df.sparkSession
    path = f"{root}/{label}" if root else shared_folder(spark, label)
    df.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete folders of intermediate tables through Spark's own file systems."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(hadoop).delete(folder, True)
