"""Tables that change together: a folder per load, and one row that commits it.

A load writes all its tables into a folder that nobody reads yet, then its commit row.  Readers look at the commit rows
first and take every table from the newest load, so a load that breaks off is not seen, whichever table it had reached,
and who has opened a load keeps it while the next one is written.  `expire` deletes folders of old loads.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brassledger import contracts as K
from brassledger.operators.standardise import instant
from brassledger.session import discard, exists
from brassledger.sources import files

COMMIT_DDL = "load_id string, loaded_at timestamp_ntz, source_run string"


class NothingLoaded(LookupError):
    """Tables were asked for before a load was committed."""


@dataclass(frozen=True)
class Load:
    """All tables as of one load."""

    loads: Loads
    load_id: str

    def table(self, name: str, ddl: str) -> DataFrame:
        return files.read_table(self.loads.spark, self.loads.path(self.load_id, name), ddl)


class Loads:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, load_id: str, name: str) -> str:
        return f"{self.root}/load={load_id}/{name.replace('.', '/')}"

    def _commit_path(self, load_id: str = "") -> str:
        return f"{self.root}/commits" + (f"/load={load_id}" if load_id else "")

    def _audit_path(self, load_id: str = "") -> str:
        return f"{self.root}/load_audit" + (f"/load={load_id}" if load_id else "")

    # ------------------------------------------------------------ reading
    def commits(self) -> DataFrame:
        """A row per committed load."""
        if not exists(self.spark, self._commit_path()):
            raise NothingLoaded(f"no load has been committed in {self.root}")
        return files.read_table(self.spark, self._commit_path(), COMMIT_DDL)

    def current(self) -> Load:
        newest = self.commits().agg(F.max(F.struct("loaded_at", "load_id")).alias("newest")).first()["newest"]  # one row
        if newest is None:
            raise NothingLoaded(f"no load has been committed in {self.root}")
        return Load(self, newest["load_id"])

    def audit(self) -> DataFrame:
        """(loaded_at, table_name, rows_loaded) of all committed loads."""
        rows = self.spark.read.schema(K.layout(f"{K.AUDIT_DDL}, load string")).parquet(self._audit_path())
        committed = self.commits().select(F.col("load_id").alias("load"))
        return rows.join(committed, "load", "left_semi").select(*K.layout_columns(K.AUDIT_DDL))

    # ------------------------------------------------------------ writing
    def load(
        self, sources: dict[str, tuple[DataFrame, str]], loaded_at: dt.datetime, audited: tuple[str, ...] = (), source_run: str = ""
    ) -> Load:
        """Write frames by column name under their layouts, count the audited ones from what was written, commit."""
        load_id = f"{loaded_at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex}"
        try:
            self._write(load_id, sources, loaded_at, audited)
            row = self.spark.range(1).select(
                F.lit(load_id).alias("load_id"), instant(loaded_at).alias("loaded_at"), F.lit(source_run).alias("source_run")
            )
            files.write_table(row, self._commit_path(load_id))
        except BaseException:
            discard(self.spark, f"{self.root}/load={load_id}", self._audit_path(load_id))
            raise
        return Load(self, load_id)

    def _write(self, load_id: str, sources: dict, loaded_at: dt.datetime, audited: tuple[str, ...]) -> None:
        def put(name: str) -> None:
            df, ddl = sources[name]
            files.copy_table(files.match_by_name(df, ddl), self.path(load_id, name))

        with ThreadPoolExecutor(max_workers=4) as pool:  # small tables fill idle cores
            for job in [pool.submit(put, name) for name in sources]:
                job.result()
        if audited:
            written = Load(self, load_id)
            counts = files.load_audit({name: written.table(name, sources[name][1]) for name in audited}, loaded_at)
            files.write_table(counts, self._audit_path(load_id))

    def expire(self, keep: int = 2) -> list[str]:
        """Delete the tables of all committed loads but the newest `keep`; commit and audit rows stay."""
        newest = self.commits().orderBy(F.desc("loaded_at"), F.desc("load_id")).collect()  # a row per load
        gone = [r["load_id"] for r in newest[max(keep, 1) :]]
        discard(self.spark, *[f"{self.root}/load={load_id}" for load_id in gone])
        return gone
