"""The registry: a name, a Spark query, and (where SQL can say it) an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brassledger.catalogue.workspace import Workspace
from brassledger.oracle.prelude import with_prelude

_QUERIES: dict[str, Callable[[Workspace], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query.  `oracle` is the final SELECT over the oracle chain."""

    def register(build: Callable[[Workspace], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = build
        if oracle is not None:
            _ORACLES[name] = with_prelude(oracle)
        return build

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, sf_dir: build(Workspace.of(spark, sf_dir))

    return {name: bind(build) for name, build in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
