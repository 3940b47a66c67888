"""Checked queries: each runs over whole test tables, most beside the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL where there is one."""

    def register(run: Query) -> Query:
        if run.__name__ in QUERIES:
            raise ValueError(f"{run.__name__} is registered twice")
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(path(folder, name))


def path(folder: str, name: str) -> str:
    return f"{folder}/{name}.parquet"


def load_all() -> None:
    """Import every query module."""
    from . import cells, cleaning, control, identity, keyed, layout, roundtrips, scans  # noqa: F401
