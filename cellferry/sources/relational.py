"""Relational scans over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import project

# Fixed value: rows per fetch.
FETCH_SIZE = 100_000


def read_options(
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int | None = None,
    custom_schema: str | None = None,
    fetch_size: int = FETCH_SIZE,
    **extra: str,
) -> dict[str, str]:
    """Reader options. With a partition column the scan is split over ``partitions`` tasks.

    Bounds set the stride only; rows outside them are read by the first and last task.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    split = (partition_column, lower, upper, partitions)
    if any(s is not None for s in split):
        if any(s is None for s in split):
            raise ValueError("partition_column, lower, upper and partitions go together")
        options |= {
            "partitionColumn": str(partition_column),
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    if custom_schema:
        options["customSchema"] = custom_schema
    return options


def read_relational(spark: SparkSession, columns: str | None = None, **options) -> DataFrame:
    """Scan a relational table; projection and filters are pushed into the database."""
    df = spark.read.format("jdbc").options(**read_options(**options)).load()
    return project(df, columns)
