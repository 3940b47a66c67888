"""Relational appends over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.typemap import create_column_types
from .files import Written, observed, result_of

# Fixed value: writers at a time.
WRITERS = 5


def write_options(url: str, table: str, *, batch_size: int = 10_000, writers: int = WRITERS, **extra: str) -> dict[str, str]:
    """Writer options. The database is protected by the number of writers, not by the plan's width."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), "numPartitions": str(writers), **extra}


def append_relational(df: DataFrame, **options) -> Written:
    """Append rows; the row count comes from the write job itself.

    Give it rows in database types, as :func:`cellferry.plans.jobs.append_rows_of` does.
    """
    types, given = create_column_types(df), write_options(**options)
    # the writer would narrow the plan itself to so many tasks; rows are moved once instead,
    # so that the steps before keep their width
    passing, seen = observed(df.repartition(int(given["numPartitions"])))
    writer = passing.write.format("jdbc").mode("append").options(**given)
    if types:
        writer = writer.option("createTableColumnTypes", types)
    writer.save()
    return result_of(seen)
