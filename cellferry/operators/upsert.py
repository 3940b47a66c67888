"""Newest value per cell over a target and later batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import ROW_KEY

# reserved: no record may have a column of this name
BATCH = "__batch_no"


def refuse_reserved(records: DataFrame) -> DataFrame:
    """The records themselves, or an error if one of their columns has the reserved name."""
    if BATCH in {c.lower() for c in records.columns}:
        raise ValueError(f"{BATCH} is reserved and may not be a column of a record")
    return records


def newest_records(versions: DataFrame, key: str = ROW_KEY, batch: str = BATCH) -> DataFrame:
    """One row per key from several versions of it: per column the value of the latest batch.

    Null means that the batch did not write the cell, so the older value stays; empty text
    is a written value. Two values in one batch are settled by the greater one. One
    aggregation with partial merging; none of the versions is gathered.
    """
    columns = [c for c in versions.columns if c not in (key, batch)]
    newest = []
    for name in columns:
        c = F.col(f"`{name}`")
        version = F.struct(F.col(batch).alias("b"), c.alias("v"))
        newest.append(F.max(F.when(c.isNotNull(), version))["v"].alias(name))
    return versions.groupBy(key).agg(*newest)


def upsert_records(target: DataFrame, *batches: DataFrame) -> DataFrame:
    """Merge keyed records, oldest first; columns a batch lacks are left as they are."""
    stacked = refuse_reserved(target).withColumn(BATCH, F.lit(0))
    for number, batch in enumerate(batches, start=1):
        stacked = stacked.unionByName(refuse_reserved(batch).withColumn(BATCH, F.lit(number)), allowMissingColumns=True)
    return newest_records(stacked)


def newest_cells(versions: DataFrame, batch: str = BATCH, order: Sequence[str] = ()) -> DataFrame:
    """One row per key, family and qualifier: the value of the latest batch."""
    version = F.struct(batch, *order, "value")
    return versions.groupBy(ROW_KEY, "family", "qualifier").agg(F.max(version)["value"].alias("value"))


def upsert_cells(target: DataFrame, *batches: DataFrame) -> DataFrame:
    """Merge cells, oldest first: a cell written again replaces the old one, others stay."""
    stacked = refuse_reserved(target).withColumn(BATCH, F.lit(0))
    for number, batch in enumerate(batches, start=1):
        stacked = stacked.unionByName(refuse_reserved(batch).withColumn(BATCH, F.lit(number)))
    return newest_cells(stacked)
