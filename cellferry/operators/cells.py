"""Rows to key/qualifier/value cells, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to
from ..sources.tables import ROW_KEY

FAMILY = "cf1"


def to_cells(records: DataFrame, qualifiers: Sequence[str] | None = None, family: str = FAMILY) -> DataFrame:
    """One row per cell, null values as empty text, qualifiers in name order within a row.

    No shuffle. Records sorted by key give cells sorted by key and qualifier.
    """
    names = sorted(qualifiers or [c for c in records.columns if c != ROW_KEY])
    texts = records.select(ROW_KEY, *[F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")).alias(n) for n in names])
    long = texts.unpivot(ROW_KEY, names, "qualifier", "value")
    return long.select(ROW_KEY, F.lit(family).alias("family"), "qualifier", "value")


def from_cells(cells: DataFrame, qualifiers: Sequence[str]) -> DataFrame:
    """Cells back to one row per key, in one shuffle with partial aggregation."""
    picked = [F.max(F.when(F.col("qualifier") == F.lit(q), F.col("value"))).alias(q) for q in qualifiers]
    return cells.groupBy(ROW_KEY).agg(*picked)


def lookup_cell(cells: DataFrame, qualifier: str, default: str = "") -> DataFrame:
    """The value of one qualifier for every key; ``default`` where it is missing or blank."""
    value = F.max(F.when(F.col("qualifier") == F.lit(qualifier), F.col("value")))
    return cells.groupBy(ROW_KEY).agg(blank_to(value, default).alias("value"))


def collect_cells(cells: DataFrame, first_by: Sequence[Column | str]) -> DataFrame:
    """Cells of each key as one array sorted by qualifier; the first cell per qualifier is kept.

    Doubles are removed by partial aggregation first, so an array never grows beyond the
    number of qualifiers.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in first_by]
    first = F.min(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col("value").alias("value")))
    single = cells.groupBy(ROW_KEY, "qualifier").agg(first["value"].alias("value"))
    cell = F.struct("qualifier", "value")
    return single.groupBy(ROW_KEY).agg(F.sort_array(F.collect_list(cell)).alias("cells"))
