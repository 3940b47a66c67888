"""Keep one row per key, distinct values, greatest row, counts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import as_long_or_zero
from ..names import bind, bind_all
from ..sources.tables import ROW_KEY

_RANK = "__rank"


def keep_latest(df: DataFrame, key: str | Sequence[str], by: Sequence[Column | str] = ()) -> DataFrame:
    """One row per key: the greatest by ``by``, ties broken by every other column.

    The order is total, so the survivor does not depend on partitioning. Spark limits each
    key to one row per task before the shuffle, so a key that holds a large part of the
    rows sends one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    lead = [F.col(c) if isinstance(c, str) else c for c in by]
    named = {c.lower() for c in by if isinstance(c, str)} | {k.lower() for k in keys}
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() not in named]
    order = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in [*lead, *rest]])
    ranked = df.withColumn(_RANK, F.row_number().over(order))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def fixed_width(df: DataFrame, width: int, key: str = ROW_KEY) -> DataFrame:
    """Exactly ``width`` partitions by key. Use it after :func:`keep_latest`, on unique keys."""
    return df.repartition(width, key)


def distinct_values(df: DataFrame, columns: str | Iterable[str]) -> DataFrame:
    """Distinct values of the named columns."""
    return df.select(*bind_all(df, columns)).distinct()


def distinct_records(df: DataFrame) -> DataFrame:
    """Distinct whole records."""
    return df.distinct()


def greatest_row(df: DataFrame, cursor: str, group_by: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest cursor, per group or overall; text that is no number counts as 0.

    Ties are broken by the other columns. Partial results are merged, so no group is
    gathered in one task.
    """
    name = bind(df, cursor)
    kind = dict(df.dtypes)[name]
    c = F.col(f"`{name}`")
    rank = as_long_or_zero(c) if kind == "string" else c
    ordered = F.struct(rank.alias(_RANK), *[F.col(f"`{n}`") for n in df.columns])
    top = df.groupBy(*group_by).agg(F.max(ordered).alias("top"))
    return top.where(F.col("top").isNotNull()).select("top.*").drop(_RANK)


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """Number of rows, as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def batch_metrics(records: DataFrame, cursor: Column, alias_count: str = "key_count") -> DataFrame:
    """Exported keys, greatest cursor and whether the batch is empty, in one pass over kept records."""
    count = F.count(F.lit(1))
    return records.agg(count.alias(alias_count), F.max(cursor).alias("greatest"), (count == 0).alias("is_empty"))
