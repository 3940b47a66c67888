"""Row filters and reports on data quality."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import idnum, text
from ..names import bind, bind_all


def rows_with_blank(df: DataFrame, columns: str | Iterable[str]) -> DataFrame:
    """Rows in which at least one of the columns is blank."""
    names = bind_all(df, columns)
    return df.where(text.any_blank([F.col(f"`{n}`").cast("string") for n in names]))


def rows_listed(df: DataFrame, column: str, entries: str) -> DataFrame:
    """Rows whose value equals an entry of a comma list."""
    return df.where(text.equals_listed(F.col(f"`{bind(df, column)}`").cast("string"), entries))


def id_report(df: DataFrame, columns: str | Iterable[str]) -> DataFrame:
    """Rows per validity class for each identity-number column. One pass over the table."""
    names = bind_all(df, columns)
    classes = df.select(*[idnum.validity_class(F.col(f"`{n}`").cast("string")).alias(n) for n in names])
    long = classes.unpivot([], names, "column_name", "validity")
    return long.groupBy("column_name", "validity").agg(F.count(F.lit(1)).alias("row_count"))


def distinct_tokens(df: DataFrame, column: Column, separators: str = ",") -> DataFrame:
    """Distinct entries of a list column."""
    return df.select(F.explode(text.split_set(column, separators)).alias("token")).distinct()


def rows_per_prefix(df: DataFrame, column: Column, keywords: str) -> DataFrame:
    """Rows per text prefix up to the first keyword that occurs."""
    prefix = text.keyword_prefix(column, keywords)
    return df.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("row_count"))
