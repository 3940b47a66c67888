"""Table scans: catalog tables, Parquet folders, key ranges, control tables, literals."""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..names import bind

ROW_KEY = "row_key"


def project(df: DataFrame, columns: str | Sequence[str] | None) -> DataFrame:
    """Project by SQL expressions, given as a sequence or as the text after ``select``."""
    if not columns:
        return df
    if isinstance(columns, str):
        text = columns.replace("{", "{{").replace("}", "}}")
        return df.sparkSession.sql(f"select {text} from {{source}}", source=df)
    return df.selectExpr(*columns)


def read_table(spark: SparkSession, source: str, columns: str | Sequence[str] | None = None) -> DataFrame:
    """Scan ``db.table`` or a Parquet folder (anything with a slash).

    Spark reads only the columns that the expressions in ``columns`` use.
    """
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    return project(df, columns)


def _as_day(text: str) -> datetime.date | None:
    """The day that a key bound begins with; None where it has no eight digits or no such day."""
    if not re.match("[0-9]{8}", text):
        return None
    try:
        return datetime.datetime.strptime(text[:8], "%Y%m%d").date()
    except ValueError:
        return None


def key_range(
    df: DataFrame, start: str, stop: str, key: str | Column = ROW_KEY, day_column: str | None = None
) -> DataFrame:
    """Rows whose key lies in ``[start, stop)``, compared byte by byte.

    Over a stored key column the test reaches the Parquet scan. Where the key is computed
    and begins with the ``yyyyMMdd`` of a date column, name that column in ``day_column``:
    the same bound in days is added, which the scan can use.
    """
    k = F.col(key) if isinstance(key, str) else key
    test = (k >= F.lit(start)) & (k < F.lit(stop))
    if day_column:
        kind = df.schema[bind(df, day_column)].dataType
        day, first, last = F.col(day_column), _as_day(start), _as_day(stop)
        if first:
            test = test & (day.isNull() | (day >= F.lit(first).cast(kind)))
        if last:
            after = last + datetime.timedelta(days=1)
            test = test & (day.isNull() | (day < F.lit(after).cast(kind)))
    return df.where(test)


def read_cell(df: DataFrame, qualifier: str, alias: str = "value") -> DataFrame:
    """One cell of a wide table, or of a long one that has a ``qualifier`` column."""
    names = {c.lower() for c in df.columns}
    if {"qualifier", "value"} <= names:
        return df.where(F.col("qualifier") == F.lit(qualifier)).select(F.col("value").alias(alias))
    return df.select(F.col(f"`{bind(df, qualifier)}`").alias(alias))


_COMPARE = {
    "=": lambda c, v: c == v,
    "<>": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "like": F.like,
}


def _given(value: Any) -> bool:
    return value is not None and str(value).strip() != ""


def control_query(
    df: DataFrame,
    conditions: Iterable[tuple[str, str, Any]] = (),
    order: tuple[str, str] | None = None,
    columns: Sequence[str] = (),
) -> DataFrame:
    """Optional predicates, optional order, lower-case text output.

    ``conditions`` holds ``(column, operator, value)``; those with a blank value are left
    out. ``order`` is ``(column, "asc" | "desc")``. No columns means all.
    """
    tests = [
        _COMPARE[op.strip().lower()](F.col(f"`{bind(df, column)}`"), F.lit(value))
        for column, op, value in conditions
        if _given(value)
    ]
    out = df.where(reduce(lambda a, b: a & b, tests)) if tests else df
    if order and _given(order[1]):
        by = F.col(f"`{bind(df, order[0])}`")
        out = out.orderBy(by.desc() if order[1].strip().lower() == "desc" else by.asc())
    names = [bind(df, c) for c in columns] or df.columns
    return out.select(*[F.col(f"`{n}`").cast("string").alias(n.lower()) for n in names])


def literal_table(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    """A small literal collection as a table."""
    return spark.createDataFrame(list(rows), schema)
