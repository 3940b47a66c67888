"""Row keys and keyed records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canonical import TextRules, canonical
from ..names import bind_all
from ..sources.tables import ROW_KEY

KEY_SEPARATOR = "_"
BLANK_KEY_PART = "null"


def row_key(df: DataFrame, keys: str | Iterable[str], rules: TextRules = TextRules()) -> Column:
    """Canonical values of the key columns joined by ``_``; a blank part becomes ``null``."""
    parts = [canonical(df, k, BLANK_KEY_PART, rules) for k in bind_all(df, keys)]
    return F.concat_ws(KEY_SEPARATOR, *parts)


def random_key() -> Column:
    """A random key. Write the result once and read it back before it is used twice."""
    return F.uuid()


def with_row_key(df: DataFrame, keys: str | Iterable[str], rules: TextRules = TextRules()) -> DataFrame:
    """The table with its row key in front."""
    return df.select(row_key(df, keys, rules).alias(ROW_KEY), "*")
