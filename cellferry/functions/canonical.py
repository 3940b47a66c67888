"""Canonical text of any column, chosen from the schema when the plan is built."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import dates, idnum
from .text import blank_to, clean_text, control_trim, ends_with_any_case

_TIMES = (T.TimestampType, T.TimestampNTZType)
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)


@dataclass(frozen=True)
class TextRules:
    """How values become text.

    ``date_columns`` names text columns that hold dates; left out, columns are taken by
    name suffix. ``date_mode`` is ``"parse"`` or ``"strip"``. ``id_columns`` are upgraded
    to 18 characters. ``decimal_scale`` prints floating columns as plain decimals in place
    of Java's ``1.0E7`` form.
    """

    date_columns: Sequence[str] | None = None
    date_suffixes: Sequence[str] = dates.DATE_NAME_SUFFIXES
    date_mode: str = "parse"
    id_columns: Sequence[str] = ()
    decimal_scale: int | None = None

    def __post_init__(self) -> None:
        if self.date_mode not in ("parse", "strip"):
            raise ValueError(f"date_mode must be 'parse' or 'strip', not {self.date_mode!r}")

    def is_date_name(self, name: str) -> bool:
        if self.date_columns is not None:
            return name.lower() in {n.lower() for n in self.date_columns}
        return ends_with_any_case(name, self.date_suffixes)

    def is_id_name(self, name: str) -> bool:
        return name.lower() in {n.lower() for n in self.id_columns}


def canonical(df: DataFrame, name: str, default: str = "", rules: TextRules = TextRules()) -> Column:
    """Text of one column: timestamps as 14 digits, dates as 8, text cleaned and trimmed.

    Blank values give ``default``.
    """
    field = next(f for f in df.schema.fields if f.name.lower() == name.lower())
    c, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, _NESTED):
        raise TypeError(f"column {field.name} has type {kind.simpleString()}, which has no text form here")
    if isinstance(kind, _TIMES):
        return F.coalesce(dates.digits14(c), F.lit(default))
    if isinstance(kind, T.DateType):
        return F.coalesce(dates.digits8(c), F.lit(default))
    text = c
    if isinstance(kind, (T.FloatType, T.DoubleType)) and rules.decimal_scale is not None:
        text = c.cast(T.DecimalType(38, rules.decimal_scale))
    text = text.cast("string")
    if rules.is_date_name(field.name):
        trimmed = control_trim(text)
        if rules.date_mode == "strip":
            return blank_to(control_trim(dates.strip_date(trimmed)), default)
        return dates.normalise_date(text, trimmed, default)
    if rules.is_id_name(field.name):
        return idnum.to_18(text, otherwise=clean_text(text, default))
    if not isinstance(kind, T.StringType):
        return F.coalesce(text, F.lit(default))
    return clean_text(text, default)


def canonical_by_type(df: DataFrame, name: str, default: str = "") -> Column:
    """Text by declared type only: timestamps as 14 digits, other values as they are."""
    field = next(f for f in df.schema.fields if f.name.lower() == name.lower())
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _TIMES):
        return F.coalesce(dates.digits14(c), F.lit(default))
    return blank_to(c.cast("string"), default)


def standardise(df: DataFrame, rules: TextRules = TextRules(), default: str = "") -> DataFrame:
    """Every column of a table in canonical text, names unchanged."""
    return df.select(*[canonical(df, n, default, rules).alias(n) for n in df.columns])
