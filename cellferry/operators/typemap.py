"""Column types on the way to and from a relational database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..names import bind

# Database column type by Spark type.
SINK_TYPES = {
    "boolean": "NUMBER(1)",
    "tinyint": "NUMBER(3)",
    "smallint": "NUMBER(5)",
    "int": "NUMBER(10)",
    "bigint": "NUMBER(19)",
    "float": "NUMBER(19, 4)",
    "double": "NUMBER(19, 4)",
    "string": "VARCHAR2(255)",
    "binary": "BINARY",
    "timestamp": "DATE",
    "timestamp_ntz": "DATE",
    "date": "DATE",
}
# Longest text, and digits before and after the point of a fractional number.
SINK_TEXT_LENGTH = 255
SINK_FRACTION = (19, 4)
# Fixed value: the type of a number without a declared size.
OPEN_NUMBER = "decimal(38,10)"

_FRACTIONS = (T.FloatType, T.DoubleType)
_TIMES = (T.TimestampType, T.TimestampNTZType)
_CREATE_TYPES = {
    "boolean": "DECIMAL(1)",
    "tinyint": "DECIMAL(3)",
    "smallint": "DECIMAL(5)",
    "int": "DECIMAL(10)",
    "bigint": "DECIMAL(19)",
    "float": "DECIMAL(19,4)",
    "double": "DECIMAL(19,4)",
    "string": f"VARCHAR({SINK_TEXT_LENGTH})",
}


def _as_fraction(c: Column) -> Column:
    return c.try_cast(T.DecimalType(*SINK_FRACTION))


def _overflows(c: Column) -> Column:
    return c.isNotNull() & _as_fraction(c).isNull()


def cast_for_sink(df: DataFrame) -> DataFrame:
    """Fractions to four decimals and timestamps to whole seconds, as the database keeps them.

    A fraction that the database would refuse (too large, infinite or no number) ends the job
    with an error that names column and value; it never becomes a null. :func:`sink_report`
    counts such values, and those that lose digits, before a run.
    """
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, _FRACTIONS):
            told = F.concat(F.lit(f"column {field.name}: "), c.cast("string"), F.lit(f" does not fit decimal{SINK_FRACTION}"))
            c = F.when(_overflows(c), F.raise_error(told)).otherwise(_as_fraction(c))
        elif isinstance(field.dataType, _TIMES):
            c = F.date_trunc("second", c).cast(field.dataType)
        out.append(c.alias(field.name))
    return df.select(*out)


def sink_report(df: DataFrame) -> DataFrame:
    """Per column, how many values do not fit the database type. One pass over the table.

    ``misfits`` would be refused; ``rounded`` lose fraction digits or parts of a second.
    """
    tests, rounds = {}, {}
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            tests[field.name], rounds[field.name] = F.length(c) > SINK_TEXT_LENGTH, F.lit(False)
        elif isinstance(field.dataType, _FRACTIONS):
            tests[field.name], rounds[field.name] = _overflows(c), _as_fraction(c).cast("double") != c.cast("double")
        elif isinstance(field.dataType, _TIMES):
            tests[field.name], rounds[field.name] = F.lit(False), F.date_trunc("second", c) != c
    shape = "array<struct<column_name:string,misfits:bigint,rounded:bigint>>"
    counts = [
        F.struct(F.lit(n).alias("column_name"), F.count_if(t).alias("misfits"), F.count_if(rounds[n]).alias("rounded"))
        for n, t in tests.items()
    ]
    return df.agg(F.array(*counts).cast(shape).alias("r")).select(F.inline("r"))


def create_column_types(df: DataFrame) -> str:
    """Types for a table that the writer creates, in the form Spark's JDBC writer takes."""
    kinds = [(f.name, _CREATE_TYPES.get(f.dataType.simpleString())) for f in df.schema.fields]
    return ", ".join(f"`{name}` {kind}" for name, kind in kinds if kind)


def source_type(size: int, scale: int) -> str | None:
    """Spark type for a database NUMERIC by declared size and scale; None keeps the default."""
    if size == 0:
        return OPEN_NUMBER
    if size == 1:
        return "boolean"
    if size in (3, 5, 10):
        return "int"
    if size == 19:
        return {0: "bigint", 4: "float"}.get(scale)
    return OPEN_NUMBER if scale == -127 else None


def cast_from_source(df: DataFrame, catalog: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Cast the columns named in a ``{column: (size, scale)}`` catalog."""
    kinds = {bind(df, name): source_type(*size) for name, size in catalog.items()}
    return df.select(
        *[(F.col(f"`{c}`").cast(kinds[c]) if kinds.get(c) else F.col(f"`{c}`")).alias(c) for c in df.columns]
    )


def source_schema(catalog: Mapping[str, tuple[int, int]]) -> str:
    """The same casts as a ``customSchema`` option for a relational scan."""
    kinds = [(name, source_type(*size)) for name, size in catalog.items()]
    return ", ".join(f"{name} {kind}" for name, kind in kinds if kind)
