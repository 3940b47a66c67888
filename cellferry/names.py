"""Column names in any case."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def bind(df: DataFrame, name: str) -> str:
    """The column's own spelling for a name given in any case."""
    hits = [c for c in df.columns if c.lower() == name.strip().lower()]
    if len(hits) != 1:
        problem = "is missing" if not hits else "is ambiguous"
        raise ValueError(f"column {name!r} {problem} in {df.columns}")
    return hits[0]


def bind_all(df: DataFrame, names: str | Iterable[str]) -> list[str]:
    """As :func:`bind` for a comma list or a sequence; an empty list is an error."""
    parts = names.split(",") if isinstance(names, str) else list(names)
    wanted = [p.strip() for p in parts if p and p.strip()]
    if not wanted:
        raise ValueError("the column list is empty")
    return [bind(df, n) for n in wanted]


def rename_case(df: DataFrame, upper: bool = False, keep: Iterable[str] = ()) -> DataFrame:
    """All names in lower or upper case, but for those in ``keep``."""
    kept = set(keep)
    renamed = [c if c in kept else (c.upper() if upper else c.lower()) for c in df.columns]
    if len({n.lower() for n in renamed}) != len(renamed):
        raise ValueError(f"names collide when their case is changed: {df.columns}")
    return df.toDF(*renamed)


def sort_columns(df: DataFrame, first: Iterable[str] = ()) -> DataFrame:
    """Columns by name, those in ``first`` ahead."""
    head = list(first)
    return df.select(*head, *sorted(c for c in df.columns if c not in head))
