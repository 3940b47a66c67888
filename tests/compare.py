"""Query results beside their SQL."""

import math
import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TESTDATA = "/root/testdata"


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(folder, name)}.parquet'")
    return db


def _text(value) -> str:
    if value is None or value is pd.NaT or value is pd.NA:
        return "<null>"
    if isinstance(value, float):
        return "<null>" if math.isnan(value) else repr(float(value))
    return str(value)


def rows_of(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    columns = sorted(frame.columns)
    return sorted(zip(*[[_text(v) for v in frame[c].tolist()] for c in columns])) if columns else []


def differences(ours: pd.DataFrame, theirs: pd.DataFrame) -> str:
    """Empty where both have the same columns and rows in any order."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    a, b = rows_of(ours), rows_of(theirs)
    if len(a) != len(b):
        return f"{len(a)} and {len(b)} rows"
    unequal = [(x, y) for x, y in zip(a, b) if x != y]
    kinds = {c: (str(ours[c].dtype), str(theirs[c].dtype)) for c in ours.columns}
    mixed = {c: k for c, k in kinds.items() if k[0] != k[1] and not {"object", "str"} >= set(k)}
    if unequal:
        return f"{len(unequal)} rows differ, first {unequal[0]}; types {mixed}"
    return ""
