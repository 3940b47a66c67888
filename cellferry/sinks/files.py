"""File writers. Each starts one job and reports what it wrote from that job."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.cells import FAMILY, to_cells
from ..operators.layout import sorted_layout
from ..sources.tables import ROW_KEY

# rows per file, so that no file grows without end
ROWS_PER_FILE = 20_000_000


def record_bytes(df: DataFrame) -> Column:
    """Bytes of a record's texts, and one for each of its cells."""
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + F.lit(1) for c in df.columns]
    return sum(sizes[1:], sizes[0]).cast("bigint")


@dataclass(frozen=True)
class Written:
    """What a write job saw: rows, and the greatest cursor where one was named."""

    rows: int
    greatest: dt.datetime | None = None


def observed(df: DataFrame, cursor: str | None = None) -> tuple[DataFrame, Observation]:
    """Count rows and take the greatest cursor while the rows pass.

    Put it after the last shuffle of the plan: Spark counts the tasks of the last stage
    once, even where lost executors make it run earlier stages again.
    """
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if cursor:
        metrics.append(F.max(cursor).alias("greatest"))
    return df.observe(seen, *metrics), seen


def result_of(seen: Observation) -> Written:
    values = seen.get
    return Written(int(values.get("rows") or 0), values.get("greatest"))


def write_sorted_cells(
    records: DataFrame,
    path: str,
    *,
    cursor: str | None = None,
    files: int | None = None,
    family: str = FAMILY,
    mode: str = "error",
    rows_per_file: int = ROWS_PER_FILE,
) -> Written:
    """Cells in key and qualifier order, as Parquet files with narrow key ranges.

    Records are shuffled and sorted while they are one row per key, and become cells after
    that, so cells are neither shuffled nor sorted. ``cursor`` names a helper column that
    is read for the result and not written. Keys must be unique.
    """
    placed, seen = observed(sorted_layout(records, files), cursor)
    cells = to_cells(placed.drop(cursor) if cursor else placed, family=family)
    cells.write.mode(mode).option("maxRecordsPerFile", rows_per_file).parquet(path)
    return result_of(seen)


def write_sorted_records(
    records: DataFrame,
    path: str,
    *,
    cursor: str | None = None,
    files: int | None = None,
    mode: str = "error",
    rows_per_file: int = ROWS_PER_FILE,
) -> Written:
    """Records in key order, as Parquet files with narrow key ranges."""
    placed, seen = observed(sorted_layout(records, files), cursor)
    wide = placed.drop(cursor) if cursor else placed
    wide.write.mode(mode).option("maxRecordsPerFile", rows_per_file).parquet(path)
    return result_of(seen)


def write_lines(df: DataFrame, path: str, files: int | None = None, mode: str = "error") -> None:
    """One value per line. A fixed number of files only where the caller asks for it.

    The rows are then moved once more, so that the steps before keep their own width.
    """
    column = F.col(f"`{df.columns[0]}`").cast("string").alias("value")
    lines = df.select(column)
    if files:
        lines = lines.repartition(files)
    lines.write.mode(mode).text(path)


def append_rows(df: DataFrame, path: str) -> Written:
    """Append rows to a Parquet folder."""
    passing, seen = observed(df)
    passing.write.mode("append").parquet(path)
    return result_of(seen)
