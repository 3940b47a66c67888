"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import io
import os
import tempfile
import time
import zipfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLICE_BYTES = 8 << 20


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns, ``id`` and ``text`` with null texts empty, whatever else the table has."""
    return docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def sliced(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` text bytes, so that long texts do not add up."""
    for batch in batches:
        sizes = np.asarray(text_sizes(batch.column("text")))
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def text_sizes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column one after another, and the n + 1 bounds of its rows."""
    sizes = text_sizes(column)
    bounds = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=bounds[1:])
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    first = int(offsets[column.offset]) if len(sizes) else 0
    data = column.buffers()[2]
    if data is None or bounds[-1] == 0:
        return np.zeros(0, np.uint8), bounds
    return np.frombuffer(data, np.uint8)[first : first + int(bounds[-1])], bounds


def ship(df: DataFrame) -> None:
    """Send this package to the executors, once per session, as Spark sends any Python file."""
    context = df.sparkSession.sparkContext
    if getattr(context, "_cellferry_sent", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    path = os.path.join(tempfile.mkdtemp(), "cellferry.zip")  # on the driver only; Spark serves it
    with open(path, "wb") as file:
        file.write(made.getvalue())
    context.addPyFile(path)
    context._cellferry_sent = True


_worker_caches: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What this Python worker keeps for one operator from task to task; that of all others is dropped."""
    for other, cache in _worker_caches.items():
        if other != owner:
            cache.clear()
    return _worker_caches.setdefault(owner, {})


def _give_back() -> None:
    """Memory that a task has freed goes back to the system, since the worker lives on."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def in_arrow(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str,
    limit: int = SLICE_BYTES,
    owner: str = "",
) -> DataFrame:
    """Apply ``work`` to slices of a table that has a ``text`` column; ``owner`` keeps a :func:`worker_cache`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache(owner)
        try:
            for part in sliced(batches, limit):
                made = work(part)
                if made is not None and made.num_rows:
                    yield made
        finally:
            _give_back()

    ship(df)
    return df.mapInArrow(run, schema)


def text_id(column: str = "text") -> list[Column]:
    """Two 64-bit numbers that stand for a text."""
    return [F.xxhash64(F.col(column)).alias("h1"), F.xxhash64(F.lit(7), F.col(column)).alias("h2")]


# seconds between two clean-ups of the driver
CLEAN_EVERY = 5.0
_cleaned = [0.0]


def _clean_driver(spark: SparkSession) -> None:
    """Shuffle files and broadcasts are removed when the driver collects the plans that name them, which
    a driver with memory to spare puts off: it is asked to, at most every few seconds."""
    if time.monotonic() - _cleaned[0] >= CLEAN_EVERY:
        spark.sparkContext._jvm.System.gc()
        _give_back()
        _cleaned[0] = time.monotonic()


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, with no lineage left."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    made = df.checkpoint()
    _clean_driver(df.sparkSession)
    return made


# A word: characters between the ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(df: DataFrame, order: Sequence[Column], keep: Sequence[str], name: str = "at") -> DataFrame:
    """The columns ``keep`` and the place of every row in ``order``, from 0, without a step in one task.

    Rows are dealt by range and sorted where they are; only the sizes of the partitions meet in one
    place. The rows are checkpointed, so that their places stay as they are; rows that are equal
    in ``order`` stand in any order.
    """
    ident = F.monotonically_increasing_id()
    within = ident.bitwiseAND(F.lit((1 << 33) - 1)).alias("__within")
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = checkpointed(placed.select(*keep, F.shiftright(ident, 33).alias("__part"), within))
    sizes = placed.groupBy("__part").agg(F.count("*").alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__ahead"))
    # one row per partition, however many rows there are
    return placed.join(F.broadcast(offsets), "__part").select(*keep, (F.col("__ahead") + F.col("__within")).alias(name))


# the hashed table on the driver takes several times these bytes
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 16 << 20


def small_enough(df: DataFrame, row_bytes: int = 32, size: str | None = None) -> DataFrame:
    """``df`` marked for broadcast if it is counted to be small, else as it is, for a shuffled join.

    ``size``: an expression for the bytes of a row beyond ``row_bytes``. The table should be
    checkpointed, since it is read to be counted.
    """
    there, more = df.agg(F.count("*"), F.coalesce(F.sum(F.expr(size or "0L")), F.lit(0))).first()
    return F.broadcast(df) if there <= BROADCAST_ROWS and there * row_bytes + more <= BROADCAST_BYTES else df
