"""A table in key ranges whose bounds are stored.

The split points are a table of their own, drawn once from the first batch by bytes and kept.
Every batch is dealt to the same ranges by search, one group of files per range, and a manifest
holds the key bounds of every file. A read of a key range opens only the files whose bounds
meet it. A range that outgrows its limit is cut into parts of equal bytes; only its own
files are written again.

What belongs to the table is told by numbered commits (:class:`cellferry.store.CommitLog`):
files that no commit names are not read, so a writer that breaks off leaves nothing behind.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.layout import range_number, weighted_split_points
from ..operators.upsert import BATCH, newest_records, refuse_reserved
from ..sources.tables import ROW_KEY
from ..store import CommitLog
from .files import ROWS_PER_FILE, Written, observed, record_bytes, result_of

# Fixed value: bytes that a range may hold before it is cut.
RANGE_BYTES = 10 * (1 << 30)

RANGE = "range_no"
# manifests of single batches; beyond so many they are written as one
MANIFESTS_BEFORE_FOLD = 20
MANIFEST = f"file string, {RANGE} int, first_key string, last_key string, rows bigint, bytes bigint"


class RangedTable:
    """Versions of keyed records in a folder: ``row_key``, text columns, the batch's number.

    Below the folder: ``data``, ``splits`` and ``manifest``, each with a subfolder per write that
    has a name of its own, the log of commits, and the log of batch numbers. Of two batches the
    one that took its number later wins, whichever is committed first.
    """

    def __init__(self, spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> None:
        self.spark, self.path, self.range_bytes = spark, path.rstrip("/"), range_bytes
        self.log, self.batches = CommitLog(spark, f"{self.path}/log"), CommitLog(spark, f"{self.path}/batches")

    # ---- what the table is made of ---------------------------------------------------------

    def _state(self) -> tuple[int, dict]:
        """The latest commit: its split points, its manifests and the columns of the table."""
        last = self.log.last()
        return last, self.log.entry(last).what if last else {"splits": None, "manifests": [], "columns": []}

    def splits(self) -> list[str]:
        """First keys of all ranges but the lowest; one text per range, however many rows it has."""
        return self._splits(self._state()[1]["splits"])

    def _splits(self, name: str | None) -> list[str]:
        if name is None:
            return []
        rows = self.spark.read.schema("first_key string").parquet(f"{self.path}/splits/{name}")
        return sorted(r[0] for r in rows.toLocalIterator())

    def manifest(self) -> DataFrame:
        """One row per file: its range, its first and last key, rows and bytes."""
        return self._manifest(self._state()[1])

    def _manifest(self, state: dict) -> DataFrame:
        if not state["manifests"]:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(*[f"{self.path}/manifest/{name}" for name in state["manifests"]])

    def range_sizes(self) -> DataFrame:
        """Bytes, rows and files of every range that holds any."""
        return self._sizes(self.manifest())

    @staticmethod
    def _sizes(manifest: DataFrame) -> DataFrame:
        return manifest.groupBy(RANGE).agg(
            F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files")
        )

    # ---- writing ---------------------------------------------------------------------------

    def put(self, records: DataFrame, cursor: str | None = None) -> Written:
        """Append a batch of records with unique keys; the first batch draws the split points.

        The files are written once. Only where another writer cut ranges meanwhile are they
        written again, since they would straddle the new bounds.
        """
        refuse_reserved(records)
        if RANGE in {c.lower() for c in records.columns}:
            raise ValueError(f"{RANGE} is reserved and may not be a column of a record")
        given = [c for c in records.columns if c not in (ROW_KEY, cursor)]
        texts = [F.col(f"`{c}`").cast("string").alias(c) for c in (ROW_KEY, *given)]
        if self._state()[1]["splits"] is None:
            self._draw(records.select(*texts))
        number = self._number()
        rows = records.select(*texts, *([cursor] if cursor else []), F.lit(number).cast("bigint").alias(BATCH))
        seen, split_by, noted = Written(0), None, ""
        while True:
            last, state = self._state()
            if state["splits"] != split_by:
                split_by = state["splits"]
                folder, seen = self._write(rows, self._splits(split_by), cursor)
                noted = self._note_files(folder)
            names = [*state["manifests"], noted]
            if len(names) > MANIFESTS_BEFORE_FOLD:
                names = [self._write_manifest(self._manifest({"manifests": names}))]
            known = {c.lower() for c in state["columns"]}
            columns = [*state["columns"], *[c for c in given if c.lower() not in known]]
            if self.log.claim_at(last + 1, splits=split_by, manifests=names, columns=columns):
                return seen

    def _number(self) -> int:
        number = self.batches.last() + 1
        while not self.batches.claim_at(number):
            number += 1
        return number

    def _draw(self, records: DataFrame) -> None:
        """Split points by the bytes of a first batch, so that each range starts with its share."""
        sized = records.select(ROW_KEY, record_bytes(records).alias("weight"))
        total = sized.agg(F.sum("weight")).first()[0] or 0
        # half full at first, so that ranges are not cut by the next batch
        tiles = max(1, math.ceil(2 * total / self.range_bytes))
        drawn = self._write_splits(self._inner(weighted_split_points(sized, tiles, "weight")))
        self.log.claim_at(1, splits=drawn, manifests=[], columns=[])  # or another writer's points count

    @staticmethod
    def _inner(points: DataFrame) -> DataFrame:
        """All first keys but that of the first part: keys below it belong there too."""
        return points.where("tile > 1").select("first_key")

    def _write_splits(self, points: DataFrame) -> str:
        name = uuid.uuid4().hex
        points.coalesce(1).write.parquet(f"{self.path}/splits/{name}")
        return name

    def _write_manifest(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        rows.coalesce(1).write.parquet(f"{self.path}/manifest/{name}")
        return name

    def _write(self, rows: DataFrame, splits: Sequence[str], cursor: str | None = None) -> tuple[str, Written]:
        """Rows to the files of their ranges. Tasks take stretches of keys of equal size, so a range
        that many rows fall into is written by several tasks, and several small ones by one."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        # A greater key never lies in a lower range, so rows are dealt by key alone and searched once, where they land.
        ranged = rows.repartitionByRange(ROW_KEY).withColumn(RANGE, range_number(F.col(ROW_KEY), splits))
        placed, seen = observed(ranged.sortWithinPartitions(RANGE, ROW_KEY), cursor)
        wide = placed.drop(cursor) if cursor else placed
        wide.write.partitionBy(RANGE).option("maxRecordsPerFile", ROWS_PER_FILE).parquet(folder)
        return folder, result_of(seen)

    def _note_files(self, folder: str, kept: DataFrame | None = None) -> str:
        """The manifest of the files of one write: only their keys are read."""
        stored = self.spark.read.schema(f"{ROW_KEY} string, {RANGE} int").parquet(folder)
        found = stored.groupBy(F.col("_metadata.file_path").alias("file"), RANGE).agg(
            F.min(ROW_KEY).alias("first_key"),
            F.max(ROW_KEY).alias("last_key"),
            F.count(F.lit(1)).alias("rows"),
            F.max("_metadata.file_size").alias("bytes"),
        )
        return self._write_manifest(found if kept is None else kept.unionByName(found))

    def cut(self) -> list[int]:
        """Cut every range that holds more than its limit; returns their numbers.

        All versions of its records are written again between the new points, under the numbers
        they have, and every other file stays as it is under a new range number. The commit names
        the new files in place of the old ones; a batch that came before it makes this start
        again. A range with nothing but versions of one key cannot be cut and stays.
        """
        while True:
            last, state = self._state()
            manifest = self._manifest(state)
            large = {r[0]: r[1] for r in self._sizes(manifest).where(F.col("bytes") > self.range_bytes).select(RANGE, "bytes").collect()}
            points, finer = self._splits(state["splits"]), {}
            for at, size in large.items():
                rows = self._read(self._files_of(manifest.where(F.col(RANGE) == at)), state)
                sized = rows.select(ROW_KEY, record_bytes(rows).alias("weight"))
                inner = self._inner(weighted_split_points(sized, math.ceil(2 * size / self.range_bytes), "weight"))
                finer[at] = [r[0] for r in inner.toLocalIterator()]
            cut = sorted(at for at in finer if finer[at])
            if not cut:
                return []
            all_points = sorted({*points, *(p for at in cut for p in finer[at])})
            split_by = self._write_splits(self.spark.createDataFrame([(p,) for p in all_points], "first_key string"))
            moved = self._read(self._files_of(manifest.where(F.col(RANGE).isin(cut))), state)
            folder, _ = self._write(moved, all_points)
            kept = manifest.where(~F.col(RANGE).isin(cut))
            kept = kept.withColumn(RANGE, range_number(F.col("first_key"), all_points).cast("int"))
            noted = self._note_files(folder, kept)
            if self.log.claim_at(last + 1, splits=split_by, manifests=[noted], columns=state["columns"]):
                return cut

    @staticmethod
    def _files_of(manifest: DataFrame) -> list[str]:
        return [r[0] for r in manifest.select("file").toLocalIterator()]

    # ---- reading ---------------------------------------------------------------------------

    def files(self, start: str | None = None, stop: str | None = None) -> list[str]:
        """Files whose key bounds meet ``[start, stop)``; one name per file goes to the driver."""
        return self._files_of(self._meeting(self.manifest(), start, stop))

    @staticmethod
    def _meeting(found: DataFrame, start: str | None, stop: str | None) -> DataFrame:
        if start is not None:
            found = found.where(F.col("last_key") >= F.lit(start))
        return found if stop is None else found.where(F.col("first_key") < F.lit(stop))

    def _read(self, files: Sequence[str], state: dict) -> DataFrame:
        """Rows of files, with every column of the table."""
        fields = [T.StructField(c, T.StringType()) for c in (ROW_KEY, *state["columns"])]
        schema = T.StructType([*fields, T.StructField(BATCH, T.LongType())])
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def versions(self, start: str | None = None, stop: str | None = None) -> DataFrame:
        """Every version of the records with keys in ``[start, stop)``."""
        _, state = self._state()
        rows = self._read(self._files_of(self._meeting(self._manifest(state), start, stop)), state)
        if start is not None:
            rows = rows.where(F.col(ROW_KEY) >= F.lit(start))
        return rows if stop is None else rows.where(F.col(ROW_KEY) < F.lit(stop))

    def records(self, start: str | None = None, stop: str | None = None) -> DataFrame:
        """Newest value of every cell, one row per key of the range; no rows before the first batch."""
        rows = self.versions(start, stop)
        return newest_records(rows) if len(rows.columns) > 2 else rows.select(ROW_KEY).distinct()
