"""A keyed table: batches are appended, reads see the newest value of every cell.

The table is bucketed by row key, so a read merges the versions of a key where they lie:
no shuffle, whatever the table's size. A batch adds at most one file per bucket and never
rewrites older files, so its cost follows the batch, not the table. Choose the number of
buckets by the size that the table will reach (:func:`buckets_for`): it stays fixed.

Batches are ordered by number, and a writer takes its number from a commit log by creating
an entry that nobody else can create, before it writes. No clock takes part: of two batches
the one that took its number later wins. The log also holds the pointer to the table in
which the rows lie, so that a compacted table takes its place in one step.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cells import FAMILY
from ..operators.upsert import BATCH, newest_records, refuse_reserved
from ..sources.tables import ROW_KEY
from ..store import ABANDONED, DONE, CommitLog
from .files import Written, observed, record_bytes, result_of

# Fixed value: width of the per-key step when none is given.
BUCKETS = 500
# a read takes one task per bucket
BYTES_PER_BUCKET = 1 << 30
# where a first batch is at hand; a compaction sorts all versions of a bucket in one task, in about ten times these bytes
BATCH_BYTES_PER_BUCKET = 1 << 25
# a read merges the versions in a bucket; beyond so many files it pays to write them as one
FILES_BEFORE_COMPACTION = 50

_BUCKET_FILE = re.compile(r"_(\d{5,})(?:\.[^/]*)?$")


def buckets_for(table_bytes: int) -> int:
    """Number of buckets for a table that will grow to this size."""
    return max(1, -(-table_bytes // BYTES_PER_BUCKET))


def buckets_for_batch(records: DataFrame) -> int:
    """Number of buckets for a table whose batches are about as large as this one; the records are read to be sized."""
    total = records.agg(F.sum(record_bytes(records))).first()[0] or 0
    return max(1, -(-total // BATCH_BYTES_PER_BUCKET))


class KeyedTable:
    """One row per key and batch: ``row_key``, one text column per qualifier, the batch's number.

    ``log_path`` is the folder of the commit log; by default it lies in the warehouse under the
    table's name. ``name`` is what readers ask for; :meth:`stored_in` is the catalog table that
    holds the rows at present.
    """

    def __init__(
        self, spark: SparkSession, name: str, buckets: int = BUCKETS, family: str = FAMILY, log_path: str | None = None
    ) -> None:
        self.spark, self.name, self.buckets, self.family = spark, name, buckets, family
        folder = log_path or f"{spark.conf.get('spark.sql.warehouse.dir')}/_logs/{name.lower()}"
        self.log = CommitLog(spark, folder)

    def stored_in(self) -> str:
        """The catalog table that holds the rows now: every entry of the log carries it on."""
        last = self.log.last()
        return self.log.entry(last).what["table"] if last else self.name

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.stored_in())

    def create(self, qualifiers: Sequence[str]) -> bool:
        """Create the table if it is missing; False without a family or qualifiers."""
        return self._create(self.stored_in(), qualifiers)

    def _create(self, stored: str, qualifiers: Sequence[str]) -> bool:
        if not self.family or not qualifiers:
            return False
        cells = ", ".join(f"`{q}` STRING" for q in sorted(qualifiers))
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {stored} ({ROW_KEY} STRING, {cells}, {BATCH} BIGINT) USING parquet "
            f"CLUSTERED BY ({ROW_KEY}) SORTED BY ({ROW_KEY}) INTO {self.buckets} BUCKETS"
        )
        return True

    def _widen(self, stored: str, qualifiers: Sequence[str]) -> None:
        """Columns for qualifiers that the table does not have yet."""
        known = {c.lower() for c in self.spark.table(stored).columns}
        added = [q for q in qualifiers if q.lower() not in known]
        if added:
            self.spark.sql(f"ALTER TABLE {stored} ADD COLUMNS ({', '.join(f'`{q}` STRING' for q in added)})")

    def _claim(self, **what: Any) -> int:
        """The next number; in a table from before the log, the first one after its latest batch."""
        while True:
            last, stored = self.log.last(), self.stored_in()
            number = (last or self.last_batch()) + 1
            if self.log.claim_at(number, table=stored, **what):
                return number

    def put(self, records: DataFrame, batch_no: int | None = None, cursor: str | None = None, load: bool = False) -> Written:
        """Append one batch of records with unique keys.

        The batch takes the next number of the log. With ``batch_no`` it takes that one, which may
        have been taken by an earlier try of the same batch: putting it twice changes nothing. A
        batch that breaks off is seen by no reader; it is put again by its number or given up with
        :meth:`abandon`. It is written by as many tasks as a shuffle has; a ``load``, which fills
        the whole table, by one task per bucket.
        """
        refuse_reserved(records)
        qualifiers = [c for c in records.columns if c not in (ROW_KEY, cursor)]
        if not self.exists() and not self.create(qualifiers):
            raise ValueError(f"{self.name} needs a family and at least one qualifier")
        if batch_no is None:
            number = self._claim(put=True)
        else:
            number = batch_no
            self.log.claim_at(number, put=True, table=self.stored_in())
        if self.log.settled().get(number) == ABANDONED:
            raise ValueError(f"batch {number} of {self.name} was given up")
        stored = self.stored_in()  # stays as it is until this batch is settled
        written = self._append(stored, records, number, qualifiers, cursor, load)
        if not self.log.settle(number, DONE) and self.log.settled().get(number) == ABANDONED:
            raise ValueError(f"batch {number} of {self.name} was given up while it was written")
        return written

    def _append(
        self, stored: str, records: DataFrame, number: int | None, qualifiers: Sequence[str], cursor: str | None, load: bool
    ) -> Written:
        self._create(stored, qualifiers)
        self._widen(stored, qualifiers)
        # a bucket's rows meet in one task, so that a batch adds one file to each bucket;
        # how many buckets share a task is left to adaptive execution
        bucket = F.pmod(F.hash(ROW_KEY), F.lit(self.buckets))
        spread = records.repartition(self.buckets, ROW_KEY) if load else records.repartition(bucket)
        passing, seen = observed(spread, cursor)
        given = {c.lower(): c for c in records.columns}
        columns = []
        for name in self.spark.table(stored).columns:
            if name == BATCH and number is not None:
                columns.append(F.lit(number).cast("bigint").alias(BATCH))
            elif name.lower() in given:
                columns.append(F.col(f"`{given[name.lower()]}`").alias(name))
            else:
                columns.append(F.lit(None).cast("string").alias(name))
        (
            passing.select(*columns)
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, ROW_KEY)
            .sortBy(ROW_KEY)
            .saveAsTable(stored)
        )
        return result_of(seen)

    def unfinished(self) -> list[int]:
        """Numbers that a writer took and has not settled: it is still writing, or it is gone."""
        settled = self.log.settled()
        return [n for n in self.log.numbers() if n not in settled and self.log.entry(n).what.get("put")]

    def abandon(self, number: int) -> bool:
        """Give a batch up whose writer is gone; False if it ended after all. Its rows stay unseen."""
        return self.log.settle(number, ABANDONED)

    def _versions(self, stored: str, up_to: int | None = None) -> DataFrame:
        """Rows of finished batches. The numbers left out are few: they name writers, not rows."""
        settled = self.log.settled()  # before the numbers: an entry is forgotten before its outcome
        open_ones = [n for n in self.log.numbers() if settled.get(n) != DONE]
        rows = self.spark.table(stored)
        rows = rows.where(~F.col(BATCH).isin(open_ones)) if open_ones else rows
        return rows if up_to is None else rows.where(F.col(BATCH) <= up_to)

    def records(self) -> DataFrame:
        """Newest value of every cell, one row per key. Key bounds on it reach the scan.

        The table is resolved now: a frame that was made before a compaction keeps reading the
        rows that it was made over.
        """
        return newest_records(self._versions(self.stored_in()))

    def cells(self) -> DataFrame:
        """Newest cells; cells that were never written are left out."""
        wide = self.records()
        long = wide.unpivot(ROW_KEY, [c for c in wide.columns if c != ROW_KEY], "qualifier", "value")
        return long.where(F.col("value").isNotNull()).select(ROW_KEY, F.lit(self.family).alias("family"), "qualifier", "value")

    def last_batch(self) -> int:
        """The greatest number taken, 0 before the first batch."""
        if self.log.last() or not self.exists():
            return self.log.last()
        return self.spark.table(self.name).agg(F.max(BATCH)).first()[0] or 0  # from before the log

    def files_per_bucket(self) -> dict[int, int]:
        """Files by bucket, from the listing of the table's folder; no file is opened."""
        if not self.exists():
            return {}
        found = [_BUCKET_FILE.search(unquote(f)) for f in self.spark.table(self.stored_in()).inputFiles()]
        return dict(Counter(int(hit.group(1)) for hit in found if hit))

    def needs_compaction(self, most: int = FILES_BEFORE_COMPACTION) -> bool:
        """Whether a bucket has more than ``most`` files."""
        return max(self.files_per_bucket().values(), default=0) > most

    def compact(self) -> str:
        """Write the newest records as one version and point readers to them; returns the table left behind.

        Batches that end while the newest records are written are carried over before the switch,
        which is an entry of the log like any batch: a writer has its number either before it, and
        is carried over, or after it, and writes to the new table. The old table is not touched;
        drop it when no reader is left. An unfinished batch is an error: wait for it or
        :meth:`abandon` it.
        """
        self._refuse_unfinished()
        old = self.stored_in()
        base = seen = self._claim(base=True)
        self.log.settle(base, DONE)
        self._refuse_unfinished()
        new = f"{self.name}__v{base}"
        newest = newest_records(self._versions(old, up_to=base))
        self._append(new, newest, base, [c for c in newest.columns if c != ROW_KEY], None, load=True)
        while not self.log.claim_at(seen + 1, table=new, switch=True):
            last = self.log.last()
            self._refuse_unfinished()
            later = self._versions(old, up_to=last).where(F.col(BATCH) > seen)
            self._append(new, later, None, [c for c in later.columns if c not in (ROW_KEY, BATCH)], None, load=False)
            seen = last
        self.log.settle(seen + 1, DONE)
        self.log.forget(base)
        return old

    def _refuse_unfinished(self) -> None:
        open_ones = self.unfinished()
        if open_ones:
            raise RuntimeError(f"batches {sorted(open_ones)} of {self.name} are not finished")

    def compact_into(self, name: str) -> KeyedTable:
        """Write the newest records as batch 1 of another table, and return that one."""
        other = KeyedTable(self.spark, name, self.buckets, self.family)
        other.put(self.records(), 1, load=True)
        return other
