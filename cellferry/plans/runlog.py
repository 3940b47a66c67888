"""Run log and cursor table. Events are only ever added; the latest state is a query.

An event is a file of one line in the folder ``tail``. From time to time the events are folded
into a snapshot, a Parquet folder with one row per run or config. The commit that puts a
snapshot in place names the files that it covers, and a read takes the latest snapshot and
those files of the tail that it does not name. So a read opens two folders, however many
events there have been, and an event that is written during a fold is lost by nobody.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from typing import Any
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import newest_records
from ..session import session_time
from ..store import CommitLog, Shared

# Columns of the run log.
LOG_COLUMNS = {
    "id": "string",
    "relaid": "string",
    "hive_tbname": "string",
    "start_time": "timestamp_ntz",
    "app_url": "string",
    "appid": "string",
    "row_nums": "bigint",
    "end_time": "timestamp_ntz",
    "is_success": "string",
    "increment_time": "string",
    "last_update_time": "timestamp_ntz",
}
EVENT_TIME = "event_time"
LOG_SCHEMA = ", ".join(f"{n} {k}" for n, k in [*LOG_COLUMNS.items(), (EVENT_TIME, "timestamp_ntz")])
CURSOR_SCHEMA = "config_id string, cursor string, run_ts timestamp_ntz, version bigint"
# events in the tail beyond which run_all folds them
EVENTS_BEFORE_FOLD = 500


def run_state(events: DataFrame) -> DataFrame:
    """One row per run: of every column the latest value that an event set."""
    return newest_records(events, key="id", batch=EVENT_TIME)


def fold_runs(events: DataFrame) -> DataFrame:
    """The state of every run with the time of its last event: as good as its events for any later state."""
    last = events.groupBy("id").agg(F.max(EVENT_TIME).alias("__last"))
    return run_state(events).join(last, "id").withColumnRenamed("__last", EVENT_TIME)


def runs_per_source(state: DataFrame) -> DataFrame:
    """Runs, successes, failures and rows per source table."""
    outcome = F.col("is_success")
    return state.groupBy("hive_tbname").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(outcome == "1").alias("succeeded"),
        F.count_if(outcome == "0").alias("failed"),
        F.count_if(outcome.isNull()).alias("unfinished"),
        F.coalesce(F.sum("row_nums"), F.lit(0)).alias("rows_moved"),
    )


def current_cursors(history: DataFrame) -> DataFrame:
    """The cursor of the latest version of every config.

    A version is one more than the one it followed, so no clock takes part. Rows without a
    version, from before there were any, come before all others, in the order of their times.
    """
    version = F.col("version") if "version" in history.columns else F.lit(None).cast("bigint")
    latest = F.max(F.struct(F.coalesce(version, F.lit(0)).alias("version"), "run_ts", "cursor"))
    return history.groupBy("config_id").agg(latest["cursor"].alias("cursor"))


def _latest_versions(history: DataFrame) -> DataFrame:
    latest = F.max(F.struct(F.coalesce("version", F.lit(0)).alias("version"), "run_ts", "cursor")).alias("l")
    return history.groupBy("config_id").agg(latest).select("config_id", "l.cursor", "l.run_ts", "l.version")


class _Events:
    """Events in a tail and a snapshot. Any number of jobs may add events at once."""

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.schema: T.StructType = T.StructType.fromDDL(schema)
        self.tail, self.log = Shared(spark, f"{self.path}/tail"), CommitLog(spark, f"{self.path}/log")

    def _fold_rows(self, rows: DataFrame) -> DataFrame:
        raise NotImplementedError

    def _add(self, name: str, **values: Any) -> bool:
        texts = {k: v.isoformat() if isinstance(v, dt.datetime) else v for k, v in values.items() if v is not None}
        return self.tail.create(f"{name}.json", json.dumps(texts, ensure_ascii=False))

    def _snapshot(self) -> dict[str, Any]:
        last = self.log.last()
        return self.log.entry(last).what if last else {"snapshot": None, "covers": [], "before": []}

    def _rows(self, snapshot: dict[str, Any], names: list[str]) -> DataFrame:
        reader = self.spark.read.schema(self.schema)
        parts = [reader.parquet(f"{self.path}/{snapshot['snapshot']}")] if snapshot["snapshot"] else []
        if names:
            parts.append(reader.json([f"{self.path}/tail/{n}" for n in names]))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def rows(self) -> DataFrame:
        """The latest snapshot and the events after it; none before the first event."""
        # the tail is listed first: a file that a fold removes after that is in the snapshot read then
        there, snapshot = self.tail.names(), self._snapshot()
        return self._rows(snapshot, self._open(snapshot, there))

    @staticmethod
    def _open(snapshot: dict[str, Any], there: list[str]) -> list[str]:
        covered = {*snapshot["covers"], *snapshot["before"]}
        return [n for n in there if n not in covered]

    def waiting(self) -> int:
        """Events that no snapshot covers."""
        return len(self._open(self._snapshot(), self.tail.names()))

    def fold(self) -> bool:
        """Write a snapshot of all events there are; False if another fold came first or nothing waits.

        The files that it covers stay for readers of the one before and are removed by the next fold.
        """
        return self._fold(None)

    def take_in(self, events: DataFrame) -> bool:
        """Fold events of a table, such as an older log, together with those there are."""
        return self._fold(events)

    def _fold(self, more: DataFrame | None) -> bool:
        last = self.log.last()
        there, old = self.tail.names(), self._snapshot()
        names = self._open(old, there)
        if not names and more is None:
            return False
        rows = self._rows(old, names)
        if more is not None:
            rows = rows.unionByName(more.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]))
        folder = f"snapshot-{last + 1}-{uuid.uuid4().hex}"
        self._fold_rows(rows).write.parquet(f"{self.path}/{folder}")
        # files of the fold before are named once more: a reader may have listed them just now
        if not self.log.claim_at(last + 1, snapshot=folder, covers=names, before=old["covers"]):
            return False
        for name in old["covers"]:
            self.tail.remove(name)
        for number in [n for n in self.log.numbers() if n < last]:
            Shared(self.spark, self.path).remove(self.log.entry(number).what["snapshot"])
            self.log.drop(number)
        return True


class RunLog(_Events):
    """Start, success and failure events of runs. Times are the session's wall-clock times."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        super().__init__(spark, path, LOG_SCHEMA)

    def _fold_rows(self, rows: DataFrame) -> DataFrame:
        return fold_runs(rows)

    def add(self, **values: Any) -> None:
        self._add(uuid.uuid4().hex, **values)

    def started(self, run_id: str, config_id: str, source: str, app_id: str, app_url: str | None = None) -> None:
        now = session_time(self.spark)
        self.add(
            id=run_id, relaid=config_id, hive_tbname=source, start_time=now, appid=app_id, app_url=app_url, event_time=now
        )

    def succeeded(self, run_id: str, rows: int, cursor: str | None) -> None:
        now = session_time(self.spark)
        self.add(id=run_id, row_nums=rows, end_time=now, is_success="1", increment_time=cursor, event_time=now)

    def failed(self, run_id: str) -> None:
        now = session_time(self.spark)
        self.add(id=run_id, is_success="0", last_update_time=now, event_time=now)

    def state(self) -> DataFrame:
        return run_state(self.rows())


class CursorMoved(RuntimeError):
    """Another run moved the cursor since it was read."""


class CursorTable(_Events):
    """Cursors by config, with the version that each move made.

    A move names the cursor that it follows. It takes the version after the current one by
    creating a file that bears config and version, so of two runs that read the same cursor only
    one can move it.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        super().__init__(spark, path, CURSOR_SCHEMA)

    def _fold_rows(self, rows: DataFrame) -> DataFrame:
        return _latest_versions(rows)

    def moved(self, config_id: str, cursor: str, previous: str | None = None) -> int:
        """Move a cursor and return its version. :class:`CursorMoved` if it is not ``previous`` any more.

        Without ``previous`` the cursor is set from whatever it is; so it is where none is stored yet.
        """
        now = _latest_versions(self.rows()).where(F.col("config_id") == config_id).first()
        if now is not None and previous is not None and now.cursor != previous:
            raise CursorMoved(f"the cursor of config {config_id} is {now.cursor}, not {previous}")
        version = (now.version if now is not None else 0) + 1
        name = f"of-{quote(config_id, safe='')}@{version:012d}"
        if not self._add(name, config_id=config_id, cursor=cursor, run_ts=session_time(self.spark), version=version):
            raise CursorMoved(f"version {version} of the cursor of config {config_id} was taken meanwhile")
        return version

    def current(self) -> DataFrame:
        return current_cursors(self.rows())
