"""Whole jobs. Functions that return a DataFrame are lazy; ``run_*`` start jobs."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canonical import TextRules, canonical
from ..functions.dates import digits14
from ..functions.text import blank_to
from ..operators.dedupe import batch_metrics, keep_latest
from ..operators.keys import random_key, row_key
from ..operators.layout import SAMPLE_FRACTION, sample_keys, sample_keys_by_hash, union_distinct
from ..operators.typemap import cast_for_sink
from ..operators.windows import CURSOR_FORMAT, cursor_time, in_window, next_cursor, next_cursor_column, saved
from ..session import session_time
from ..sinks.files import Written, append_rows, write_lines, write_sorted_cells
from ..sinks.keyed import KeyedTable
from ..sources.tables import ROW_KEY, key_range, project, read_cell, read_table
from .control import JobControl
from .runlog import EVENTS_BEFORE_FOLD, CursorTable, RunLog
from .spec import JobSpec

CURSOR_TIME = "__cursor_time"
Sink = Callable[[DataFrame, JobSpec], Written]


def _projected(df: DataFrame, columns: str) -> DataFrame:
    return project(df, columns if columns.strip() not in ("", "*") else None)


def keyed_records(
    batch: DataFrame, keys: str, rules: TextRules = TextRules(), upper_case: bool = False, latest_by: Sequence[Column | str] = ()
) -> DataFrame:
    """One canonical record per row key: the latest row, columns in name order.

    Rows are kept or dropped before their values become text, so only winners are cleaned.
    A :data:`CURSOR_TIME` column in the batch is carried along as it is.
    """
    values = sorted(c for c in batch.columns if c != CURSOR_TIME)
    if ROW_KEY in {v.lower() for v in values}:
        raise ValueError(f"the batch has a column named {ROW_KEY} already")
    named = [v.upper() if upper_case else v.lower() for v in values]
    if len({n.lower() for n in named}) != len(named):
        raise ValueError(f"names collide when their case is changed: {values}")
    keyed = batch.select(row_key(batch, keys, rules).alias(ROW_KEY), "*")
    kept = keep_latest(keyed, ROW_KEY, latest_by)
    texts = [canonical(kept, v, "", rules).alias(n) for v, n in zip(values, named)]
    carried = [CURSOR_TIME] if CURSOR_TIME in batch.columns else []
    return kept.select(ROW_KEY, *texts, *carried)


def export_batch(spark: SparkSession, spec: JobSpec) -> DataFrame:
    """Rows of the job's window, projected, with the cursor's time as an extra column.

    The cursor is read from the source, so it need not be in the column list, and neither
    name case nor clean-up touches it.
    """
    source = read_table(spark, spec.source)
    if not spec.cursor_column:
        return _projected(source, spec.columns).withColumn(CURSOR_TIME, F.lit(None).cast("timestamp_ntz"))
    windowed = in_window(source, spec.cursor_column, spec.window(), spec.cursor_type, day_column=spec.day_column or None)
    timed = windowed.withColumn(CURSOR_TIME, cursor_time(windowed, spec.cursor_column))
    if spec.columns.strip() in ("", "*"):
        return timed
    return project(timed, f"{spec.columns}, {CURSOR_TIME}")


def export_records(spark: SparkSession, spec: JobSpec) -> DataFrame:
    """Incremental keyed export: window, row key, keep the latest, canonical values."""
    batch = export_batch(spark, spec)
    return keyed_records(batch, spec.keys, spec.rules(), spec.upper_case, latest_by=[CURSOR_TIME])


def append_rows_of(spark: SparkSession, spec: JobSpec) -> DataFrame:
    """Incremental relational append: rows after the cursor, in database types."""
    source = read_table(spark, spec.source)
    if spec.cursor_column:
        days = spec.day_column or None
        source = in_window(source, spec.cursor_column, spec.window(inclusive=False), spec.cursor_type, rule="append", day_column=days)
    return cast_for_sink(_projected(source, spec.columns))


def reload_records(source: DataFrame, keys: str, columns: str = "*") -> DataFrame:
    """Relational to keyed reload: all rows, row key, keep one, canonical values; no cursor."""
    return keyed_records(_projected(source, columns), keys)


def full_load_records(source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full load of a few columns under random keys, blank values as empty text."""
    texts = [blank_to(F.col(f"`{c}`").cast("string")).alias(c) for c in columns]
    return source.select(random_key().alias(ROW_KEY), *texts)


def distinct_identifiers(
    scans: Iterable[DataFrame], start: str, stop: str, qualifier: str, day_column: str | None = None
) -> DataFrame:
    """Distinct values of one cell over the key range of several keyed tables."""
    parts = [read_cell(key_range(scan, start, stop, day_column=day_column), qualifier, qualifier) for scan in scans]
    return union_distinct(*parts)


def export_keys(spark: SparkSession, spec: JobSpec) -> DataFrame:
    """Row keys of a job's window."""
    batch = export_batch(spark, spec)
    return batch.select(row_key(batch, spec.keys, spec.rules()).alias(ROW_KEY))


def export_metrics(spark: SparkSession, spec: JobSpec, run_time: dt.datetime | None = None) -> DataFrame:
    """What an export would report: keys, emptiness, next cursor. One row, nothing written.

    The latest row of a key has the key's greatest cursor, so only keys and cursors are read
    and shuffled, not the records.
    """
    batch = export_batch(spark, spec)
    keyed = batch.select(row_key(batch, spec.keys, spec.rules()).alias(ROW_KEY), CURSOR_TIME)
    metrics = batch_metrics(keyed.groupBy(ROW_KEY).agg(F.max(CURSOR_TIME).alias(CURSOR_TIME)), F.col(CURSOR_TIME))
    window = spec.window()
    top = digits14(F.col("greatest"))
    after = next_cursor_column(
        top, F.lit(saved(window.start) if window.start else None), F.lit(window.stop), spec.policy,
        F.lit((run_time or session_time(spark)).strftime(CURSOR_FORMAT)),
    )
    return metrics.select(
        F.lit(spec.config_id).alias("config_id"),
        F.lit(spec.source).alias("source"),
        "key_count",
        "is_empty",
        after.alias("next_cursor"),
    )


def all_metrics(spark: SparkSession, specs: Iterable[JobSpec], run_time: dt.datetime | None = None) -> DataFrame:
    """Metrics of several jobs, one row each."""
    return reduce(DataFrame.unionByName, [export_metrics(spark, s, run_time) for s in specs])


# ---- sinks of an export ------------------------------------------------------------------


def keyed_table_sink(spark: SparkSession, buckets: int) -> Sink:
    """Upsert into the keyed table that the job names."""

    def put(records: DataFrame, spec: JobSpec) -> Written:
        name = spec.target.upper() if spec.upper_case else spec.target
        table = KeyedTable(spark, name, buckets, spec.family())
        return table.put(records, cursor=CURSOR_TIME)

    return put


def sorted_cells_sink(folder: str) -> Sink:
    """Write the batch as sorted cell files below a folder, for a bulk load."""

    def put(records: DataFrame, spec: JobSpec) -> Written:
        stamp = f"{session_time(records.sparkSession):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"
        return write_sorted_cells(records, f"{folder}/{spec.target}/{stamp}", cursor=CURSOR_TIME, family=spec.family())

    return put


# ---- runs --------------------------------------------------------------------------------


@dataclass(frozen=True)
class JobResult:
    """Outcome of one run. ``rows`` is the number of keys or rows written, ``written`` says that data was."""

    config_id: str
    source: str
    rows: int
    cursor: str | None
    is_success: bool
    error: str = ""
    written: bool = False


def run_export(spark: SparkSession, spec: JobSpec, sink: Sink, run_time: dt.datetime | None = None) -> JobResult:
    """Write one batch, then work out the next cursor from what was written.

    Row count and greatest cursor are observed in the write job; nothing is scanned twice.
    """
    begun = run_time or session_time(spark)
    written = sink(export_records(spark, spec), spec)
    cursor = next_cursor(written.greatest, spec.window(), spec.policy, begun)
    return JobResult(spec.config_id, spec.source, written.rows, cursor, True, written=True)


def run_append(spark: SparkSession, spec: JobSpec, sink: Sink) -> JobResult:
    """Append the rows after the cursor. The cursor is not moved."""
    written = sink(append_rows_of(spark, spec), spec)
    return JobResult(spec.config_id, spec.source, written.rows, spec.cursor or None, True, written=True)


def run_reload(source: DataFrame, keys: str, table: KeyedTable, columns: str = "*") -> Written:
    """Reload a keyed table from a relational scan."""
    return table.put(reload_records(source, keys, columns), load=True)


def run_full_load(source: DataFrame, columns: Sequence[str], path: str) -> Written:
    """Write a few columns under random keys as sorted cells."""
    return write_sorted_cells(full_load_records(source, columns), path)


def run_distinct(identifiers: DataFrame, path: str, files: int | None = None) -> None:
    """Write an identifier list as text, one per line."""
    write_lines(identifiers, path, files)


def run_sample(
    spark: SparkSession, spec: JobSpec, path: str, fraction: float = SAMPLE_FRACTION, repeatable: bool = True, seed: int | None = None
) -> Written:
    """Sample the row keys of a job's window and append them to a table."""
    keys = export_keys(spark, spec)
    sampled = sample_keys_by_hash(keys, fraction) if repeatable else sample_keys(keys, fraction, seed)
    return append_rows(sampled.select(F.col(ROW_KEY).alias("rowkey")), path)


def run_logged(
    spark: SparkSession,
    spec: JobSpec,
    run: Callable[[JobSpec], JobResult],
    log: RunLog,
    cursors: CursorTable | None = None,
    control: JobControl | None = None,
) -> JobResult:
    """Run one job between a start event and a success or failure event.

    The cursor moves after the data is written, so a crash in between repeats a window and
    never skips one. Nothing is raised: an error of the job, of the log or of the cursor table
    makes the result a failure, and ``written`` says whether the data had been written before.
    So does a ``control`` that stops the job. The move names the cursor that the job began with:
    if another run moved it meanwhile, this one fails and leaves it where it is.
    """
    run_id = str(uuid.uuid4())
    context = spark.sparkContext
    result = JobResult(spec.config_id, spec.source, 0, spec.cursor or None, False)
    try:
        log.started(run_id, spec.config_id, spec.source, context.applicationId, context.uiWebUrl)
        result = run(spec) if control is None else control.watched(spec.config_id, lambda: run(spec))
        if cursors is not None and result.cursor and result.cursor != spec.cursor:
            cursors.moved(spec.config_id, result.cursor, spec.cursor or None)
        log.succeeded(run_id, result.rows, result.cursor)
        return result
    except Exception as error:
        errors = [str(error)]
    try:
        log.failed(run_id)
    except Exception as error:
        errors.append(str(error))
    return replace(result, is_success=False, error="; ".join(errors))


def run_all(
    spark: SparkSession,
    specs: Iterable[JobSpec],
    run: Callable[[JobSpec], JobResult],
    log: RunLog,
    cursors: CursorTable | None = None,
    at_once: int = 1,
    time_limit: float | None = None,
    control: JobControl | None = None,
) -> list[JobResult]:
    """Run every job in one session; a failed job does not stop the others.

    With ``at_once`` above 1, small jobs fill the cluster side by side, each in a pool of its own,
    so that a fair scheduler (``spark.scheduler.mode``) shares the executors among them. Jobs with
    the same target still run one after the other, since they write to one place. A job that runs
    longer than ``time_limit`` seconds is ended and fails, as is one that ``control`` stops.
    """
    own = control or JobControl(spark, time_limit)
    by_target: dict[str, list[JobSpec]] = {}
    for spec in specs:
        by_target.setdefault(spec.target.lower(), []).append(spec)

    def in_turn(group: list[JobSpec]) -> list[JobResult]:
        return [run_logged(spark, spec, run, log, cursors, own) for spec in group]

    with own, ThreadPoolExecutor(max(1, at_once)) as pool:
        # each thread has properties of its own: one wrapped function would share them, and with them the tags
        done = [pool.submit(inheritable_thread_target(spark)(in_turn), group) for group in by_target.values()]
        results = [result for group in done for result in group.result()]
    for events in (log, cursors):
        if isinstance(events, (RunLog, CursorTable)) and events.waiting() > EVENTS_BEFORE_FOLD:
            events.fold()
    return results


def run_until_current(
    spark: SparkSession,
    spec: JobSpec,
    sink: Sink,
    run_time: dt.datetime | None = None,
    log: RunLog | None = None,
    cursors: CursorTable | None = None,
) -> Iterator[JobResult]:
    """Run windows one after the other until the cursor stops moving; yields each as it ends.

    With a log and a cursor table, every window is logged and leaves its cursor, so that a run
    which breaks off goes on at its last window. A failed window is the last one.
    """
    begun = run_time or session_time(spark)
    while True:

        def one(at: JobSpec) -> JobResult:
            return run_export(spark, at, sink, begun)

        result = run_logged(spark, spec, one, log, cursors) if log is not None else one(spec)
        yield result
        if not result.is_success or not result.cursor or result.cursor == saved(spec.cursor):
            return
        spec = spec.at(result.cursor)
