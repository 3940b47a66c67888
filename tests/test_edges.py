"""Inputs at the edges that used to lose or shift rows without a word."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from cellferry.functions.canonical import TextRules, canonical
from cellferry.operators import typemap, upsert, windows
from cellferry.plans import jobs
from cellferry.plans.runlog import CursorTable, RunLog
from cellferry.plans.spec import JobSpec, specs_from
from cellferry.session import session_time
from cellferry.sinks.keyed import KeyedTable, buckets_for
from cellferry.sources.tables import key_range
from plans_of import ROOT, plan_of

W = windows.CursorWindow


@pytest.mark.parametrize("value", ["1e16", "-1e15", "'NaN'", "'Infinity'"])
def test_a_fraction_that_does_not_fit_is_an_error_and_is_counted(spark, value):
    df = spark.sql(f"SELECT CAST({value} AS DOUBLE) AS v UNION ALL SELECT 1.23456D UNION ALL SELECT NULL")
    with pytest.raises(Exception, match="column v"):
        typemap.cast_for_sink(df).collect()
    row = typemap.sink_report(df).first()
    assert (row.misfits, row.rounded) == (1, 1)


def test_cut_parts_of_a_second_are_counted(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00.5' AS t UNION ALL SELECT TIMESTAMP_NTZ '2024-01-01 00:00:01'")
    assert typemap.sink_report(df).first().rounded == 1


@pytest.mark.parametrize("stop", ["2024011", "202401", "2024-01-10", "20240199"])
def test_a_stop_that_is_no_day_drops_nothing(spark, stop):
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-31')) AS d")
    keyed = days.withColumn("row_key", F.concat(F.date_format("d", "yyyyMMdd"), F.lit("_x")))
    wide = key_range(keyed, "20240101", stop, day_column="d").count()
    assert wide == key_range(keyed, "20240101", stop).count()


def test_blank_type_on_printed_text_exports_rows(spark):
    df = spark.createDataFrame([("2024-01-11 00:00:00",), ("2024-01-12 00:00:00",), ("2024-01-13 05:00:00",)], "c string")
    window = W.of("20240112000000")
    assert windows.in_window(df, "c", window, "").count() == 2
    assert windows.in_window(df, "c", window, "timestamp").count() == 2
    raw = spark.createDataFrame([("20240111",), ("20240113",)], "c string")
    assert windows.in_window(raw, "c", W.of("20240112000000", inclusive=False), "", rule="append").count() == 1
    assert windows.in_window(raw, "c", window, "String").count() == 1


def test_day_bounds_inside_a_day(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-20')) AS d")
    times = days.select(F.col("d").cast("timestamp_ntz").alias("d"))
    for inclusive in (True, False):
        window = W.of("20240105120000", 3, inclusive)
        assert windows.in_window(days, "d", window).count() == windows.in_window(times, "d", window).count() == 3


CLOCK = """
import sys; sys.path[:0] = [{root!r}]
from cellferry.session import local_session
from cellferry.operators.windows import CursorWindow, in_window
spark = local_session(1, "1g", spark__sql__session__timeZone={zone!r})
for kind in ("timestamp_ntz", "timestamp"):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ '2024-03-30 00:00:00', TIMESTAMP_NTZ '2024-04-02 00:00:00', INTERVAL 1 HOUR)) AS c")
    print(in_window(df.select(df.c.cast(kind).alias("c")), "c", CursorWindow.of("20240331000000", 1)).count())
"""


@pytest.mark.parametrize("zone, hours", [("UTC", [24, 24]), ("Europe/Berlin", [24, 24])])
def test_bounds_do_not_follow_the_process_zone(zone, hours):
    code = CLOCK.format(root=ROOT, zone=zone)
    env = os.environ | {"TZ": "Asia/Shanghai"}
    told = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=200)
    assert [int(x) for x in told.stdout.split()] == hours, told.stderr[-500:]


def test_the_run_time_is_the_session_clock(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        ahead = session_time(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert dt.timedelta(hours=7) < ahead - session_time(spark) < dt.timedelta(hours=9)


def test_a_reserved_column_is_refused_and_batch_no_is_kept(spark, tmp_path):
    record = spark.createDataFrame([("k", "5", "x")], "row_key string, batch_no string, v string")
    assert upsert.upsert_records(record, record.withColumn("v", F.lit("y"))).first().batch_no == "5"
    table = KeyedTable(spark, "edge_batches", 2)
    table.put(record, 1)
    assert table.records().first().batch_no == "5"
    with pytest.raises(ValueError, match="reserved"):
        table.put(record.withColumnRenamed("v", upsert.BATCH.upper()), 2)


def test_a_load_is_as_wide_as_the_buckets(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as row_key", "'v' as v")
    assert df.repartition(64, "row_key").rdd.getNumPartitions() == 64
    table = KeyedTable(spark, "edge_loaded", 16)
    assert table.put(df, 1, load=True).rows == 1000
    assert table.records().count() == 1000 and not table.needs_compaction()
    table.put(df, 2)
    assert table.needs_compaction(most=1)
    assert buckets_for(1000 << 40) == 1_024_000


def test_numeric_identity_numbers_are_upgraded(spark):
    df = spark.sql("SELECT 910101851231123L AS n")
    text = canonical(df, "n", "", TextRules(id_columns=("n",)))
    assert len(df.select(text.alias("t")).first().t) == 18


def _job(tmp_path, spark, **settings):
    rows = spark.sql(
        "SELECT id AS k, TIMESTAMP_NTZ '2024-01-01 06:00:00' + make_dt_interval(cast(id as int)) AS ts FROM range(6)"
    )
    rows.write.mode("overwrite").parquet(str(tmp_path / "source"))
    return JobSpec(source=str(tmp_path / "source"), target="edge", keys="k", cursor_column="ts", config_id="c1", step_days="2", **settings)


NOW = dt.datetime(2024, 2, 1)


def test_metric_and_run_agree_on_the_cursor(spark, tmp_path):
    sink = jobs.sorted_cells_sink(str(tmp_path / "out"))
    for policy in windows.POLICIES:
        for cursor in ("20240101", "2024-01-03", "20240120"):
            job = _job(tmp_path, spark, cursor=cursor, policy=policy)
            told = jobs.export_metrics(spark, job, NOW).first().next_cursor
            assert told == jobs.run_export(spark, job, sink, NOW).cursor, (policy, cursor)


def test_metrics_read_only_keys_and_cursors(spark, tmp_path):
    plan = plan_of(jobs.export_metrics(spark, _job(tmp_path, spark, cursor="20240101"), NOW))
    assert "Window" not in plan and "Sort" not in plan


def test_two_runs_export_two_windows(spark, tmp_path):
    job = _job(tmp_path, spark, cursor="20240101")
    log, cursors = RunLog(spark, str(tmp_path / "log")), CursorTable(spark, str(tmp_path / "cursors"))
    sink = jobs.sorted_cells_sink(str(tmp_path / "out"))
    row = [("c1", job.source, "k", "edge", "ts", "20240101", "2")]
    schema = "id string, hive_tbname string, rowkey string, hbase_tbname string, hive_columns_cjsj string, hive_columns_cjsj_lasttime string, time_step_num string"
    configs = spark.createDataFrame(row, schema)
    seen = []
    for _ in range(2):
        specs = list(specs_from(configs, cursors=cursors.current()))
        result = jobs.run_all(spark, specs, lambda s: jobs.run_export(spark, s, sink, NOW), log, cursors)[0]
        assert result.is_success and result.written
        seen.append(result.cursor)
    assert seen == ["20240102060000", "20240103060000"]  # the second window begins at the first one's last row


def test_a_run_that_breaks_off_goes_on_where_it_stopped(spark, tmp_path):
    job = _job(tmp_path, spark, cursor="20240101")
    log, cursors = RunLog(spark, str(tmp_path / "log")), CursorTable(spark, str(tmp_path / "cursors"))
    good, calls = jobs.sorted_cells_sink(str(tmp_path / "out")), []

    def sink(records, spec):
        calls.append(spec.cursor)
        if len(calls) == 3:
            raise OSError("lost")
        return good(records, spec)

    first = list(jobs.run_until_current(spark, job, sink, NOW, log, cursors))
    assert [r.is_success for r in first] == [True, True, False] and not first[-1].written
    again = job.at(cursors.current().first().cursor)
    assert again.cursor == calls[2]
    assert all(r.is_success for r in jobs.run_until_current(spark, again, sink, NOW, log, cursors))
    assert cursors.current().first().cursor > "20240106"


class BrokenLog:
    def __init__(self, at):
        self.at = at

    def __getattr__(self, name):
        def event(*args, **named):
            if name == self.at and args[1:2] in ((), ("bad",), (1,)):
                raise OSError(f"no {name}")

        return event


def test_errors_of_log_and_cursors_stay_with_their_job(spark, tmp_path):
    job = _job(tmp_path, spark, cursor="20240101")

    def run(spec):
        return jobs.JobResult(spec.config_id, spec.source, 1, "20240102000000", True, written=True)

    for at, written in (("succeeded", True), ("started", False)):
        log = BrokenLog(at)
        specs = [jobs.replace(job, config_id="bad"), jobs.replace(job, config_id="bad", target="other")]
        results = jobs.run_all(spark, specs, run, log)
        assert len(results) == 2
        assert [(r.is_success, r.written) for r in results] == [(False, written)] * 2
        assert f"no {at}" in results[0].error
