"""Whole jobs over the small tables: windows, logs, cursors, failures."""

import datetime as dt
import json
import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from plans_of import plan_of
from pyspark.sql import functions as F

from cellferry.operators import windows
from cellferry.plans import jobs, runlog
from cellferry.plans.control import JobControl
from cellferry.plans.runlog import CursorTable, RunLog
from cellferry.plans.spec import APPEND_COLUMNS, JobSpec, from_config_json, specs_from, to_config_json
from cellferry.session import session_time
from cellferry.sinks.files import Written, append_rows
from cellferry.sinks.keyed import KeyedTable

NOW = dt.datetime(2024, 3, 1)


def rows_of(df):
    return {r.row_key: r.asDict() for r in df.collect()}


@pytest.fixture
def spec(small):
    return JobSpec(
        source=f"{small}/events.parquet",
        keys="user_id,event_type",
        columns="event_id, user_id, event_type, ts",
        cursor_column="TS",
        config_id="7",
    )


def test_windows_one_by_one_equal_a_full_load(spark, spec):
    whole = rows_of(jobs.export_records(spark, spec).drop(jobs.CURSOR_TIME))
    chained = JobSpec(**{**vars(spec), "target": "chained", "cursor": "20231220000000", "step_days": "9"})
    results = list(jobs.run_until_current(spark, chained, jobs.keyed_table_sink(spark, 4), NOW))
    assert rows_of(KeyedTable(spark, "chained", 4).records()) == whole
    cursors = [r.cursor for r in results]
    assert cursors == sorted(cursors) and results[0].rows == 0 and results[0].cursor == "20231229000000"
    assert results[-1].cursor == NOW.strftime("%Y%m%d%H%M%S")


def test_a_gap_longer_than_the_step_does_not_stall(spark, spec, small, tmp_path):
    gap = str(tmp_path / "gap")
    spark.read.parquet(f"{small}/events.parquet").where("ts < '2024-01-06' or ts > '2024-01-20'").write.parquet(gap)
    job = JobSpec(**{**vars(spec), "source": gap, "target": "gap_target", "cursor": "20240103000000", "step_days": "6"})
    results = list(jobs.run_until_current(spark, job, jobs.keyed_table_sink(spark, 2), NOW))
    assert 0 in [r.rows for r in results]
    target = KeyedTable(spark, "gap_target", 2)
    expected = jobs.export_records(spark, JobSpec(**{**vars(job), "step_days": ""})).count()
    assert target.records().count() == expected and results[-1].cursor == "20240301000000"


def test_the_cursor_does_not_need_to_be_exported(spark, spec):
    job = JobSpec(**{**vars(spec), "columns": "user_id, event_type, upper(event_type) as kind", "upper_case": True})
    record = jobs.export_records(spark, job)
    assert record.columns == ["row_key", "EVENT_TYPE", "KIND", "USER_ID", jobs.CURSOR_TIME]
    top = spark.read.parquet(spec.source).agg(F.max("ts")).first()[0]
    assert record.agg(F.max(jobs.CURSOR_TIME)).first()[0] == top


def test_job_without_a_cursor_column(spark, spec):
    job = JobSpec(source=spec.source, keys="user_id")
    assert jobs.export_records(spark, job).count() == spark.read.parquet(spec.source).select("user_id").distinct().count()


def test_columns_that_clash(spark, spec):
    with pytest.raises(ValueError, match="row_key"):
        jobs.export_records(spark, JobSpec(source=spec.source, keys="user_id", columns="user_id, ts as row_key"))


def test_append_is_exclusive_and_keeps_the_cursor(spark, spec, tmp_path):
    events = spark.read.parquet(spec.source)
    at = dt.datetime(2024, 1, 9)
    job = JobSpec(source=spec.source, columns="event_id, ts, value", cursor_column="ts", cursor=at.strftime("%Y%m%d%H%M%S"))
    result = jobs.run_append(spark, job, lambda df, s: append_rows(df, str(tmp_path / "out")))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert result.rows == back.count() == events.where(F.col("ts") > F.lit(at)).count()
    assert result.cursor == job.cursor and dict(back.dtypes)["value"] == "decimal(19,4)"


def test_reload_sample_and_distinct(spark, spec, small, tmp_path):
    suppliers = spark.read.parquet(f"{small}/supplier.parquet")
    table = KeyedTable(spark, "reloaded", 2)
    assert jobs.run_reload(suppliers, "s_suppkey", table).rows == suppliers.count()
    jobs.run_reload(suppliers, "s_suppkey", table)
    assert table.records().count() == suppliers.count()
    assert rows_of(table.records())["1"]["s_suppkey"] == "1"

    sample = jobs.run_sample(spark, spec, str(tmp_path / "sample"), fraction=0.2)
    keys = jobs.export_keys(spark, spec).distinct()
    stored = spark.read.parquet(str(tmp_path / "sample"))
    assert stored.columns == ["rowkey"] and 0 < sample.rows == stored.count() < keys.count()
    assert stored.join(keys, stored.rowkey == keys.row_key, "left_anti").count() == 0
    assert jobs.run_sample(spark, spec, str(tmp_path / "random"), 0.5, repeatable=False, seed=1).rows > 0

    assert jobs.run_full_load(suppliers, ["s_name", "s_nationkey"], str(tmp_path / "full")).rows == suppliers.count()
    full = spark.read.parquet(str(tmp_path / "full"))
    assert full.count() == 2 * suppliers.count() and full.select("row_key").distinct().count() == suppliers.count()

    scan = spark.createDataFrame([("20240101_1", "a"), ("20240102_1", "b"), ("20240103_1", "c"), ("20240102_2", None)], "row_key string, zjhm string")
    jobs.run_distinct(jobs.distinct_identifiers([scan, scan], "20240101", "20240102~", "zjhm"), str(tmp_path / "ids"), files=1)
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "ids")).collect()) == ["a", "b"]


def test_sorted_cell_sink(spark, spec, tmp_path):
    job = JobSpec(**{**vars(spec), "target": "bulk", "upper_case": True})
    result = jobs.run_export(spark, job, jobs.sorted_cells_sink(str(tmp_path)), NOW)
    back = spark.read.parquet(f"{tmp_path}/bulk/*")
    assert back.count() == 4 * result.rows and {r[0] for r in back.select("family").distinct().collect()} == {"CF1"}
    assert {r[0] for r in back.select("qualifier").distinct().collect()} == {"EVENT_ID", "EVENT_TYPE", "TS", "USER_ID"}


@pytest.mark.parametrize("at_once", [1, 3])
def test_run_all_logs_every_job(spark, spec, small, tmp_path, at_once):
    log, cursors = RunLog(spark, str(tmp_path / "log")), CursorTable(spark, str(tmp_path / "cursors"))
    assert log.state().count() == 0 and cursors.current().count() == 0
    sink = jobs.keyed_table_sink(spark, 2)
    specs = [
        JobSpec(**{**vars(spec), "target": f"all_a_{at_once}", "cursor": "20240105000000", "step_days": "7", "config_id": "1"}),
        JobSpec(source=f"{small}/missing.parquet", keys="a", target="nowhere", config_id="2", cursor="20240101000000"),
        JobSpec(source=f"{small}/orders.parquet", keys="o_custkey", cursor_column="o_orderdate", target=f"all_b_{at_once}", config_id="3"),
        JobSpec(**{**vars(spec), "target": f"all_a_{at_once}", "cursor": "20240112000000", "step_days": "7", "config_id": "4"}),
    ]
    results = jobs.run_all(spark, specs, lambda s: jobs.run_export(spark, s, sink, NOW), log, cursors, at_once)
    by_id = {r.config_id: r for r in results}
    assert [by_id[i].is_success for i in "1234"] == [True, False, True, True]
    assert "missing" in by_id["2"].error and by_id["2"].cursor == "20240101000000"
    state = {r.relaid: r for r in log.state().collect()}
    assert {k: r.is_success for k, r in state.items()} == {"1": "1", "2": "0", "3": "1", "4": "1"}
    assert state["1"].row_nums == by_id["1"].rows == jobs.export_records(spark, specs[0]).count()
    assert state["1"].start_time <= state["1"].end_time and state["2"].end_time is None
    assert state["2"].last_update_time is not None and state["1"].hive_tbname == spec.source
    assert {r.config_id: r.cursor for r in cursors.current().collect()} == {i: by_id[i].cursor for i in "134"}


def test_the_cursor_moves_after_the_data(spark, spec, tmp_path):
    log, cursors = RunLog(spark, str(tmp_path / "log")), CursorTable(spark, str(tmp_path / "cursors"))

    def broken(records, job):
        raise OSError("store is away")

    job = JobSpec(**{**vars(spec), "cursor": "20240105000000", "step_days": "7"})
    result = jobs.run_logged(spark, job, lambda s: jobs.run_export(spark, s, broken, NOW), log, cursors)
    assert not result.is_success and result.cursor == job.cursor and cursors.current().count() == 0
    good = jobs.run_logged(spark, job, lambda s: jobs.run_export(spark, s, lambda r, j: Written(0), NOW), log, cursors)
    assert good.cursor == "20240112000000" and cursors.current().first().cursor == good.cursor


def test_specs_from_a_config_table(spark):
    configs = spark.createDataFrame(
        [("1", "db.t", "a,b", "ns:t", "src", "a, b, c", None, "c", "20240101000000", None, "b", "7", "string")],
        "ID string, HIVE_TBNAME string, ROWKEY string, HBASE_TBNAME string, TRSDR_SJLY string, HIVE_COLUMNS string, HBASE_COLUMNS string,"
        " HIVE_COLUMNS_CJSJ string, HIVE_COLUMNS_CJSJ_LASTTIME string, HIVE_COLUMNS_CJSJ_ADD_TIME string, SFZHM_COLUMNS string,"
        " TIME_STEP_NUM string, HIVE_COLUMNS_CJSJ_TYPE string",
    )
    (spec,) = specs_from(configs, policy="carry")
    assert spec == JobSpec("db.t", "ns:t", "a,b", "a, b, c", "c", "20240101000000", "string", "7", "b", "1", "src", policy="carry")
    assert spec.window().stop == "20240108000000" and spec.rules().id_columns == ("b",)


def test_config_json(spark):
    values = ["db.t", 'a, "b"', "c", "20240101000000", "timestamp", "T", None]
    schema = ", ".join(f"{c} string" for c in APPEND_COLUMNS.values())
    configs = spark.createDataFrame([tuple(values)], schema)
    sent = configs.select(to_config_json(configs).alias("j"))
    assert json.loads(sent.first().j) == {k: v for k, v in zip(APPEND_COLUMNS.values(), values) if v is not None}
    back = sent.select(from_config_json(F.col("j")).alias("c")).select("c.*").first()
    assert list(back) == values
    spec = JobSpec.from_row(back.asDict(), APPEND_COLUMNS)
    assert (spec.source, spec.target, spec.label) == ("db.t", "T", "")
    broken = spark.createDataFrame([("{",)], "j string").select(from_config_json(F.col("j")).alias("c"))
    assert broken.first().c is None or not any(broken.first().c)


def test_string_cursor_job(spark, tmp_path):
    df = spark.createDataFrame([("a", "20240105000000"), ("a", "20240106000000"), ("b", "20240120000000"), ("c", "bad")], "k string, gxsj string")
    df.write.parquet(str(tmp_path / "t"))
    job = JobSpec(source=str(tmp_path / "t"), keys="K", cursor_column="GXSJ", cursor="20240105000000", step_days="7", cursor_type="string")
    result = jobs.run_export(spark, job, lambda r, s: append_observed(r, str(tmp_path / "o")), NOW)
    assert (result.rows, result.cursor) == (1, "20240106000000")


def append_observed(records, path):
    from cellferry.sinks.files import write_sorted_records

    return write_sorted_records(records, path, cursor=jobs.CURSOR_TIME)


# ---- snapshots, versions, stops, day partitions --------------------------------------------


def folders_read(df):
    return {os.path.dirname(f) for f in df.inputFiles()}


def test_a_thousand_events_are_read_from_two_folders(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    expected = {}
    for i in range(1000):
        n, kind = i // 2, i % 2
        if kind == 0:
            log.add(id=f"r{n}", relaid=str(n % 7), hive_tbname="t", start_time=NOW, event_time=NOW)
            expected[f"r{n}"] = (str(n % 7), None, None)
        else:
            log.add(id=f"r{n}", row_nums=n, is_success="1", end_time=NOW, event_time=NOW + dt.timedelta(hours=1))
            expected[f"r{n}"] = (str(n % 7), n, "1")
        if i in (401, 801):
            assert log.fold()
    log.add(id="r3", is_success="0", event_time=NOW + dt.timedelta(hours=2))
    log.add(id="r4", is_success="0", event_time=NOW - dt.timedelta(hours=2))
    expected["r3"] = ("3", 3, "0")
    state = log.state()
    assert len(folders_read(log.rows())) == 2 and log.waiting() == 200
    assert {r.id: (r.relaid, r.row_nums, r.is_success) for r in state.collect()} == expected
    assert log.fold() and log.waiting() == 0 and not log.fold() and len(folders_read(log.rows())) == 1
    assert {r.id: (r.relaid, r.row_nums, r.is_success) for r in log.state().collect()} == expected


def test_an_event_during_a_fold_is_kept(spark, tmp_path, monkeypatch):
    log, other = RunLog(spark, str(tmp_path / "log")), RunLog(spark, str(tmp_path / "log"))
    log.add(id="a", is_success="1", event_time=NOW)
    plain = RunLog._fold_rows

    def fold(self, rows):
        other.add(id="b", is_success="0", event_time=NOW)
        return plain(self, rows)

    monkeypatch.setattr(RunLog, "_fold_rows", fold)
    early = other.rows()
    assert log.fold() and log.waiting() == 1
    assert {r.id for r in log.state().collect()} == {"a", "b"} and early.count() == 1
    monkeypatch.undo()
    assert other.fold() and {r.id for r in log.state().collect()} == {"a", "b"}


def test_the_later_move_is_current_when_the_clock_goes_back(spark, tmp_path, monkeypatch):
    cursors = CursorTable(spark, str(tmp_path / "cursors"))
    assert cursors.moved("_a/b c", "20240101000000") == 1
    monkeypatch.setattr(runlog, "session_time", lambda spark: session_time(spark) - dt.timedelta(hours=1))
    assert cursors.moved("_a/b c", "20240102000000", "20240101000000") == 2
    for _ in range(2):
        assert [tuple(r) for r in cursors.current().collect()] == [("_a/b c", "20240102000000")]
        cursors.fold()
    with pytest.raises(runlog.CursorMoved):
        cursors.moved("_a/b c", "20240103000000", "20240101000000")
    assert cursors.moved("other", "x", "never stored") == 1 and cursors.moved("_a/b c", "20231231000000") == 3
    assert {r.config_id: r.cursor for r in cursors.current().collect()} == {"_a/b c": "20231231000000", "other": "x"}


def test_of_two_runs_from_one_cursor_one_moves_it(spark, tmp_path):
    tables = [CursorTable(spark, str(tmp_path / "cursors")) for _ in range(4)]
    tables[0].moved("c", "0")

    def move(i):
        try:
            return tables[i].moved("c", str(i + 1), "0")
        except runlog.CursorMoved:
            return None

    with ThreadPoolExecutor(4) as pool:
        won = [i for i, v in enumerate(pool.map(move, range(4))) if v]
    assert len(won) == 1 and tables[3].current().first().cursor == str(won[0] + 1)


def slow(spark, seconds):
    """Rows that take their time on an executor."""
    return spark.range(2, numPartitions=2).mapInPandas(lambda parts: (time.sleep(seconds) or p for p in parts), "id long")


def test_a_job_that_hangs_is_ended_and_the_others_finish(spark, spec, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))

    def run(job):
        rows = (slow(spark, 600) if job.config_id == "hangs" else spark.range(10)).count()
        return jobs.JobResult(job.config_id, job.source, rows, None, True, written=True)

    specs = [JobSpec(source="s", keys="k", target=n, config_id=n) for n in ("hangs", "one", "two")]
    begun = time.monotonic()
    results = {r.config_id: r for r in jobs.run_all(spark, specs, run, log, at_once=3, time_limit=8)}
    assert time.monotonic() - begun < 60
    assert {k: (r.is_success, r.rows) for k, r in results.items()} == {"hangs": (False, 0), "one": (True, 10), "two": (True, 10)}
    assert "longer than 8 s" in results["hangs"].error
    assert {r.relaid: r.is_success for r in log.state().collect()} == {"hangs": "0", "one": "1", "two": "1"}
    assert spark.range(5).count() == 5 and not len(spark.sparkContext.getJobTags())


def test_a_job_is_stopped_by_name(spark, tmp_path):
    log, control = RunLog(spark, str(tmp_path / "log")), JobControl(spark)

    def run(job):
        if job.config_id == "b":
            while "a" not in control.running():
                time.sleep(0.05)
            control.stop("a")
            control.stop("later")
        rows = (slow(spark, 600) if job.config_id == "a" else spark.range(3)).count()
        return jobs.JobResult(job.config_id, job.source, rows, None, True)

    specs = [JobSpec(source="s", keys="k", target=t, config_id=c) for c, t in (("a", "x"), ("b", "y"), ("later", "y"))]
    results = jobs.run_all(spark, specs, run, log, at_once=2, control=control)
    assert {r.config_id: r.is_success for r in results} == {"a": False, "b": True, "later": False}, [r.error[:300] for r in results]
    assert all("told to stop" in r.error for r in results if not r.is_success)


@pytest.mark.parametrize("form", ["yyyyMMdd", "yyyy-MM-dd", "date", "int"])
@pytest.mark.parametrize("cursor, step, inclusive", [("20240105120000", "3", True), ("20240105", "1", False), ("20240128", "", True)])
def test_windows_over_day_partitions(spark, small, tmp_path, form, cursor, step, inclusive):
    events = spark.read.parquet(f"{small}/events.parquet").select("event_id", "ts")
    day = {"date": F.to_date("ts"), "int": F.date_format("ts", "yyyyMMdd").cast("int")}
    place = str(tmp_path / "t")
    rows = events.withColumn("day", day.get(form, F.date_format("ts", form)))
    rows.repartition("day").write.partitionBy("day").parquet(place)
    kind = {"date": "date", "int": "int"}.get(form, "string")
    stored = spark.read.schema(f"event_id long, ts timestamp_ntz, day {kind}").parquet(place)
    window = windows.CursorWindow.of(cursor, step, inclusive)
    pruned = windows.in_window(stored, "ts", window, day_column="DAY")
    assert sorted(pruned.select("event_id").collect()) == sorted(windows.in_window(events, "ts", window).select("event_id").collect())
    assert "PartitionFilters: [" in plan_of(pruned) and "PartitionFilters: []" not in plan_of(pruned)
    scanned = stored.where(windows.day_test(stored, "day", window)).select("day").distinct().count()
    assert scanned <= (5 if step else 4) < stored.select("day").distinct().count()
