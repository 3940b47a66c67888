"""Writers: written, read back, compared. No database is started: JDBC is tested up to its options."""

import datetime as dt
import glob
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from plans_of import plan_of
from pyspark.sql import functions as F

from cellferry.operators.cells import to_cells
from cellferry.operators.keys import with_row_key
from cellferry.sinks import files, relational
from cellferry.sinks import keyed
from cellferry.sinks.keyed import KeyedTable, buckets_for
from cellferry.sources import relational as relational_source
from cellferry.sources.tables import key_range
from cellferry.store import ABANDONED, DONE, CommitLog


@pytest.fixture
def records(spark):
    df = spark.range(3000).selectExpr("id", "id * 7 % 1000 as b", "timestamp_ntz'2024-01-01' + make_dt_interval(id) as __t", "'v' as a")
    return with_row_key(df, "id").drop("id").selectExpr("row_key", "cast(b as string) as b", "a", "__t")


def test_sorted_cells(spark, records, tmp_path):
    path = str(tmp_path / "cells")
    written = files.write_sorted_cells(records, path, cursor="__t", files=3)
    assert written == files.Written(3000, dt.datetime(2024, 1, 1) + dt.timedelta(days=2999))
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, to_cells(records.drop("__t")).collect()))
    ranges = []
    for name in sorted(glob.glob(f"{path}/*.parquet")):
        rows = [(r.row_key, r.qualifier) for r in spark.read.parquet(name).collect()]
        assert rows == sorted(rows)
        ranges.append((rows[0][0], rows[-1][0]))
    assert len(ranges) == 3
    ranges.sort()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    scan = plan_of(key_range(back, "100", "2"))
    assert "GreaterThanOrEqual(row_key,100)" in scan and "LessThan(row_key,2)" in scan


def test_sorted_records_and_an_empty_batch(spark, records, tmp_path):
    path = str(tmp_path / "records")
    assert files.write_sorted_records(records, path, cursor="__t").rows == 3000
    assert spark.read.parquet(path).columns == ["row_key", "b", "a"]
    empty = files.write_sorted_cells(records.where("a = 'zz'"), str(tmp_path / "none"), cursor="__t")
    assert empty == files.Written(0, None)


def test_counts_are_taken_in_the_last_stage(records):
    placed, _ = files.observed(files.sorted_layout(records), "__t")
    plan = plan_of(placed)
    assert plan.index("CollectMetrics") < plan.index("Exchange")


def test_lines(spark, tmp_path):
    df = spark.createDataFrame([("b",), ("a",), ("甲",)], "v string").repartition(3)
    files.write_lines(df, str(tmp_path / "one"), files=1)
    assert len(glob.glob(str(tmp_path / "one" / "part*"))) == 1
    files.write_lines(df, str(tmp_path / "many"))
    for name in ("one", "many"):
        assert sorted(r[0] for r in spark.read.text(str(tmp_path / name)).collect()) == ["a", "b", "甲"]


def test_append(spark, tmp_path):
    df = spark.createDataFrame([("k1",), ("k2",)], "rowkey string")
    assert files.append_rows(df, str(tmp_path)).rows == 2
    assert files.append_rows(df, str(tmp_path)).rows == 2
    assert spark.read.parquet(str(tmp_path)).count() == 4


def rows_of(table):
    df = table.records()
    return {r.row_key: r.asDict() for r in df.collect()}


def test_keyed_table(spark):
    table = KeyedTable(spark, "keyed_one", buckets=4)
    assert not table.exists() and table.last_batch() == 0
    assert table.create([]) is False and KeyedTable(spark, "x", family="").create(["a"]) is False
    first = spark.createDataFrame([("a", "1", "1"), ("b", "1", "1")], "row_key string, x string, y string")
    assert table.put(first, 1).rows == 2 and table.exists() and table.create(["x"])
    later = spark.createDataFrame([("b", "2", dt.datetime(2024, 1, 2)), ("c", "", dt.datetime(2024, 1, 1))], "row_key string, x string, t timestamp_ntz")
    assert table.put(later, 2, cursor="t") == files.Written(2, dt.datetime(2024, 1, 2))
    expected = {
        "a": {"row_key": "a", "x": "1", "y": "1"},
        "b": {"row_key": "b", "x": "2", "y": "1"},
        "c": {"row_key": "c", "x": "", "y": None},
    }
    assert rows_of(table) == expected
    table.put(later, 2, cursor="t")
    assert rows_of(table) == expected and table.last_batch() == 2
    assert ("c", "y") not in {(r.row_key, r.qualifier) for r in table.cells().collect()}
    table.put(spark.createDataFrame([("a", "9")], "row_key string, z string"), 3)
    assert rows_of(table)["a"] == {"row_key": "a", "x": "1", "y": "1", "z": "9"}
    compacted = table.compact_into("keyed_one_next")
    assert rows_of(compacted) == rows_of(table) and spark.table("keyed_one_next").count() == 3


def test_keyed_table_reads_without_a_shuffle(spark, records):
    table = KeyedTable(spark, "keyed_wide", buckets=4)
    table.put(records, 1, cursor="__t")
    table.put(records.where("b < '5'"), 2, cursor="__t")
    assert "Exchange" not in plan_of(table.records())
    ranged = plan_of(key_range(table.records(), "100", "2"))
    assert "GreaterThanOrEqual(row_key,100)" in ranged and "Exchange" not in ranged
    assert table.records().count() == 3000
    # one file per bucket and batch
    assert len({r[0] for r in spark.table("keyed_wide").select(F.input_file_name()).distinct().collect()}) == 8


def test_bucket_numbers_by_size():
    assert [buckets_for(n) for n in (0, 1, 1 << 30, (1 << 30) + 1, 100 << 40)] == [1, 1, 1, 2, 102_400]


def test_jdbc_options():
    read = relational_source.read_options("jdbc:x", "t", user="u")
    assert read == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "100000", "user": "u"}
    split = relational_source.read_options("jdbc:x", "t", partition_column="id", lower=0, upper=100, partitions=8, custom_schema="a int")
    assert split["numPartitions"] == "8" and split["partitionColumn"] == "id" and split["customSchema"] == "a int"
    with pytest.raises(ValueError):
        relational_source.read_options("jdbc:x", "t", partition_column="id")
    assert relational.write_options("jdbc:x", "t") == {"url": "jdbc:x", "dbtable": "t", "batchsize": "10000", "numPartitions": "5"}


# ---- commit order and compaction -----------------------------------------------------------


def put_rows(spark, rows):
    return spark.createDataFrame(rows, "row_key string, x string")


def test_of_two_drivers_the_later_batch_wins_whatever_their_clocks_say(spark, monkeypatch):
    KeyedTable(spark, "keyed_clock", 2).put(put_rows(spark, [("a", "old"), ("b", "old")]))
    for clock in ("time", "time_ns", "monotonic"):
        real = getattr(time, clock)
        back = 3600 * (10**9 if clock.endswith("ns") else 1)
        monkeypatch.setattr(time, clock, lambda real=real, back=back: real() - back)
    other = KeyedTable(spark, "keyed_clock", 2)
    other.put(put_rows(spark, [("a", "new")]))
    assert {k: r["x"] for k, r in rows_of(other).items()} == {"a": "new", "b": "old"}


def test_a_number_has_one_owner(spark, tmp_path):
    logs = [CommitLog(spark, str(tmp_path / "log")) for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        won = list(pool.map(lambda i: logs[i % 4].claim_at(1 + i // 4, by=i), range(40)))
    assert sum(won) == 10 and logs[0].numbers() == list(range(1, 11))
    assert [logs[1].entry(n).what["by"] // 4 for n in range(1, 11)] == list(range(10))
    assert logs[0].settle(3, DONE) and not logs[1].settle(3, ABANDONED) and logs[2].settled() == {3: DONE}


def test_a_batch_that_breaks_off_is_not_seen(spark):
    table = KeyedTable(spark, "keyed_broken", 2)
    table.put(put_rows(spark, [("a", "1")]))
    with pytest.raises(Exception, match="no such value"):
        table.put(put_rows(spark, [("a", "2")]).withColumn("x", F.raise_error(F.lit("no such value"))))
    assert table.unfinished() == [2] and rows_of(table)["a"]["x"] == "1"
    with pytest.raises(RuntimeError, match="not finished"):
        table.compact()
    assert table.abandon(2) and not table.abandon(2)
    with pytest.raises(ValueError, match="given up"):
        table.put(put_rows(spark, [("a", "2")]), 2)
    table.put(put_rows(spark, [("b", "3")]))
    table.compact()
    assert {k: r["x"] for k, r in rows_of(table).items()} == {"a": "1", "b": "3"}


def test_compaction_in_place(spark):
    table = KeyedTable(spark, "keyed_place", 2)
    for n in range(4):
        table.put(put_rows(spark, [(k, f"{k}{n}") for k in "abcdefgh"[n:]]))
    assert table.files_per_bucket() == {0: 4, 1: 4} and table.needs_compaction(3) and not table.needs_compaction(4)
    before = table.records()
    expected = rows_of(table)
    old = table.compact()
    assert old == "keyed_place" and table.stored_in() != old
    assert {r.row_key: r.asDict() for r in before.collect()} == expected == rows_of(table)
    assert rows_of(KeyedTable(spark, "keyed_place", 2)) == expected
    assert table.files_per_bucket() == {0: 1, 1: 1} and spark.table(table.stored_in()).count() == 8
    KeyedTable(spark, "keyed_place", 2).put(put_rows(spark, [("a", "new")]))
    assert rows_of(table)["a"]["x"] == "new" and table.compact() != old
    assert rows_of(table) == {**expected, "a": {"row_key": "a", "x": "new"}}


def test_batches_that_come_during_a_compaction_are_carried_over(spark, monkeypatch):
    table, other = KeyedTable(spark, "keyed_during", 2), KeyedTable(spark, "keyed_during", 2)
    table.put(put_rows(spark, [("a", "1"), ("b", "1")]))
    plain, seen = KeyedTable._append, []

    def append(self, stored, *rest, **named):
        made = plain(self, stored, *rest, **named)
        if self is table and not seen:
            seen.append(rows_of(other))
            other.put(put_rows(spark, [("b", "2"), ("c", "2")]))
            seen.append(rows_of(other))
        return made

    monkeypatch.setattr(KeyedTable, "_append", append)
    table.compact()
    assert {k: r["x"] for k, r in seen[0].items()} == {"a": "1", "b": "1"}
    assert rows_of(table) == rows_of(other) == seen[1]
    assert {k: r["x"] for k, r in seen[1].items()} == {"a": "1", "b": "2", "c": "2"}


def test_a_table_from_before_the_log_goes_on(spark):
    table = KeyedTable(spark, "keyed_legacy", 2)
    table.create(["x"])
    spark.createDataFrame([("a", "1", 1_700_000_000_000_000)], "row_key string, x string, __batch_no bigint").write.mode("append").format(
        "parquet"
    ).bucketBy(2, "row_key").sortBy("row_key").saveAsTable("keyed_legacy")
    assert rows_of(table)["a"]["x"] == "1"
    table.put(put_rows(spark, [("a", "2")]))
    assert table.last_batch() == 1_700_000_000_000_001 and rows_of(table)["a"]["x"] == "2"


def test_buckets_follow_the_first_batch(spark, small, monkeypatch):
    """A bucket is compacted in one task, so larger batches get more buckets, not larger ones."""
    from cellferry.registry import roundtrips

    records = spark.range(1000).selectExpr("cast(id as string) as row_key", "repeat('x', 100) as a")
    assert keyed.buckets_for_batch(records) == 1
    monkeypatch.setattr(keyed, "BATCH_BYTES_PER_BUCKET", 1 << 12)
    few, many = keyed.buckets_for_batch(records.limit(100)), keyed.buckets_for_batch(records)
    assert 2 <= few < many and many == 26
    assert keyed.buckets_for_batch(records.limit(0)) == 1

    made = []

    class Seen(KeyedTable):
        def __init__(self, *args, **settings):
            super().__init__(*args, **settings)
            made.append(self.buckets)

    monkeypatch.setattr(roundtrips, "KeyedTable", Seen)
    roundtrips.keyed_table_created_and_widened(spark, small)
    assert made[0] > 4
