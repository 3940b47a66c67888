"""Sinks: each query writes to a fresh place below the warehouse and reads it back."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import digits8
from ..operators.keys import with_row_key
from ..operators.layout import sample_keys_by_hash
from ..operators.windows import CursorWindow, in_window
from ..plans.jobs import distinct_identifiers, run_distinct
from ..sinks.files import append_rows, write_sorted_cells, write_sorted_records
from ..sinks.keyed import KeyedTable, buckets_for, buckets_for_batch
from ..sinks.ranged import RangedTable
from ..sources.tables import ROW_KEY
from . import query, table
from .cells import _LATER_SQL, _ORDER_SQL, _QUALIFIERS, _later, _records, _unpivot


def _fresh(spark: SparkSession) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/written_{uuid.uuid4().hex}"


def _table(spark: SparkSession, records: DataFrame, buckets: int = 4) -> KeyedTable:
    """A table of so many buckets, or of more where the records to come are large."""
    return KeyedTable(spark, f"written_{uuid.uuid4().hex}", max(buckets, buckets_for_batch(records)))


@query(f"SELECT row_key, 'cf1' AS family, qualifier, value FROM ({_unpivot(_ORDER_SQL, _QUALIFIERS)})")
def sorted_cells_written(spark: SparkSession, sf: str) -> DataFrame:
    place = _fresh(spark)
    write_sorted_cells(_records(spark, sf), place)
    return spark.read.parquet(place)


@query(_ORDER_SQL)
def sorted_records_written(spark: SparkSession, sf: str) -> DataFrame:
    place = _fresh(spark)
    write_sorted_records(_records(spark, sf), place)
    return spark.read.parquet(place)


@query(
    f"""SELECT o.row_key, o.o_custkey, o.o_orderdate, o.o_orderkey,
               coalesce(l.o_orderpriority, o.o_orderpriority) AS o_orderpriority, o.o_orderstatus, o.o_totalprice
        FROM ({_ORDER_SQL}) o LEFT JOIN ({_LATER_SQL}) l ON o.row_key = l.row_key"""
)
def keyed_table_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    target = _table(spark, _records(spark, sf), buckets_for(4 << 30))
    target.put(_records(spark, sf), 1, load=True)
    target.put(_later(spark, sf), 2)
    return target.records()


@query(
    f"""SELECT o.row_key, coalesce(l.o_orderpriority, o.o_orderpriority) AS o_orderpriority, o.o_orderstatus
        FROM ({_ORDER_SQL}) o LEFT JOIN ({_LATER_SQL}) l ON o.row_key = l.row_key"""
)
def keyed_table_created_and_widened(spark: SparkSession, sf: str) -> DataFrame:
    """Created with one qualifier; the second batch brings another, and the result is compacted."""
    target = _table(spark, _records(spark, sf))
    target.create(["o_orderpriority"])
    target.put(_records(spark, sf).select(ROW_KEY, "o_orderpriority"), 1)
    target.put(_records(spark, sf).select(ROW_KEY, "o_orderstatus"), 2)
    target.put(_later(spark, sf), target.last_batch() + 1)
    if target.needs_compaction(2):
        target = target.compact_into(f"{target.name}_compact")
    return target.records()


_BOTH_SQL = f"""SELECT o.row_key, o.o_custkey, o.o_orderdate, o.o_orderkey,
        coalesce(l.o_orderpriority, o.o_orderpriority) AS o_orderpriority, o.o_orderstatus, o.o_totalprice
    FROM ({_ORDER_SQL}) o LEFT JOIN ({_LATER_SQL}) l ON o.row_key = l.row_key"""


@query(f"SELECT *, upper(o_orderpriority) AS loud FROM ({_BOTH_SQL})")
def keyed_table_compacted_in_place(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches, a compaction to which readers switch, and a batch after it."""
    target = _table(spark, _records(spark, sf))
    target.put(_records(spark, sf), load=True)
    target.put(_records(spark, sf).select(ROW_KEY, F.lit("old").alias("loud")))
    target.put(_later(spark, sf))
    target.compact()
    loud = target.records().select(ROW_KEY, F.upper("o_orderpriority").alias("loud"))
    target.put(loud)
    return target.records()


def _ranged(spark: SparkSession, sf: str) -> RangedTable:
    """Two batches between the split points of the first."""
    target = RangedTable(spark, _fresh(spark), range_bytes=1 << 18)
    target.put(_records(spark, sf))
    target.put(_later(spark, sf))
    return target


@query(_BOTH_SQL)
def ranged_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    return _ranged(spark, sf).records()


@query(f"SELECT * FROM ({_BOTH_SQL}) WHERE row_key >= '2' AND row_key < '31'")
def ranged_key_range(spark: SparkSession, sf: str) -> DataFrame:
    return _ranged(spark, sf).records("2", "31")


@query(f"SELECT *, repeat(md5(row_key), 20) AS note FROM ({_BOTH_SQL})")
def ranged_after_cut(spark: SparkSession, sf: str) -> DataFrame:
    """A third batch makes every range outgrow its limit; they are cut."""
    target = _ranged(spark, sf)
    target.put(_records(spark, sf).select(ROW_KEY, F.repeat(F.md5(ROW_KEY), 20).alias("note")))
    target.cut()
    return target.records()


@query(
    """SELECT event_id, user_id, strftime(ts, '%Y%m%d') AS day FROM events
       WHERE ts >= TIMESTAMP '2024-01-09 06:00:00' AND ts < TIMESTAMP '2024-01-13 06:00:00'"""
)
def window_day_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """A window over a table that is partitioned by the day of its cursor."""
    place = _fresh(spark)
    dated = table(spark, sf, "events").withColumn("day", digits8(F.col("ts")))
    dated.repartition("day").write.partitionBy("day").parquet(place)
    stored = spark.read.schema("event_id bigint, user_id bigint, ts timestamp_ntz, day string").parquet(place)
    return in_window(stored, "ts", CursorWindow.of("20240109060000", 4), day_column="day").select("event_id", "user_id", "day")


@query(
    """SELECT DISTINCT CAST(user_id AS VARCHAR) AS value FROM events
       WHERE strftime(ts, '%Y%m%d') || '_' || event_id >= '20240105' AND strftime(ts, '%Y%m%d') || '_' || event_id < '20240108'"""
)
def identifier_lines_written(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    keyed = with_row_key(events.withColumn("day", F.date_format("ts", "yyyyMMdd")), "day,event_id")
    place = _fresh(spark)
    users = keyed.select(ROW_KEY, F.col("user_id").cast("string").alias("ident"))
    run_distinct(distinct_identifiers([users], "20240105", "20240108", "ident"), place, files=3)
    return spark.read.text(place)


_HASHED = "SELECT DISTINCT CAST({c} AS VARCHAR) AS rowkey FROM {t} WHERE substr(md5(CAST({c} AS VARCHAR)), 1, 8) < '40000000'"


@query(_HASHED.format(c="user_id", t="events") + " UNION ALL " + _HASHED.format(c="o_custkey", t="orders"))
def samples_appended(spark: SparkSession, sf: str) -> DataFrame:
    """The key samples of two tables, one appended to the other."""
    place = _fresh(spark)
    for name, column in (("events", "user_id"), ("orders", "o_custkey")):
        keys = with_row_key(table(spark, sf, name), column).select(ROW_KEY)
        append_rows(sample_keys_by_hash(keys, 0.25).withColumnRenamed(ROW_KEY, "rowkey"), place)
    return spark.read.parquet(place)
