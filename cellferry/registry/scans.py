"""Scans, cursor windows, key ranges, unions, counts."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import digits14, digits8
from ..operators.dedupe import distinct_records, distinct_values, row_count
from ..operators.layout import union_distinct
from ..operators.windows import CursorWindow, in_window
from ..plans.jobs import distinct_identifiers
from ..sources.tables import ROW_KEY, control_query, key_range, project, read_cell, read_table
from . import path, query, table


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
              concat(l_returnflag, '/', l_linestatus) AS flags FROM lineitem"""
)
def scan_expressions(spark: SparkSession, sf: str) -> DataFrame:
    columns = (
        "l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) as net, "
        "concat(l_returnflag, '/', l_linestatus) as flags"
    )
    return read_table(spark, path(sf, "lineitem"), columns)


@query("SELECT * FROM orders")
def scan_full(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, path(sf, "orders"))


_EVENT = "event_id, user_id, event_type, value, props, strftime(ts, '%Y%m%d%H%M%S') AS ts_text"


def _events(df: DataFrame) -> DataFrame:
    return df.select("event_id", "user_id", "event_type", "value", "props", digits14(F.col("ts")).alias("ts_text"))


@query(f"SELECT {_EVENT} FROM events")
def window_full(spark: SparkSession, sf: str) -> DataFrame:
    return _events(in_window(table(spark, sf, "events"), "ts", CursorWindow.of(" ")))


@query(f"SELECT {_EVENT} FROM events WHERE ts >= TIMESTAMP '2024-01-12 00:00:00'")
def window_from(spark: SparkSession, sf: str) -> DataFrame:
    return _events(in_window(table(spark, sf, "events"), "ts", CursorWindow.of("20240112000000")))


@query(
    f"""SELECT {_EVENT} FROM events
        WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'"""
)
def window_bounded(spark: SparkSession, sf: str) -> DataFrame:
    return _events(in_window(table(spark, sf, "events"), "ts", CursorWindow.of("2024-01-05", "7")))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day FROM orders WHERE o_orderdate > TIMESTAMP '1997-05-28'")
def window_after(spark: SparkSession, sf: str) -> DataFrame:
    window = CursorWindow.of("19970528000000", inclusive=False)
    rows = in_window(table(spark, sf, "orders"), "O_ORDERDATE", window)
    return rows.select("o_orderkey", digits8(F.col("o_orderdate")).alias("day"))


@query(
    f"""SELECT * FROM (SELECT {_EVENT} FROM events)
        WHERE ts_text >= '20240105120000' AND ts_text < '20240108120000'"""
)
def window_text_cursor(spark: SparkSession, sf: str) -> DataFrame:
    stored = _events(table(spark, sf, "events"))
    return in_window(stored, "ts_text", CursorWindow.of("20240105120000", 3), "string")


@query(
    """SELECT * FROM (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS printed FROM events)
       WHERE printed >= '2024-01-05 12:00:00' AND printed < '2024-01-08 12:00:00'"""
)
def window_printed_cursor(spark: SparkSession, sf: str) -> DataFrame:
    printed = F.substring(F.col("ts").cast("string"), 1, 19).alias("printed")
    stored = table(spark, sf, "events").select("event_id", printed)
    return in_window(stored, "printed", CursorWindow.of("20240105120000", 3), "timestamp")


@query(f"SELECT {_EVENT} FROM events WHERE ts >= TIMESTAMP '2024-01-20'")
def window_step_zero(spark: SparkSession, sf: str) -> DataFrame:
    return _events(in_window(table(spark, sf, "events"), "ts", CursorWindow.of("20240120", "0")))


# A text column of printed times that has no cursor type: an export prints the cursor.
@query(
    """SELECT * FROM (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS printed FROM events)
       WHERE printed >= '2024-01-12 00:00:00'"""
)
def window_dashed_text_blank_type(spark: SparkSession, sf: str) -> DataFrame:
    printed = F.substring(F.col("ts").cast("string"), 1, 19).alias("printed")
    stored = table(spark, sf, "events").select("event_id", printed)
    return in_window(stored, "printed", CursorWindow.of("20240112000000"), " ")


# An append compares text as it is stored unless its type is timestamp.
@query(
    """SELECT * FROM (SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS ts_text FROM events)
       WHERE ts_text > '20240112000000'"""
)
def append_text_cursor(spark: SparkSession, sf: str) -> DataFrame:
    stored = table(spark, sf, "events").select("event_id", digits14(F.col("ts")).alias("ts_text"))
    return in_window(stored, "ts_text", CursorWindow.of("20240112000000", inclusive=False), "", rule="append")


# A day compares by its midnight, so both bounds within a day move to the next one.
@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day FROM orders
       WHERE CAST(o_orderdate AS DATE) >= DATE '1997-05-29' AND CAST(o_orderdate AS DATE) < DATE '1997-06-01'"""
)
def window_days(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    rows = in_window(days, "day", CursorWindow.of("19970528120000", 3))
    return rows.select("o_orderkey", digits8(F.col("day")).alias("day"))


_COUNTED = ("customer", "documents", "events", "lineitem", "orders", "part")


@query(" UNION ALL ".join(f"SELECT '{t}' AS source, count(*) AS row_count FROM {t}" for t in _COUNTED))
def source_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    first, *rest = [row_count(table(spark, sf, t)).select(F.lit(t).alias("source"), "row_count") for t in _COUNTED]
    for counted in rest:
        first = first.unionByName(counted)
    return first


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_user_types(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_values(table(spark, sf, "events"), "USER_ID, event_type")


@query("SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1)")
def distinct_whole_records(spark: SparkSession, sf: str) -> DataFrame:
    """Whole records, of which those with line number 1 are there twice."""
    lines = read_table(spark, path(sf, "lineitem"))
    twice = F.explode(F.when(F.col("l_linenumber") == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return distinct_records(lines.select("*", twice.alias("copy")).drop("copy"))


def _dated(df: DataFrame, day: str, ident: str, *others: str) -> DataFrame:
    """A table under keys ``yyyyMMdd_identifier``."""
    key = F.concat_ws("_", digits8(F.col(day)), F.col(ident).cast("string"))
    return df.select(key.alias(ROW_KEY), F.col(ident).cast("string").alias("ident"), day, *others)


_DATED_EVENTS = """SELECT concat(strftime(ts, '%Y%m%d'), '_', event_id) AS row_key,
                          CAST(event_id AS VARCHAR) AS ident, event_type FROM events"""


@query(f"SELECT * FROM ({_DATED_EVENTS}) WHERE row_key >= '20240105' AND row_key < '20240106~'")
def key_range_scan(spark: SparkSession, sf: str) -> DataFrame:
    keyed = _dated(table(spark, sf, "events"), "ts", "event_id", "event_type")
    return key_range(keyed, "20240105", "20240106~", day_column="ts").drop("ts")


@query(f"SELECT event_type AS value FROM ({_DATED_EVENTS}) WHERE row_key >= '20240111_' AND row_key < '20240113'")
def key_range_cell(spark: SparkSession, sf: str) -> DataFrame:
    keyed = _dated(table(spark, sf, "events"), "ts", "event_id", "event_type")
    return read_cell(key_range(keyed, "20240111_", "20240113", day_column="ts"), "EVENT_TYPE")


# A stop of seven digits is no day: the keys of 1 to 9 January stay.
@query(f"SELECT * FROM ({_DATED_EVENTS}) WHERE row_key >= '20240101' AND row_key < '2024011'")
def key_range_short_stop(spark: SparkSession, sf: str) -> DataFrame:
    keyed = _dated(table(spark, sf, "events"), "ts", "event_id", "event_type")
    return key_range(keyed, "20240101", "2024011", day_column="ts").drop("ts")


# seven keyed tables: (table, day column, identifier column)
_SEVEN = (
    ("lineitem", "l_shipdate", "l_orderkey"),
    ("lineitem", "l_shipdate", "l_partkey"),
    ("lineitem", "l_shipdate", "l_suppkey"),
    ("orders", "o_orderdate", "o_orderkey"),
    ("orders", "o_orderdate", "o_custkey"),
    ("events", "ts", "event_id"),
    ("events", "ts", "user_id"),
)


@query(
    "SELECT DISTINCT ident FROM ("
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS VARCHAR) AS ident, concat(strftime({d}, '%Y%m%d'), '_', {i}) AS row_key FROM {t}"
        for t, d, i in _SEVEN
    )
    + ") WHERE row_key >= '19991201' AND row_key < '20240109~'"
)
def range_identifiers(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed tables over one stored table are read in one scan of it."""
    scans = []
    for name, day in dict.fromkeys((t, d) for t, d, _ in _SEVEN):
        idents = F.explode(F.array(*[F.col(i).cast("string") for t, d, i in _SEVEN if (t, d) == (name, day)]))
        rows = table(spark, sf, name).select(F.col(day).alias("day"), idents.alias("ident"))
        scans.append(rows.select(F.concat_ws("_", digits8(F.col("day")), "ident").alias(ROW_KEY), "ident", "day"))
    return distinct_identifiers(scans, "19991201", "20240109~", "ident", day_column="day")


@query(
    """SELECT DISTINCT nation FROM (SELECT n_nationkey AS nation FROM nation
       UNION ALL SELECT c_nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier)"""
)
def union_nations(spark: SparkSession, sf: str) -> DataFrame:
    columns = (("nation", "n_nationkey"), ("customer", "c_nationkey"), ("supplier", "s_nationkey"))
    return union_distinct(*[table(spark, sf, t).select(F.col(c).alias("nation")) for t, c in columns])


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS c_nationkey
       FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_nationkey >= 5"""
)
def control_rows(spark: SparkSession, sf: str) -> DataFrame:
    conditions = [("C_MKTSEGMENT", "=", "MACHINERY"), ("c_nationkey", ">=", 5), ("c_name", "=", " ")]
    columns = ["C_CUSTKEY", "C_MKTSEGMENT", "C_NATIONKEY"]
    return control_query(table(spark, sf, "customer"), conditions, ("c_custkey", "desc"), columns)


@query("SELECT event_type, count(*) AS n FROM events WHERE contains(props, '{\"k\": 6') GROUP BY event_type")
def projected_text(spark: SparkSession, sf: str) -> DataFrame:
    marked = project(table(spark, sf, "events"), "event_type, contains(props, '{\"k\": 6') as hit")
    return marked.where("hit").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
