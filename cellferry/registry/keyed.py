"""Keyed exports: row keys, keep the latest, cursors, naming, reloads."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import digits14
from ..names import rename_case, sort_columns
from ..operators.dedupe import batch_metrics, fixed_width, greatest_row, keep_latest
from ..operators.keys import with_row_key
from ..operators.upsert import upsert_records
from ..operators.windows import CursorWindow, next_cursor_column, window_test
from ..plans.jobs import CURSOR_TIME, all_metrics, append_rows_of, export_batch, export_records, full_load_records, reload_records
from ..plans.spec import JobSpec
from . import path, query, table

# Doubles are printed through a decimal column in queries that are compared, since the two
# engines print very large and very small ones in different forms.
_VALUE = "CAST(value AS DECIMAL(19, 2))"

_LATEST_EVENTS = """SELECT concat(user_id, '_', event_type) AS row_key, *, row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM events"""


def _event_spec(sf: str, **settings: str) -> JobSpec:
    return JobSpec(
        source=path(sf, "events"),
        keys="USER_ID, event_type",
        columns="event_id, ts, user_id, event_type, cast(value as decimal(19, 2)) as value",
        cursor_column="ts",
        **settings,
    )


_EXPORT_SQL = f"""SELECT row_key, CAST(event_id AS VARCHAR) AS event_id, event_type, strftime(ts, '%Y%m%d%H%M%S') AS ts,
        CAST(user_id AS VARCHAR) AS user_id, CAST({_VALUE} AS VARCHAR) AS value FROM ({_LATEST_EVENTS} {{}}) WHERE rn = 1"""


@query(_EXPORT_SQL.format("WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'"))
def export_window(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: one window of events, keyed, the latest per key, in canonical text."""
    return export_records(spark, _event_spec(sf, cursor="20240105000000", step_days="7")).drop(CURSOR_TIME)


@query(_EXPORT_SQL.format(""))
def export_full(spark: SparkSession, sf: str) -> DataFrame:
    return export_records(spark, _event_spec(sf)).drop(CURSOR_TIME)


@query(_EXPORT_SQL.format(""))
def export_in_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Windows one after the other, merged by key: the same as one full load."""
    starts = ["20240101000000", "20240108000000", "20240115000000", "20240122000000", "20240129000000"]
    steps = ["7", "7", "7", "7", ""]
    batches = [
        export_records(spark, _event_spec(sf, cursor=c, step_days=s)).drop(CURSOR_TIME) for c, s in zip(starts, steps)
    ]
    return upsert_records(*batches)


@query(
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY
           l_shipdate DESC, l_partkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC,
           l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1"""
)
def latest_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return keep_latest(table(spark, sf, "lineitem"), ["l_orderkey", "l_suppkey"], ["l_shipdate"])


@query(
    """SELECT * EXCLUDE (rn) FROM (SELECT l_suppkey || '_' || l_returnflag AS row_key, *, row_number() OVER (
           PARTITION BY l_suppkey, l_returnflag ORDER BY l_shipdate DESC, l_orderkey DESC, l_partkey DESC, l_suppkey DESC,
           l_linenumber DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC) AS rn FROM lineitem) WHERE rn = 1"""
)
def latest_fixed_width(spark: SparkSession, sf: str) -> DataFrame:
    keyed = with_row_key(table(spark, sf, "lineitem"), "l_suppkey,l_returnflag")
    return fixed_width(keep_latest(keyed, "row_key", ["l_shipdate"]), 12)


@query(
    """SELECT o_orderkey, concat_ws('_', o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE o_orderpriority END,
              strftime(o_orderdate, '%Y%m%d%H%M%S')) AS row_key FROM orders"""
)
def composite_keys(spark: SparkSession, sf: str) -> DataFrame:
    blanked = F.when(F.col("o_orderkey") % 5 == 0, " ").otherwise(F.col("o_orderpriority"))
    df = table(spark, sf, "orders").withColumn("o_orderpriority", blanked)
    return with_row_key(df, "o_custkey, O_ORDERPRIORITY,o_orderdate").select("o_orderkey", "row_key")


@query("SELECT concat(conv_id, '_', turn) AS row_key, role AS ROLE, text AS TEXT FROM conversations")
def upper_case_names(spark: SparkSession, sf: str) -> DataFrame:
    keyed = with_row_key(table(spark, sf, "conversations"), "CONV_ID,TURN").drop("conv_id", "turn")
    return sort_columns(rename_case(keyed, upper=True, keep=["row_key"]), first=["row_key"])


_NUMBER = "CASE WHEN event_id % 3 = 0 THEN CAST(value * 100 AS BIGINT) ELSE 0 END"


@query(
    f"""SELECT event_type, event_id, number_text FROM (SELECT event_type, event_id,
          CASE WHEN event_id % 3 = 0 THEN CAST({_NUMBER} AS VARCHAR) ELSE 'x' END AS number_text,
          row_number() OVER (PARTITION BY event_type ORDER BY {_NUMBER} DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""
)
def greatest_cursor_rows(spark: SparkSession, sf: str) -> DataFrame:
    number = F.when(F.col("event_id") % 3 == 0, F.round(F.col("value") * 100).cast("bigint").cast("string")).otherwise("x")
    df = table(spark, sf, "events").select("event_type", "event_id", number.alias("number_text"))
    return greatest_row(df, "number_text", ["event_type"])


@query("SELECT event_id, event_type, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def greatest_cursor_row(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").select("ts", "event_id", "event_type", "user_id")
    return greatest_row(df, "ts").drop("ts")


# Every user is a source of its own with a window of one day; many windows are empty.
_CURSORS_SQL = """WITH top AS (SELECT user_id,
        strftime(max(ts) FILTER (ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06'), '%Y%m%d%H%M%S') AS greatest
        FROM events GROUP BY user_id)
    SELECT user_id, greatest, {} AS next_cursor FROM top"""


def _cursors(spark: SparkSession, sf: str, policy: str) -> DataFrame:
    window = CursorWindow.of("20240105000000", 1)
    events = table(spark, sf, "events").select("user_id", "ts")
    # users without a row in the window keep a null; one pass serves all of them
    top = F.max(F.when(window_test(events, "ts", window), F.col("ts")))
    tops = events.groupBy("user_id").agg(top.alias("top"))
    greatest = digits14(F.col("top"))
    after = next_cursor_column(greatest, F.lit(window.start), F.lit(window.stop), policy, F.lit("20240105180000"))
    return tops.select("user_id", greatest.alias("greatest"), after.alias("next_cursor"))


@query(_CURSORS_SQL.format("coalesce(greatest, '20240105000000')"))
def next_cursors_carried(spark: SparkSession, sf: str) -> DataFrame:
    return _cursors(spark, sf, "carry")


@query(_CURSORS_SQL.format("coalesce(greatest, '20240105180000')"))
def next_cursors_advanced(spark: SparkSession, sf: str) -> DataFrame:
    return _cursors(spark, sf, "advance")


@query(
    """SELECT count(DISTINCT (user_id, event_type)) AS key_count, max(ts) AS greatest, count(*) = 0 AS is_empty FROM events
       WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13'"""
)
def exported_keys(spark: SparkSession, sf: str) -> DataFrame:
    batch = export_batch(spark, _event_spec(sf, cursor="20240110", step_days="3"))
    keys = with_row_key(batch, "user_id,event_type").groupBy("row_key").agg(F.max(CURSOR_TIME).alias(CURSOR_TIME))
    return batch_metrics(keys, F.col(CURSOR_TIME))


def _metric_sql(config: str, source: str, keys: str, cursor: str, where: str, floor: str) -> str:
    return f"""SELECT '{config}' AS config_id, '{source}' AS source, count(DISTINCT {keys}) AS key_count,
        count(*) = 0 AS is_empty, coalesce(strftime(max({cursor}), '%Y%m%d%H%M%S'), '{floor}') AS next_cursor
        FROM {source} WHERE {where}"""


@query(
    " UNION ALL ".join(
        [
            _metric_sql("1", "events", "(user_id, event_type)", "ts", "ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'", ""),
            _metric_sql("2", "orders", "o_custkey", "o_orderdate", "o_orderdate >= TIMESTAMP '1997-01-01'", ""),
            _metric_sql("3", "lineitem", "(l_orderkey, l_suppkey)", "l_shipdate", "true", ""),
            _metric_sql("4", "events", "event_id", "ts", "ts >= TIMESTAMP '2030-01-01' AND ts < TIMESTAMP '2030-01-31'", "20300121000000"),
        ]
    )
)
def configured_exports(spark: SparkSession, sf: str) -> DataFrame:
    """Four config rows, one row of metrics each; the last window is empty and cut at the run time."""
    rows = [
        {"ID": "1", "HIVE_TBNAME": path(sf, "events"), "ROWKEY": "user_id,event_type", "HIVE_COLUMNS": "*",
         "HIVE_COLUMNS_CJSJ": "ts", "HIVE_COLUMNS_CJSJ_LASTTIME": "20240105000000", "TIME_STEP_NUM": "7"},
        {"ID": "2", "HIVE_TBNAME": path(sf, "orders"), "ROWKEY": "o_custkey", "HIVE_COLUMNS": "o_custkey, o_orderdate",
         "HIVE_COLUMNS_CJSJ": "o_orderdate", "HIVE_COLUMNS_CJSJ_LASTTIME": "19970101000000", "TIME_STEP_NUM": "0"},
        {"ID": "3", "HIVE_TBNAME": path(sf, "lineitem"), "ROWKEY": "l_orderkey,l_suppkey", "HIVE_COLUMNS": "l_orderkey, l_suppkey",
         "HIVE_COLUMNS_CJSJ": "l_shipdate", "HIVE_COLUMNS_CJSJ_LASTTIME": None, "TIME_STEP_NUM": None},
        {"ID": "4", "HIVE_TBNAME": path(sf, "events"), "ROWKEY": "event_id", "HIVE_COLUMNS": "event_id",
         "HIVE_COLUMNS_CJSJ": "TS", "HIVE_COLUMNS_CJSJ_LASTTIME": "20300101000000", "TIME_STEP_NUM": "30"},
    ]
    specs = [JobSpec.from_row(row) for row in rows]
    metrics = all_metrics(spark, specs, run_time=dt.datetime(2030, 1, 21))
    return metrics.withColumn("source", F.regexp_extract("source", r"([a-z]+)\.parquet$", 1))


@query(
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(19, 4)) AS VARCHAR) AS o_totalprice, o_orderdate, upper(o_orderpriority) AS priority
       FROM orders WHERE o_orderdate > TIMESTAMP '1998-10-03'"""
)
def append_batch(spark: SparkSession, sf: str) -> DataFrame:
    spec = JobSpec(
        source=path(sf, "orders"),
        columns="o_orderkey, o_totalprice, o_orderdate, upper(o_orderpriority) as priority",
        cursor_column="o_orderdate",
        cursor="19981003000000",
        cursor_type="timestamp",
    )
    rows = append_rows_of(spark, spec)
    return rows.withColumn("o_totalprice", F.col("o_totalprice").cast("string"))


@query(
    """SELECT concat_ws('_', s_nationkey, CAST(s_suppkey AS VARCHAR)) AS row_key, s_name,
              CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(s_suppkey AS VARCHAR) AS s_suppkey FROM supplier"""
)
def reload_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return reload_records(table(spark, sf, "supplier"), "s_nationkey,s_suppkey", "s_suppkey, s_name, s_nationkey")


@query()
def random_key_load(spark: SparkSession, sf: str) -> DataFrame:
    return full_load_records(table(spark, sf, "customer"), ["c_name", "c_mktsegment"])
