"""Config rows as JSON, run log, cursor table: built from the event and order tables."""

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import digits14
from ..plans.runlog import LOG_COLUMNS, CursorTable, RunLog, current_cursors, run_state, runs_per_source
from ..plans.spec import APPEND_COLUMNS, from_config_json, to_config_json, with_cursors
from . import query, table


# Every user is a source; its config row goes to JSON and comes back.
@query(
    """SELECT concat('events_', user_id) AS hive_tbname, 'event_id, "ts"' AS hive_columns, 'ts' AS hive_columns_cjsj,
              strftime(max(ts), '%Y%m%d%H%M%S') AS hive_columns_cjsj_lasttime, 'timestamp' AS hive_columns_cjsj_type,
              concat('T_', user_id) AS oracle_tbname, CAST(NULL AS VARCHAR) AS trsdr_sjly FROM events GROUP BY user_id"""
)
def configs_through_json(spark: SparkSession, sf: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    last = table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("ts"))
    configs = last.select(
        F.concat(F.lit("events_"), user).alias("hive_tbname"),
        F.lit('event_id, "ts"').alias("hive_columns"),
        F.lit("ts").alias("hive_columns_cjsj"),
        digits14(F.col("ts")).alias("hive_columns_cjsj_lasttime"),
        F.lit("timestamp").alias("hive_columns_cjsj_type"),
        F.concat(F.lit("T_"), user).alias("oracle_tbname"),
        F.lit(None).cast("string").alias("trsdr_sjly"),
    )
    sent = configs.select(to_config_json(configs).alias("args"))
    return sent.select(from_config_json(F.col("args")).alias("c")).select(*[f"c.{n}" for n in APPEND_COLUMNS.values()])


# Orders stand for runs: each has a start event; F ended well, P failed, O is still running.
def _log_events(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    run, end = F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR")
    source = F.concat(F.lit("t"), (F.col("o_custkey") % 50).cast("string"))
    empty = {n: F.lit(None).cast(k).alias(n) for n, k in LOG_COLUMNS.items()}

    def event(rows: DataFrame, **values) -> DataFrame:
        columns = empty | {n: c.cast(LOG_COLUMNS[n]).alias(n) for n, c in values.items() if n != "event_time"} | {"id": run}
        return rows.select(*columns.values(), values["event_time"].alias("event_time"))

    started = event(
        orders,
        relaid=F.col("o_custkey"),
        hive_tbname=source,
        start_time=F.col("o_orderdate"),
        appid=F.concat(F.lit("app_"), F.col("o_orderkey").cast("string")),
        app_url=F.concat(F.lit("http://driver:4040/"), F.col("o_orderkey").cast("string")),
        event_time=F.col("o_orderdate"),
    )
    good = event(
        orders.where("o_orderstatus = 'F'"),
        row_nums=F.round("o_totalprice"),
        end_time=end,
        is_success=F.lit("1"),
        increment_time=digits14(F.col("o_orderdate")),
        event_time=end,
    )
    bad = event(orders.where("o_orderstatus = 'P'"), is_success=F.lit("0"), last_update_time=end, event_time=end)
    return started.unionByName(good).unionByName(bad)


_STATE_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS relaid,
    concat('t', o_custkey % 50) AS hive_tbname, o_orderdate AS start_time, concat('http://driver:4040/', o_orderkey) AS app_url,
    concat('app_', o_orderkey) AS appid, CASE WHEN o_orderstatus = 'F' THEN CAST(round(o_totalprice) AS BIGINT) END AS row_nums,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 HOUR END AS end_time,
    CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'P' THEN '0' END AS is_success,
    CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y%m%d%H%M%S') END AS increment_time,
    CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 1 HOUR END AS last_update_time FROM orders"""


# counts with nulls are compared as text
@query(f"SELECT * REPLACE (CAST(row_nums AS VARCHAR) AS row_nums) FROM ({_STATE_SQL})")
def run_log_state(spark: SparkSession, sf: str) -> DataFrame:
    state = run_state(_log_events(spark, sf))
    return state.withColumn("row_nums", F.col("row_nums").cast("string"))


@query(
    f"""SELECT hive_tbname, count(*) AS runs, count(*) FILTER (is_success = '1') AS succeeded,
               count(*) FILTER (is_success = '0') AS failed, count(*) FILTER (is_success IS NULL) AS unfinished,
               CAST(coalesce(sum(row_nums), 0) AS BIGINT) AS rows_moved FROM ({_STATE_SQL}) GROUP BY hive_tbname"""
)
def run_log_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return runs_per_source(run_state(_log_events(spark, sf)))


# The last run of every source is noted as failed after the log was folded.
@query(
    f"""SELECT s.* REPLACE (CAST(row_nums AS VARCHAR) AS row_nums, CASE WHEN l.id IS NULL THEN is_success ELSE '0' END AS is_success,
                            CASE WHEN l.id IS NULL THEN last_update_time ELSE TIMESTAMP '2024-06-01' END AS last_update_time)
        FROM ({_STATE_SQL}) s LEFT JOIN (SELECT CAST(max(o_orderkey) AS VARCHAR) AS id FROM orders GROUP BY o_custkey % 50) l
        ON s.id = l.id"""
)
def run_log_snapshot_and_tail(spark: SparkSession, sf: str) -> DataFrame:
    log = RunLog(spark, f"{spark.conf.get('spark.sql.warehouse.dir')}/written_{uuid.uuid4().hex}")
    log.take_in(_log_events(spark, sf))
    last = table(spark, sf, "orders").groupBy((F.col("o_custkey") % 50).alias("source")).agg(F.max("o_orderkey").alias("run"))
    noted = dt.datetime(2024, 6, 1)
    for row in last.toLocalIterator():
        log.add(id=str(row["run"]), is_success="0", last_update_time=noted, event_time=noted)
    return log.state().withColumn("row_nums", F.col("row_nums").cast("string"))


# Every event moves its user's cursor; the clock runs backwards, the versions do not.
@query(
    """SELECT CAST(user_id AS VARCHAR) AS config_id, strftime(min(ts), '%Y%m%d%H%M%S') AS cursor
       FROM events GROUP BY user_id"""
)
def cursors_by_version(spark: SparkSession, sf: str) -> DataFrame:
    cursors = CursorTable(spark, f"{spark.conf.get('spark.sql.warehouse.dir')}/written_{uuid.uuid4().hex}")
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    moves = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("config_id"), digits14(F.col("ts")).alias("cursor"), F.col("ts").alias("run_ts"),
        (F.lit(1 << 40) - at).alias("version"),
    )
    cursors.take_in(moves)
    return cursors.current()


@query(
    """SELECT CAST(user_id AS VARCHAR) AS config_id, strftime(max(ts), '%Y%m%d%H%M%S') AS cursor
       FROM events GROUP BY user_id"""
)
def cursors_current(spark: SparkSession, sf: str) -> DataFrame:
    history = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("config_id"), digits14(F.col("ts")).alias("cursor"), F.col("ts").alias("run_ts")
    )
    return current_cursors(history)


# Every user is a config; those with an even number have a cursor saved by a run, the others their own.
@query(
    """SELECT CAST(user_id AS VARCHAR) AS id, CASE WHEN user_id % 2 = 0 THEN strftime(max(ts), '%Y%m%d%H%M%S')
              ELSE '20240101000000' END AS hive_columns_cjsj_lasttime FROM events GROUP BY user_id"""
)
def configs_with_cursors(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    configs = events.select(F.col("user_id").cast("string").alias("id")).distinct()
    configs = configs.withColumn("hive_columns_cjsj_lasttime", F.lit("20240101000000"))
    history = events.where("user_id % 2 = 0").select(
        F.col("user_id").cast("string").alias("config_id"), digits14(F.col("ts")).alias("cursor"), F.col("ts").alias("run_ts")
    )
    return with_cursors(configs, current_cursors(history))
