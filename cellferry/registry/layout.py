"""Order, samples, key buckets, split points."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import layout
from ..operators.keys import with_row_key
from ..session import ensure_checkpoint_dir
from ..sources.tables import ROW_KEY
from . import query, table

_EVENT_KEY = "concat(user_id, '_', event_id)"


def _event_keys(spark: SparkSession, sf: str) -> DataFrame:
    return with_row_key(table(spark, sf, "events").select("user_id", "event_id"), "user_id,event_id").select(ROW_KEY)


def _placed(df: DataFrame) -> DataFrame:
    """All rows, each with whether its key follows the one before it, in its partition and across partitions.

    Partitions are written to the checkpoint folder first, so that their numbers stay as they are.
    """
    ensure_checkpoint_dir(df.sparkSession)
    part, at = F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")
    rows = df.select("*", part, at).checkpoint()
    # one row per partition: where the keys of those before it end
    ends = rows.groupBy("part").agg(F.max(ROW_KEY).alias("last"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.broadcast(ends.select("part", F.max("last").over(before).alias("reached")))
    previous = F.lag(ROW_KEY).over(Window.partitionBy("part").orderBy("at"))
    joined = rows.withColumn("previous", previous).join(reached, "part")
    in_order = F.coalesce(F.col(ROW_KEY) >= F.greatest("previous", "reached"), F.lit(True))
    return joined.select(*df.columns, in_order.alias("in_order"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS row_key, o_orderstatus, true AS in_order FROM orders")
def ordered_keys(spark: SparkSession, sf: str) -> DataFrame:
    keyed = with_row_key(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey")
    return _placed(layout.total_order(keyed.select(ROW_KEY, "o_orderstatus")))


@query("SELECT concat(l_orderkey, '_', l_linenumber) AS row_key, l_returnflag, true AS in_order FROM lineitem")
def sorted_layout_keys(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("l_orderkey", "l_linenumber", "l_returnflag")
    keyed = with_row_key(table(spark, sf, "lineitem").select(*columns), "l_orderkey,l_linenumber")
    return _placed(layout.sorted_layout(keyed.select(ROW_KEY, "l_returnflag")))


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate FROM lineitem ORDER BY ALL LIMIT 10")
def first_ten(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"]
    return layout.first_rows(table(spark, sf, "lineitem").select(*columns), columns, 10)


@query(
    f"""SELECT DISTINCT row_key FROM (SELECT {_EVENT_KEY} AS row_key FROM events)
        WHERE substr(md5(row_key), 1, 8) < '051eb851'"""
)
def key_sample(spark: SparkSession, sf: str) -> DataFrame:
    return layout.sample_keys_by_hash(_event_keys(spark, sf), 0.02)


@query()
def key_sample_random(spark: SparkSession, sf: str) -> DataFrame:
    return layout.sample_keys(_event_keys(spark, sf), 0.02, seed=7)


def _bucket_sql(points: str, rows: str) -> str:
    """Rows by the greatest split point that is not above the whole key."""
    numbered = f"SELECT point, row_number() OVER (ORDER BY point) AS number FROM (SELECT unnest({points}) AS point)"
    bucket = f"SELECT coalesce(p.number, 0) AS bucket FROM ({rows}) k ASOF LEFT JOIN ({numbered}) p ON k.row_key >= p.point"
    return f"SELECT bucket, count(*) AS row_count FROM ({bucket}) GROUP BY bucket"


# The split points of the general table.
_ALPHABET = "string_split('123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')"
_GENERAL = f"""list_concat(list_transform(range(10, 100), lambda n: '0' || n),
    flatten(list_transform({_ALPHABET}, lambda a: list_transform({_ALPHABET}, lambda b: a || b))))"""
_MIXED = "SELECT upper(substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 6)) AS row_key FROM lineitem"


def _mixed(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("l_orderkey").cast("string")
    return table(spark, sf, "lineitem").select(F.upper(F.substring(F.md5(text), 1, 6)).alias(ROW_KEY))


@query(_bucket_sql(_GENERAL, _MIXED))
def buckets_general(spark: SparkSession, sf: str) -> DataFrame:
    return layout.bucket_report(_mixed(spark, sf), layout.general_splits())


# Two digits from 00 to 69.
@query(_bucket_sql("list_transform(range(70), lambda n: lpad(CAST(n AS VARCHAR), 2, '0'))", f"SELECT {_EVENT_KEY} AS row_key FROM events"))
def buckets_two_digit(spark: SparkSession, sf: str) -> DataFrame:
    return layout.bucket_report(_event_keys(spark, sf), layout.two_digit_splits())


# The five prefixes.
@query(_bucket_sql("['43', '53', '54', '62', '65']", f"SELECT {_EVENT_KEY} AS row_key FROM events"))
def buckets_stay(spark: SparkSession, sf: str) -> DataFrame:
    return layout.bucket_report(_event_keys(spark, sf), layout.stay_splits())


@query(
    """SELECT o_orderkey, CAST(len(list_filter(['43', '53', '54', '62', '65'],
              lambda p: p <= CAST(o_orderkey AS VARCHAR))) AS INTEGER) AS bucket FROM orders"""
)
def bucket_of_key(spark: SparkSession, sf: str) -> DataFrame:
    bucket = layout.bucket_number(F.col("o_orderkey").cast("string"), layout.stay_splits())
    return table(spark, sf, "orders").select("o_orderkey", bucket.alias("bucket"))


@query(
    f"""SELECT CAST(tile AS INTEGER) AS tile, min(row_key) AS first_key FROM (
            SELECT row_key, ntile(16) OVER (ORDER BY row_key) AS tile FROM (
                SELECT DISTINCT row_key FROM (SELECT {_EVENT_KEY} AS row_key FROM events)
                WHERE substr(md5(row_key), 1, 8) < '40000000')) GROUP BY tile"""
)
def split_points_of_sample(spark: SparkSession, sf: str) -> DataFrame:
    return layout.split_points(layout.sample_keys_by_hash(_event_keys(spark, sf), 0.25), 16)


_WEIGHED = "SELECT concat(l_orderkey, '_', l_linenumber) AS row_key, sum(CAST(l_quantity AS BIGINT)) AS w FROM lineitem GROUP BY ALL"


@query(
    f"""SELECT CAST(tile AS INTEGER) AS tile, min(row_key) AS first_key FROM (
            SELECT row_key, least(floor(coalesce(sum(w) OVER (ORDER BY row_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                                        / (sum(w) OVER () / 24.0::DOUBLE)), 23) + 1 AS tile FROM ({_WEIGHED})) GROUP BY tile"""
)
def split_points_by_bytes(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("w"))
    return layout.weighted_split_points(with_row_key(lines, "l_orderkey,l_linenumber"), 24, "w")
