"""Cells, their way back to records, and upserts."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canonical import TextRules, canonical
from ..operators.cells import collect_cells, from_cells, lookup_cell, to_cells
from ..operators.keys import with_row_key
from ..operators.layout import sorted_layout
from ..operators.upsert import upsert_cells, upsert_records
from ..plans.jobs import keyed_records
from . import query, table

_ORDER_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS row_key, CAST(o_custkey AS VARCHAR) AS o_custkey,
    strftime(o_orderdate, '%Y%m%d%H%M%S') AS o_orderdate, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
    o_orderpriority, CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE o_orderstatus END AS o_orderstatus,
    CAST(CAST(o_totalprice AS DECIMAL(38, 2)) AS VARCHAR) AS o_totalprice FROM orders"""
_QUALIFIERS = ["o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"]
_RULES = TextRules(decimal_scale=2)


def _unpivot(select: str, names: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT row_key, '{n}' AS qualifier, {n} AS value FROM ({select})" for n in names)


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("o_orderkey") % 6 == 0, F.lit(None)).otherwise(F.col("o_orderstatus"))
    return table(spark, sf, "orders").withColumn("o_orderstatus", status)


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """Order keys are unique, so no step is needed that keeps one of them."""
    df = _orders(spark, sf)
    return with_row_key(df, "o_orderkey").select("row_key", *[canonical(df, q, "", _RULES).alias(q) for q in _QUALIFIERS])


@query(f"SELECT row_key, 'cf1' AS family, qualifier, value FROM ({_unpivot(_ORDER_SQL, _QUALIFIERS)})")
def order_cells(spark: SparkSession, sf: str) -> DataFrame:
    return to_cells(_records(spark, sf))


@query(f"SELECT row_key, 'cf1' AS family, qualifier, value FROM ({_unpivot(_ORDER_SQL, _QUALIFIERS)})")
def sorted_order_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Records are sorted, cells are not: they come out of sorted records in order."""
    return to_cells(sorted_layout(keyed_records(_orders(spark, sf), "o_orderkey", _RULES, latest_by=["o_orderdate"])))


@query(_ORDER_SQL)
def cells_to_records(spark: SparkSession, sf: str) -> DataFrame:
    return from_cells(to_cells(_records(spark, sf)), _QUALIFIERS)


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS row_key,
              CASE WHEN o_orderkey % 6 = 0 THEN 'unknown' ELSE o_orderstatus END AS value FROM orders"""
)
def cell_with_default(spark: SparkSession, sf: str) -> DataFrame:
    return lookup_cell(to_cells(_records(spark, sf)), "o_orderstatus", "unknown")


# The first value per user and qualifier, by event number; cells are joined for comparison.
_EVENT_CELLS = ("event_type", "props", "ts", "value")


@query(
    """WITH first AS (SELECT user_id, min_by(event_type, event_id) AS event_type, min_by(props, event_id) AS props,
              min_by(strftime(ts, '%Y%m%d%H%M%S'), event_id) AS ts,
              min_by(CAST(CAST(value AS DECIMAL(38, 2)) AS VARCHAR), event_id) AS value FROM events GROUP BY user_id)
       SELECT CAST(user_id AS VARCHAR) AS row_key,
              concat('event_type=', event_type, ',props=', props, ',ts=', ts, ',value=', value) AS cells FROM first"""
)
def cells_per_key(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    texts = with_row_key(events, "user_id").select(
        "row_key", F.col("event_id").alias("at"), *[canonical(events, q, "", _RULES).alias(q) for q in _EVENT_CELLS]
    )
    cells = texts.unpivot(["row_key", "at"], list(_EVENT_CELLS), "qualifier", "value")
    shown = F.transform("cells", lambda c: F.concat(c["qualifier"], F.lit("="), c["value"]))
    return collect_cells(cells, ["at"]).select("row_key", F.array_join(shown, ",").alias("cells"))


# A later batch holds a third of the orders, with another priority, and no other column.
_LATER_SQL = "SELECT CAST(o_orderkey AS VARCHAR) AS row_key, lower(o_orderpriority) AS o_orderpriority FROM orders WHERE o_custkey % 3 = 0"


def _later(spark: SparkSession, sf: str) -> DataFrame:
    changed = table(spark, sf, "orders").where(F.col("o_custkey") % 3 == 0)
    key = F.col("o_orderkey").cast("string").alias("row_key")
    return changed.select(key, F.lower("o_orderpriority").alias("o_orderpriority"))


@query(
    f"""SELECT row_key, family, qualifier, value FROM (SELECT *, row_number() OVER (
            PARTITION BY row_key, family, qualifier ORDER BY batch DESC) AS rn FROM (
            SELECT row_key, 'cf1' AS family, qualifier, value, 1 AS batch FROM ({_unpivot(_ORDER_SQL, _QUALIFIERS)})
            UNION ALL SELECT row_key, 'cf1', 'o_orderpriority', o_orderpriority, 2 FROM ({_LATER_SQL}))) WHERE rn = 1"""
)
def cells_upserted(spark: SparkSession, sf: str) -> DataFrame:
    later = to_cells(_later(spark, sf))
    return upsert_cells(to_cells(_records(spark, sf)), later, later)


@query(
    f"""SELECT o.row_key, o.o_custkey, o.o_orderdate, o.o_orderkey,
               coalesce(l.o_orderpriority, o.o_orderpriority) AS o_orderpriority, o.o_orderstatus, o.o_totalprice
        FROM ({_ORDER_SQL}) o LEFT JOIN ({_LATER_SQL}) l ON o.row_key = l.row_key"""
)
def records_upserted(spark: SparkSession, sf: str) -> DataFrame:
    return upsert_records(_records(spark, sf), _later(spark, sf))
