"""Identity numbers, made from customer rows under the region code for "abroad"."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import idnum
from ..functions.canonical import TextRules, canonical
from ..operators.quality import id_report
from . import query, table

# A 15 digit number from the customer key. By key, some are spoiled: a bad region, a bad day,
# a letter, one digit less, a blank, 29 February in and out of a leap year.
_DAY_SQL = "printf('%02d%02d%02d', c_custkey % 100, c_custkey % 12 + 1, c_custkey % 28 + 1)"
_TAIL_SQL = "printf('%03d', c_custkey % 1000)"
_N15_SQL = f"""CASE c_custkey % 10 WHEN 1 THEN concat('990101', {_DAY_SQL}, {_TAIL_SQL})
    WHEN 2 THEN concat('910101', printf('%02d', c_custkey % 100), '1345', {_TAIL_SQL})
    WHEN 3 THEN concat('91O101', {_DAY_SQL}, {_TAIL_SQL})
    WHEN 4 THEN concat('91101', {_DAY_SQL}, {_TAIL_SQL})
    WHEN 5 THEN ' ' WHEN 6 THEN concat('910101', printf('%02d', c_custkey % 100), '0229', {_TAIL_SQL})
    ELSE concat('910101', {_DAY_SQL}, {_TAIL_SQL}) END"""


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def _n15() -> Column:
    key = F.col("c_custkey")
    year, tail = _two(key % 100), F.lpad((key % 1000).cast("string"), 3, "0")
    day = F.concat(year, _two(key % 12 + 1), _two(key % 28 + 1))
    kind = key % 10
    return (
        F.when(kind == 1, F.concat(F.lit("990101"), day, tail))
        .when(kind == 2, F.concat(F.lit("910101"), year, F.lit("1345"), tail))
        .when(kind == 3, F.concat(F.lit("91O101"), day, tail))
        .when(kind == 4, F.concat(F.lit("91101"), day, tail))
        .when(kind == 5, F.lit(" "))
        .when(kind == 6, F.concat(F.lit("910101"), year, F.lit("0229"), tail))
        .otherwise(F.concat(F.lit("910101"), day, tail))
    )


def _valid15_sql(c: str) -> str:
    return f"""(regexp_full_match({c}, '[0-9]{{15}}') AND substr({c}, 1, 2) = '91'
        AND try_strptime('20' || substr({c}, 7, 6), '%Y%m%d') IS NOT NULL)"""


def _check_sql(c: str) -> str:
    # Weights and check characters of the public standard.
    weights = (7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2)
    total = " + ".join(f"TRY_CAST(substr({c}, {i}, 1) AS INTEGER) * {w}" for i, w in enumerate(weights, 1))
    return f"substr('10X98765432', ({total}) % 11 + 1, 1)"


_LONG_SQL = "concat(substr(n15, 1, 6), '19', substr(n15, 7))"
_N18_SQL = f"CASE WHEN {_valid15_sql('n15')} THEN concat({_LONG_SQL}, {_check_sql(_LONG_SQL)}) ELSE n15 END"
# of the upgraded numbers some get a wrong or a lower-case check character
_SPOILT_SQL = """CASE WHEN length(n18) < 18 THEN n18 WHEN c_custkey % 4 = 0 THEN lower(n18)
    WHEN c_custkey % 4 = 1 THEN concat(substr(n18, 1, 17), 'A') ELSE n18 END"""
_BASE_SQL = f"""SELECT *, {_SPOILT_SQL} AS spoilt FROM (SELECT *, {_N18_SQL} AS n18 FROM (
    SELECT c_custkey, {_N15_SQL} AS n15 FROM customer))"""


def _valid18_sql(c: str) -> str:
    return f"""(regexp_full_match({c}, '[0-9]{{17}}[0-9Xx]') AND substr({c}, 1, 2) = '91'
        AND try_strptime(substr({c}, 7, 8), '%Y%m%d') IS NOT NULL AND upper(substr({c}, 18, 1)) = {_check_sql(c)})"""


def _numbers(spark: SparkSession, sf: str) -> DataFrame:
    n18 = F.col("n18")
    spoilt = (
        F.when(F.length(n18) < 18, n18)
        .when(F.col("c_custkey") % 4 == 0, F.lower(n18))
        .when(F.col("c_custkey") % 4 == 1, F.concat(F.substring(n18, 1, 17), F.lit("A")))
        .otherwise(n18)
    )
    base = table(spark, sf, "customer").select("c_custkey", _n15().alias("n15"))
    return base.withColumn("n18", idnum.to_18(F.col("n15"))).withColumn("spoilt", spoilt)


@query(f"SELECT c_custkey, n15, n18 FROM ({_BASE_SQL})")
def ids_upgraded(spark: SparkSession, sf: str) -> DataFrame:
    return _numbers(spark, sf).select("c_custkey", "n15", "n18")


_DIGITS_SQL = f"""SELECT c_custkey, CASE WHEN regexp_full_match(n15, '[0-9]{{15}}') THEN CAST(CAST(n15 AS BIGINT) AS VARCHAR) END AS n15
    FROM ({_BASE_SQL})"""


@query(f"SELECT c_custkey, coalesce({_N18_SQL}, '') AS number FROM ({_DIGITS_SQL})")
def ids_upgraded_numeric(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers that are stored as integers are upgraded like text."""
    number = F.when(F.col("n15").rlike("^[0-9]{15}$"), F.col("n15")).cast("bigint").alias("number")
    df = _numbers(spark, sf).select("c_custkey", number)
    return df.select("c_custkey", canonical(df, "number", "", TextRules(id_columns=("number",))).alias("number"))


@query(f"SELECT c_custkey, {_valid15_sql('n15')} AS is_valid FROM ({_BASE_SQL})")
def ids_valid_15(spark: SparkSession, sf: str) -> DataFrame:
    return _numbers(spark, sf).select("c_custkey", idnum.is_valid_15(F.col("n15")).alias("is_valid"))


@query(f"SELECT c_custkey, spoilt, coalesce({_valid18_sql('spoilt')}, false) AS is_valid FROM ({_BASE_SQL})")
def ids_valid_18(spark: SparkSession, sf: str) -> DataFrame:
    return _numbers(spark, sf).select("c_custkey", "spoilt", idnum.is_valid_18(F.col("spoilt")).alias("is_valid"))


@query(
    f"""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN {_valid15_sql("n15")}
               ELSE coalesce({_valid18_sql("spoilt")} OR {_valid15_sql("spoilt")}, false) END AS is_valid FROM ({_BASE_SQL})"""
)
def ids_valid(spark: SparkSession, sf: str) -> DataFrame:
    number = F.when(F.col("c_custkey") % 2 == 0, F.col("n15")).otherwise(F.col("spoilt"))
    return _numbers(spark, sf).select("c_custkey", idnum.is_valid(number).alias("is_valid"))


def _class_sql(c: str) -> str:
    return f"""CASE WHEN trim({c}) = '' THEN 'blank' WHEN {_valid15_sql(c)} THEN 'valid_15'
        WHEN {_valid18_sql(c)} THEN 'valid_18' ELSE 'invalid' END"""


@query(
    f"""SELECT column_name, validity, count(*) AS row_count FROM (
            SELECT 'n15' AS column_name, {_class_sql("n15")} AS validity FROM ({_BASE_SQL})
            UNION ALL SELECT 'spoilt', {_class_sql("spoilt")} FROM ({_BASE_SQL})) GROUP BY ALL"""
)
def id_quality(spark: SparkSession, sf: str) -> DataFrame:
    return id_report(_numbers(spark, sf), "n15, spoilt")
