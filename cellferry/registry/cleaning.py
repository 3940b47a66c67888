"""Text, date and number clean-up over whole tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from ..functions.canonical import TextRules, canonical_by_type, standardise
from ..operators.quality import distinct_tokens, rows_listed, rows_per_prefix, rows_with_blank
from ..operators.typemap import cast_for_sink, cast_from_source, sink_report
from . import query, table

# Blanks of several kinds, made from the priority column by order number.
_BLANKED = """CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   '
              WHEN 3 THEN concat(chr(9), chr(12288)) WHEN 4 THEN chr(160) ELSE o_orderpriority END"""
_DUCK_BLANK = r"regexp_full_match({}, '[\x{{9}}-\x{{d}}\x{{1c}}-\x{{20}}\x{{3000}}]*')"


def _blanked() -> Column:
    key = F.col("o_orderkey") % 7
    return (
        F.when(key == 0, F.lit(None))
        .when(key == 1, "")
        .when(key == 2, "   ")
        .when(key == 3, "\t\u3000")
        .when(key == 4, "\u00a0")
        .otherwise(F.col("o_orderpriority"))
    )


@query(
    f"""SELECT o_orderkey, v IS NULL OR {_DUCK_BLANK.format("v")} AS is_blank,
               CASE WHEN v IS NULL OR {_DUCK_BLANK.format("v")} THEN 'none' ELSE v END AS filled
        FROM (SELECT o_orderkey, {_BLANKED} AS v FROM orders)"""
)
def blanks_filled(spark: SparkSession, sf: str) -> DataFrame:
    v = _blanked()
    return table(spark, sf, "orders").select("o_orderkey", text.is_blank(v).alias("is_blank"), text.blank_to(v, "none").alias("filled"))


@query(
    r"""SELECT doc_id, regexp_replace(concat(chr(9), ' ', chr(31), text, chr(13), chr(10)),
               '^[\x{1}-\x{20}]+|[\x{1}-\x{20}]+$', '', 'g') AS trimmed FROM documents"""
)
def texts_trimmed(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.concat(F.lit("\t \u001f"), F.col("text"), F.lit("\r\n"))
    return table(spark, sf, "documents").select("doc_id", text.control_trim(padded).alias("trimmed"))


# A moment of the order day, and the eight layouts it is printed in by order number; a ninth is no date.
_MOMENT_SQL = "(o_orderdate + to_seconds(o_orderkey * 37 % 86400))"
_LAYOUTS_SQL = (
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%d",
    "%Y/%m/%d",
    "%Y/%m/%d %H:%M:%S",
    "%Y年%m月%d日",
    "%Y.%m.%d",
    "%Y.%m.%d %H:%M:%S",
    "%Y%m%d%H%M%S",
)
_PRINTED_SQL = (
    "CASE o_orderkey % 9 "
    + " ".join(f"WHEN {i} THEN strftime({_MOMENT_SQL}, '{p}')" for i, p in enumerate(_LAYOUTS_SQL))
    + f" ELSE concat('n/a ', strftime({_MOMENT_SQL}, '%d-%m-%Y')) END"
)
_DAY_ONLY = (1, 2, 4, 5)


def _moment() -> Column:
    return F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey") * 37 % 86400)


def _printed() -> Column:
    which, moment = F.col("o_orderkey") % 9, _moment()
    printed = F.concat(F.lit("n/a "), F.date_format(moment, "dd-MM-yyyy"))
    for number, layout in enumerate(dates.DATE_LAYOUTS):
        printed = F.when(which == number, F.date_format(moment, layout)).otherwise(printed)
    return printed


_PARSED_SQL = f"""CASE WHEN o_orderkey % 9 = 8 THEN NULL
    WHEN o_orderkey % 9 IN {_DAY_ONLY} THEN strftime(o_orderdate, '%Y%m%d000000')
    ELSE strftime({_MOMENT_SQL}, '%Y%m%d%H%M%S') END"""


@query(f"SELECT o_orderkey, {_PRINTED_SQL} AS printed, {_PARSED_SQL} AS parsed FROM orders")
def dates_parsed(spark: SparkSession, sf: str) -> DataFrame:
    printed = table(spark, sf, "orders").select("o_orderkey", _printed().alias("printed"))
    return printed.withColumn("parsed", dates.digits14(dates.parse_date(F.col("printed"))))


@query(
    f"""SELECT o_orderkey, split_part(translate(concat({_PRINTED_SQL}, '.123'), '/- :', ''), '.', 1) AS stripped
        FROM orders"""
)
def dates_stripped(spark: SparkSession, sf: str) -> DataFrame:
    printed = F.concat(_printed(), F.lit(".123"))
    return table(spark, sf, "orders").select("o_orderkey", dates.strip_date(printed).alias("stripped"))


# The clean-up cuts at the first full stop, so the two layouts with full stops stay as they are.
@query(
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 9 IN (5, 6) THEN {_PRINTED_SQL}
                                ELSE coalesce({_PARSED_SQL}, {_PRINTED_SQL}) END AS normalised FROM orders"""
)
def dates_normalised(spark: SparkSession, sf: str) -> DataFrame:
    printed = table(spark, sf, "orders").select("o_orderkey", _printed().alias("printed"))
    return printed.select("o_orderkey", dates.normalise_date(F.col("printed")).alias("normalised"))


@query(
    """SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS digits14, strftime(ts, '%Y%m%d') AS digits8,
              strftime(ts, '%d/%m/%Y %H.%M') AS printed,
              strftime(ts + to_days(CAST(user_id % 40 AS INTEGER)), '%Y%m%d%H%M%S') AS later,
              strftime(date_trunc('month', ts), '%Y%m%d') AS month_start FROM events"""
)
def dates_formatted(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id",
        dates.digits14(ts).alias("digits14"),
        dates.digits8(ts).alias("digits8"),
        dates.format_date(ts, "dd/MM/yyyy HH.mm").alias("printed"),
        dates.digits14(dates.add_days(ts, (F.col("user_id") % 40).cast("int"))).alias("later"),
        dates.digits8(F.date_trunc("month", ts)).alias("month_start"),
    )


@query(
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN event_id * 1000 ELSE 0 END AS number FROM events"""
)
def numbers_guarded(spark: SparkSession, sf: str) -> DataFrame:
    which = F.col("event_id") % 4
    shown = (
        F.when(which == 0, (F.col("event_id") * 1000).cast("string"))
        .when(which == 1, F.concat(F.col("event_id").cast("string"), F.lit(".5")))
        .when(which == 2, F.col("event_type"))
        .otherwise(F.concat(F.lit("0x"), F.col("event_id").cast("string")))
    )
    return table(spark, sf, "events").select("event_id", text.as_long_or_zero(shown).alias("number"))


def _standard_sql(order_rq: str) -> str:
    return f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y%m%d') AS o_day,
    strftime(o_orderdate, '%Y%m%d%H%M%S') AS o_orderdate,
    CASE WHEN v IS NULL OR {_DUCK_BLANK.format("v")} THEN '' ELSE v END AS o_orderpriority,
    CAST(CAST(o_totalprice AS DECIMAL(38, 2)) AS VARCHAR) AS o_totalprice, {order_rq} AS order_rq
    FROM (SELECT *, {_BLANKED} AS v FROM orders)"""


def _order_texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("o_day"),
        "o_orderdate",
        F.concat(F.lit(" "), _blanked(), F.lit("\r")).alias("o_orderpriority"),
        "o_totalprice",
        F.concat(F.lit("\t"), _printed(), F.lit(" ")).alias("order_rq"),
    )


@query(
    _standard_sql(
        f"CASE WHEN o_orderkey % 9 IN (5, 6) THEN {_PRINTED_SQL} ELSE coalesce({_PARSED_SQL}, {_PRINTED_SQL}) END"
    )
)
def table_standardised(spark: SparkSession, sf: str) -> DataFrame:
    return standardise(_order_texts(spark, sf), TextRules(decimal_scale=2))


@query(_standard_sql(f"split_part(translate({_PRINTED_SQL}, '/- :', ''), '.', 1)"))
def table_standardised_stripped(spark: SparkSession, sf: str) -> DataFrame:
    return standardise(_order_texts(spark, sf), TextRules(decimal_scale=2, date_mode="strip"))


@query(
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y%m%d%H%M%S') AS o_orderdate,
               CASE WHEN v IS NULL OR {_DUCK_BLANK.format("v")} THEN 'null' ELSE v END AS priority
        FROM (SELECT *, {_BLANKED} AS v FROM orders)"""
)
def table_by_type(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", _blanked().alias("priority"))
    return df.select(*[canonical_by_type(df, n, "null").alias(n) for n in df.columns])


_LIST = "concat(', ', p_type, ' ,,', replace(p_name, ' ', ';'), ',', p_type, ', ,')"


def _parts_list() -> Column:
    return F.concat(
        F.lit(", "), "p_type", F.lit(" ,,"), F.translate("p_name", " ", ";"), F.lit(","), "p_type", F.lit(", ,")
    )


# Entries are joined for comparison.
@query(
    f"""SELECT p_partkey, concat('|', array_to_string(list_filter(string_split_regex(trim({_LIST}), '[,;]+'), lambda x: x <> ''), '|')) AS as_array,
               array_to_string(pieces, '|') AS as_list, array_to_string(list_sort(list_distinct(pieces)), '|') AS as_set
        FROM (SELECT *, list_filter(list_transform(string_split_regex({_LIST}, '[,;]+'), lambda x: trim(x)), lambda x: x <> '') AS pieces FROM part)"""
)
def lists_split(spark: SparkSession, sf: str) -> DataFrame:
    c = _parts_list()
    return table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit("|"), F.array_join(text.split_array(c, ",;"), "|")).alias("as_array"),
        F.array_join(text.split_list(c, ",;"), "|").alias("as_list"),
        F.array_join(F.array_sort(text.split_set(c, ",;")), "|").alias("as_set"),
    )


@query(f"SELECT DISTINCT unnest(list_filter(list_transform(string_split_regex({_LIST}, '[,;]+'), lambda x: trim(x)), lambda x: x <> '')) AS token FROM part")
def list_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_tokens(table(spark, sf, "part"), _parts_list(), ",;")


_KEYWORDS = (".net", ".org", "/en")


@query(
    "SELECT page_id, CASE "
    + " ".join(f"WHEN contains(url, '{k}') THEN concat(split_part(url, '{k}', 1), '{k}')" for k in _KEYWORDS)
    + " ELSE '' END AS prefix FROM pages"
)
def url_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    prefix = text.keyword_prefix(F.col("url"), ",".join(_KEYWORDS))
    return table(spark, sf, "pages").select("page_id", prefix.alias("prefix"))


@query(
    """SELECT CASE WHEN contains(text, '. ') THEN concat(split_part(text, '. ', 1), '. ') ELSE '' END AS prefix,
              count(*) AS row_count FROM documents GROUP BY 1"""
)
def rows_by_opening(spark: SparkSession, sf: str) -> DataFrame:
    return rows_per_prefix(table(spark, sf, "documents"), F.col("text"), ". ")


@query(
    """SELECT CASE WHEN contains(p_name, 'ring') THEN concat(split_part(p_name, 'ring', 1), 'ring')
              WHEN contains(p_name, 'widget') THEN concat(split_part(p_name, 'widget', 1), 'widget') ELSE '' END AS prefix,
              count(*) AS row_count FROM part GROUP BY 1"""
)
def rows_by_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return rows_per_prefix(table(spark, sf, "part"), F.col("p_name"), "ring,widget")


@query(
    f"""SELECT o_orderkey FROM (SELECT *, {_BLANKED} AS v FROM orders)
        WHERE v IS NULL OR {_DUCK_BLANK.format("v")} OR o_orderstatus IS NULL OR trim(o_orderstatus) = ''"""
)
def rows_blank(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").withColumn("v", _blanked())
    return rows_with_blank(df, "v, o_orderstatus").select("o_orderkey")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('MACHINERY', 'HOUSEHOLD', 'MACHINERY,HOUSEHOLD')")
def rows_in_list(spark: SparkSession, sf: str) -> DataFrame:
    return rows_listed(table(spark, sf, "customer"), "c_mktsegment", "MACHINERY,HOUSEHOLD").select("c_custkey", "c_mktsegment")


# Decimals are compared as text here, since clients read them as different types.
@query(
    """SELECT event_id, date_trunc('second', ts) AS ts, CAST(CAST(value AS DECIMAL(19, 4)) AS VARCHAR) AS value,
              event_type FROM events"""
)
def sink_types(spark: SparkSession, sf: str) -> DataFrame:
    cast = cast_for_sink(table(spark, sf, "events").select("event_id", "ts", "value", "event_type"))
    return cast.withColumn("value", F.col("value").cast("string"))


@query(
    """SELECT 'text' AS column_name, count(*) FILTER (length(text) > 255) AS misfits, 0::BIGINT AS rounded FROM documents
       UNION ALL SELECT 'lang', count(*) FILTER (length(lang) > 255), 0 FROM documents
       UNION ALL SELECT 'source', count(*) FILTER (length(source) > 255), 0 FROM documents"""
)
def sink_misfits(spark: SparkSession, sf: str) -> DataFrame:
    return sink_report(table(spark, sf, "documents"))


@query(
    """SELECT 'ts' AS column_name, 0::BIGINT AS misfits, count(*) FILTER (ts <> date_trunc('second', ts)) AS rounded FROM events
       UNION ALL SELECT 'value', count(*) FILTER (event_id % 7 = 0),
              count(*) FILTER (event_id % 7 <> 0 AND CAST(CAST(value AS DECIMAL(19, 4)) AS DOUBLE) <> value) FROM events"""
)
def sink_overflows(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh value is beyond the database's largest number; the report counts it."""
    huge = F.when(F.col("event_id") % 7 == 0, F.lit(1e16)).otherwise(F.col("value")).alias("value")
    return sink_report(table(spark, sf, "events").select("ts", huge))


@query(
    """SELECT CAST(l_linenumber AS INTEGER) AS l_linenumber, CAST(l_orderkey AS BIGINT) AS l_orderkey,
              CAST(CAST(l_quantity AS DECIMAL(38, 10)) AS VARCHAR) AS l_quantity, l_tax > 0 AS l_tax,
              CAST(l_discount AS FLOAT) AS l_discount, l_extendedprice FROM lineitem"""
)
def source_types(spark: SparkSession, sf: str) -> DataFrame:
    catalog = {"l_linenumber": (5, 0), "L_ORDERKEY": (19, 0), "l_quantity": (0, 0), "l_tax": (1, 0), "l_discount": (19, 4)}
    columns = ["l_linenumber", "l_orderkey", "l_quantity", "l_tax", "l_discount", "l_extendedprice"]
    cast = cast_from_source(table(spark, sf, "lineitem").select(*columns), catalog)
    return cast.withColumn("l_quantity", F.col("l_quantity").cast("string"))
