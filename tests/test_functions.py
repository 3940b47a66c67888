"""Literal edge cases of the column expressions."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellferry.functions import dates, idnum, text
from cellferry.functions.canonical import TextRules, canonical, canonical_by_type, standardise

JAVA_SPACES = [0x9, 0xA, 0xB, 0xC, 0xD, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x1680, *range(0x2000, 0x2007), 0x2008, 0x2009, 0x200A,
               0x2028, 0x2029, 0x205F, 0x3000]


def test_white_space_list():
    assert sorted(map(ord, text.WHITESPACE)) == JAVA_SPACES
    assert len(text.CONTROL_CHARS) == 33


def test_blank(one):
    blank = [None, "", "   ", "\t\n", "\u3000", "\u2003 \u2028"]
    filled = ["\u00a0", "\x00", "a", " a ", "\u2007"]
    assert one(text.is_blank, blank + filled) == [True] * len(blank) + [False] * len(filled)
    assert one(lambda c: text.blank_to(c, "d"), [None, " ", "x ", "\u00a0"]) == ["d", "d", "x ", "\u00a0"]
    assert one(text.blank_to, [None]) == [""]


def test_control_trim(one):
    values = ["\t x\n", "\u3000x\u3000", "\x00\x1f a b \x01", None, " ", "x"]
    assert one(text.control_trim, values) == ["x", "\u3000x\u3000", "a b", None, "", "x"]


def test_lists(one):
    assert one(text.split_list, [",a,, b ,", None, " ", "a", ",,", "\t a\n,\u3000,b"]) == [["a", "b"], None, None, ["a"], [], ["a", "b"]]
    assert one(text.split_array, [" a, b,, ,c "]) == [["a", " b", " ", "c"]]
    assert one(text.split_set, ["b,a, b ,a"]) == [["b", "a"]]
    assert one(lambda c: text.split_list(c, ";|]"), ["a;b|c];d,e"]) == [["a", "b", "c", "d,e"]]


def test_keyword_prefix(one):
    assert one(lambda c: text.keyword_prefix(c, "Y,X"), ["abXcdYe", "abXc", "q", None, "  ", "Y"]) == ["abXcdY", "abX", "", "", "", "Y"]
    assert one(lambda c: text.keyword_prefix(c, "区"), ["甲区乙区"]) == ["甲区"]


def test_equals_listed(one):
    values = ["a", "b", "a,b", "ab", "", None, " ", "A"]
    assert one(lambda c: text.equals_listed(c, "a,b"), values) == [True, True, True, False, False, False, False, False]


def test_any_blank_needs_columns():
    with pytest.raises(ValueError):
        text.any_blank([])


def test_numbers(one):
    values = ["12", "-3", "+4", "12.5", "0x1F", "1e3", "abc", "", None, "9223372036854775807", "9223372036854775808"]
    assert one(text.as_long_or_zero, values) == [12, -3, 4, 0, 0, 0, 0, 0, 0, 9223372036854775807, 0]


PARSED = {
    "2020-3-4 1:2:3": dt.datetime(2020, 3, 4, 1, 2, 3),
    "2020-03-23": dt.datetime(2020, 3, 23),
    "2020/03/23": dt.datetime(2020, 3, 23),
    "2020/3/23 23:59:59": dt.datetime(2020, 3, 23, 23, 59, 59),
    "2020年03月23日": dt.datetime(2020, 3, 23),
    "2020.03.23": dt.datetime(2020, 3, 23),
    "2020.03.23 01:02:03": dt.datetime(2020, 3, 23, 1, 2, 3),
    "20200323101112": dt.datetime(2020, 3, 23, 10, 11, 12),
    "2020-02-29": dt.datetime(2020, 2, 29),
    "2019-02-29": None,
    "20200323": None,
    "2020-13-45": None,
    "2020-03-23 10:11": None,
    "2020-03-23 24:00:00": None,
    "2020-03-23T10:11:12": None,
    "2020-03/23": None,
    "20-03-04": None,
    "2020-03-04\n": None,
    "2020-03-23 10:11:12+01:00": None,
    "x": None,
    "": None,
}


def test_parse_date(one):
    assert dict(zip(PARSED, one(dates.parse_date, list(PARSED)))) == PARSED
    assert one(lambda c: dates.parse_date(c, ["dd.MM.yyyy", "yyyyMMdd"]), ["23.03.2020", "20200324", "x"]) == [
        dt.datetime(2020, 3, 23), dt.datetime(2020, 3, 24), None]
    assert one(dates.parse_cursor, ["20200323", "20200332", "2020/3/1"]) == [dt.datetime(2020, 3, 23), None, dt.datetime(2020, 3, 1)]


def test_date_clean_up(one):
    values = ["2020-3-4 1:2:3", "2020/03/23", "2020年03月23日", "2020-03-23 10:11:12.123", "20200323", "2020-13-45", "2020.03.23", None]
    expected = ["20200304010203", "20200323000000", "20200323000000", "20200323101112", "20200323", "2020-13-45", "2020.03.23", None]
    assert one(dates.normalise_date, values) == expected
    assert one(dates.strip_date, ["2020-03-23 10:11:12.123", "2020/3/1", None]) == ["20200323101112", "202031", None]


def test_clean_up_in_a_zone_with_clock_changes(spark, one):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist on that day in that zone
        assert one(dates.normalise_date, ["2020-03-08 02:30:00"]) == ["20200308023000"]
        ntz = spark.sql("select timestamp_ntz'2020-03-08 02:30:00' as c")
        assert ntz.select(dates.digits14(F.col("c"))).first()[0] == "20200308023000"
        assert ntz.select(dates.digits14(dates.add_days(F.col("c"), 1))).first()[0] == "20200309023000"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_now(spark):
    row = spark.range(1).select(dates.now().alias("n"), dates.now("day").alias("d"), dates.now("month").alias("m")).first()
    assert row.d == row.n.replace(hour=0, minute=0, second=0, microsecond=0) and row.m == row.d.replace(day=1)


def test_id_upgrade(one):
    values = ["910101500101000", " 910101500101000\t", "91010150010100", "990101500101000", "910101501301000", None, "", "abc"]
    assert one(idnum.to_18, values) == ["910101195001010008", "910101195001010008", *values[2:]]


def test_id_15(one):
    def number(day):
        return f"910101{day}123"

    checks = {"000229": True, "010229": False, "850132": False, "851301": False, "850001": False, "851231": True, "850431": False}
    assert one(idnum.is_valid_15, [number(d) for d in checks]) == list(checks.values())
    assert one(idnum.is_valid_15, [None, "", "９10101851231123", "9101018512311234", "161231851231123"]) == [False] * 5


def _check_char(digits):
    # Weights and check characters of the public standard.
    weights = [7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2]
    return "10X98765432"[sum(int(d) * w for d, w in zip(digits, weights)) % 11]


def test_id_18(one):
    body = "91010119500101001"
    xs = next(f"91010119500101{n:03d}" for n in range(1000) if _check_char(f"91010119500101{n:03d}") == "X")
    good = [body + _check_char(body), xs + "X", xs + "x"]
    wrong = str((int(_check_char(body).replace("X", "0")) + 1) % 10)
    bad = [body + wrong, "91010119500230123" + _check_char("91010119500230123"), "00" + body[2:] + "1", None, body]
    zero_year = "91010100000101123"
    bad.append(zero_year + _check_char(zero_year))
    assert one(idnum.is_valid_18, good + bad) == [True] * 3 + [False] * len(bad)
    assert one(idnum.is_valid, [good[0], "910101500101000", "91010150010100", None]) == [True, True, False, False]
    classes = one(idnum.validity_class, [good[1], "910101500101000", "x", " ", None])
    assert classes == ["valid_18", "valid_15", "invalid", "blank", "blank"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(idnum.REGION_CODES), st.integers(0, 9999), st.dates(dt.date(1900, 1, 1), dt.date(1999, 12, 31)), st.integers(0, 999)),
        min_size=1,
        max_size=40,
    )
)
def test_upgraded_ids_are_valid(spark, parts):
    # a leap day of 1900 or a like year cannot come up, as these are real days of those years
    numbers = [f"{r}{a:04d}{d:%y%m%d}{n:03d}" for r, a, d, n in parts]
    upgraded = spark.createDataFrame([(n,) for n in numbers], "n string").select(idnum.to_18(F.col("n")).alias("n18"))
    upgraded = spark.createDataFrame(upgraded.collect(), "n18 string")
    assert all(r[0] for r in upgraded.select(idnum.is_valid_18(F.col("n18"))).collect())


def test_canonical_by_schema(spark):
    df = spark.sql(
        """select timestamp_ntz'2020-03-23 10:11:12.9' as a, timestamp'2020-03-23 10:11:12' as b, date'2020-03-23' as c,
           '\\t2020/3/1 ' as djSJ, ' 910101500101000 ' as sfzh, 1.0E7D as d, 12.5D as e, true as f, cast(null as int) as g,
           '\\u3000' as h, '910101500101000' as other, 20200323101112L as czrq"""
    )
    texts = standardise(df, TextRules(id_columns=["SFZH"])).first().asDict()
    assert texts == {
        "a": "20200323101112", "b": "20200323101112", "c": "20200323", "djSJ": "20200301000000", "sfzh": "910101195001010008",
        "d": "1.0E7", "e": "12.5", "f": "true", "g": "", "h": "", "other": "910101500101000", "czrq": "20200323101112",
    }
    stripped = df.select(canonical(df, "DJsj", "", TextRules(date_mode="strip")), canonical(df, "d", rules=TextRules(decimal_scale=2)))
    assert tuple(stripped.first()) == ("202031", "10000000.00")
    explicit = df.select(canonical(df, "djSJ", "", TextRules(date_columns=["x"])))
    assert explicit.first()[0] == "2020/3/1"
    assert df.select(canonical(df, "g", "null")).first()[0] == "null"
    assert tuple(df.select(canonical_by_type(df, "sfzh"), canonical_by_type(df, "a"), canonical_by_type(df, "h", "-")).first()) == (
        " 910101500101000 ", "20200323101112", "-")


def test_canonical_text_that_trims_to_nothing(spark):
    df = spark.createDataFrame([("\x00 ",), ("\x00\u3000",), (".5",)], "xrq string").coalesce(1)
    assert [r[0] for r in df.select(canonical(df, "xrq", "null", TextRules(date_mode="strip"))).collect()] == ["null"] * 3


def test_padded_date_text(spark):
    values = ["\t2020-03-23 10:11:12\n", "2020-13-23 10:11:12.5\n", " 20200323101112", "\x00", "\x00\u3000", "2020-03-23 10:11:12.5", None, " x\r"]
    df = spark.createDataFrame([(v,) for v in values], "xrq string").coalesce(1)
    expected = ["20200323101112", "2020-13-23 10:11:12.5", "20200323101112", "d", "d", "20200323101112", "d", "x"]
    assert [r[0] for r in df.select(canonical(df, "xrq", "d")).collect()] == expected


def test_nested_values_are_refused(spark):
    with pytest.raises(TypeError):
        canonical(spark.sql("select array(1) as a"), "a")
    with pytest.raises(ValueError):
        TextRules(date_mode="other")
