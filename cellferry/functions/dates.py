"""Date text in many layouts, read and printed without a session time zone.

Results are ``timestamp_ntz``: a wall-clock time is read, moved and printed as it
stands. A shape test picks the layout, then one cast reads the value, so a text is
parsed once, not once per layout, and bad text costs no exception.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import is_blank

# The accepted layouts, in the order in which they are tried.
DATE_LAYOUTS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy年MM月dd日",
    "yyyy.MM.dd",
    "yyyy.MM.dd HH:mm:ss",
    "yyyyMMddHHmmss",
)
# Names ending like this (any case) hold dates as text.
DATE_NAME_SUFFIXES = ("sj", "rq")
# Characters dropped by the stripping date clean-up.
STRIPPED_CHARS = "/- :"

_CLOCK = r"(?: \d{1,2}:\d{1,2}:\d{1,2})?"
_SEPARATED = {mark: rf"^\d{{4}}[{mark}]\d{{1,2}}[{mark}]\d{{1,2}}{_CLOCK}\z" for mark in "-/."}
_IDEOGRAPHIC = r"^\d{4}年\d{1,2}月\d{1,2}日\z"
_DIGITS_14 = r"^\d{14}\z"
_DASHED_IN_FULL = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\z"
_DIGITS_8 = r"^\d{8}\z"


def _wall_time(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def _from_digits(c: Column) -> Column:
    day = F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    time = F.concat_ws(":", F.substring(c, 9, 2), F.substring(c, 11, 2), F.substring(c, 13, 2))
    return _wall_time(F.concat_ws(" ", day, time))


def parse_date(c: Column, layouts: Sequence[str] | None = None) -> Column:
    """Text to a wall-clock time; null where no layout fits or the date does not exist.

    With ``layouts`` the caller's patterns are tried in order instead.
    """
    if layouts:
        tried = [F.try_to_timestamp(c, F.lit(p)).cast("timestamp_ntz") for p in layouts]
        return F.coalesce(*tried)
    # the character after the year tells the layouts apart, so one pattern is matched per text
    mark = F.substring(c, 5, 1)
    return (
        F.when(mark == "-", F.when(c.rlike(_SEPARATED["-"]), _wall_time(c)))
        .when(mark == "/", F.when(c.rlike(_SEPARATED["/"]), _wall_time(F.replace(c, F.lit("/"), F.lit("-")))))
        .when(mark == ".", F.when(c.rlike(_SEPARATED["."]), _wall_time(F.replace(c, F.lit("."), F.lit("-")))))
        .when(mark == "年", F.when(c.rlike(_IDEOGRAPHIC), _wall_time(F.translate(c, "年月日", "--"))))
        .when(c.rlike(_DIGITS_14), _from_digits(c))
    )


def parse_cursor(c: Column) -> Column:
    """As :func:`parse_date`, and eight-digit days as well (a saved date cursor)."""
    day = F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    return F.coalesce(parse_date(c), F.when(c.rlike(_DIGITS_8), _wall_time(day)))


def _padded(number: Column, width: int) -> Column:
    text = number.cast("string")
    return F.when(number >= 10 ** (width - 1), text).otherwise(F.lpad(text, width, "0"))


def _day_number(c: Column) -> Column:
    day = c.cast("date")
    return ((F.year(day) * 100 + F.month(day)) * 100 + F.day(day)).cast("bigint")


def digits14(c: Column) -> Column:
    """A timestamp column as ``yyyyMMddHHmmss``; parts of a second are cut.

    The digits are put together as one number, which costs less than a formatter and, for
    wall-clock times, involves no time zone.
    """
    return _padded(((_day_number(c) * 100 + F.hour(c)) * 100 + F.minute(c)) * 100 + F.second(c), 14)


def digits8(c: Column) -> Column:
    """A date or timestamp column as ``yyyyMMdd``."""
    return _padded(_day_number(c), 8)


def format_date(c: Column, pattern: str) -> Column:
    """A date or timestamp column in any layout."""
    return F.date_format(c, pattern)


def strip_date(c: Column) -> Column:
    """Date clean-up by characters: drop separators, cut at the first full stop."""
    return F.substring_index(F.translate(c, STRIPPED_CHARS, ""), ".", 1)


def normalise_date(c: Column, trimmed: Column | None = None, blank: str | None = None) -> Column:
    """Date clean-up by parsing: cut at the first full stop, print 14 digits.

    Text that is no date stays as it is. So do 14 digits, whether they are a date or not,
    and a full dashed time only has to be checked: its own digits are the result. Other
    text takes the longer way, over ``trimmed`` where that is given, so that the common
    forms need no trim; with ``blank``, blank text becomes that.
    """
    rest = c if trimmed is None else trimmed
    cut = F.substring_index(c, ".", 1)
    own_digits = F.concat(*[F.substring(c, at, size) for at, size in ((1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2))])
    checked = F.when(_wall_time(cut).isNotNull(), own_digits).otherwise(rest)
    # a parsed value is a long expression, so it is used once here
    parsed = parse_date(F.substring_index(rest, ".", 1)).cast("string")
    printed = F.translate(F.substring(parsed, 1, 19), "- :", "")
    cases = F.when((F.length(c) == 14) & c.rlike(_DIGITS_14), c).when(
        (F.length(cut) == 19) & cut.rlike(_DASHED_IN_FULL), checked
    )
    if blank is not None:
        cases = cases.when(is_blank(rest), F.lit(blank))
    return cases.otherwise(F.coalesce(printed, rest))


def add_days(c: Column, days: int | Column) -> Column:
    """Move a timestamp by whole calendar days."""
    count = days if isinstance(days, Column) else F.lit(days)
    return F.timestamp_add("DAY", count, c)


def now(field: str | None = None) -> Column:
    """The current time, or the current time cut to a field such as ``day`` or ``month``."""
    return F.date_trunc(field, F.current_timestamp()) if field else F.current_timestamp()
