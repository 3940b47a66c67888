"""Identity-number checks and the 15 to 18 character upgrade, as plain expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import is_blank

# Region codes that may start a number.
REGION_CODES = (
    "11", "12", "13", "14", "15",
    "21", "22", "23",
    "31", "32", "33", "34", "35", "36", "37",
    "41", "42", "43", "44", "45", "46",
    "50", "51", "52", "53", "54",
    "61", "62", "63", "64", "65",
    "71", "81", "82", "91",
)
# Weight of each of the first 17 digits.
WEIGHTS = (7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2)
# Check character by weighted sum modulo 11.
CHECK_CHARS = "10X98765432"


# A real day, and 29 February of leap years, as patterns: one match reads the whole number.
_DAY_OF_ANY_YEAR = (
    r"(?:(?:0[13578]|1[02])(?:0[1-9]|[12][0-9]|3[01])"
    r"|(?:0[469]|11)(?:0[1-9]|[12][0-9]|30)"
    r"|02(?:0[1-9]|1[0-9]|2[0-8]))"
)
_MULTIPLE_OF_4 = r"(?:[02468][048]|[13579][26])"
_MULTIPLE_OF_4_NOT_00 = r"(?:0[48]|[2468][048]|[13579][26])"
# the year of a 15 digit number is read as 20yy, which has the same leap years
_DAY_6 = rf"(?:[0-9]{{2}}{_DAY_OF_ANY_YEAR}|{_MULTIPLE_OF_4}0229)"
_DAY_8 = (
    rf"(?!0000)(?:[0-9]{{4}}{_DAY_OF_ANY_YEAR}"
    rf"|(?:[0-9]{{2}}{_MULTIPLE_OF_4_NOT_00}|{_MULTIPLE_OF_4}00)0229)"
)
_REGION = rf"(?:{'|'.join(REGION_CODES)})"
_NUMBER_15 = rf"{_REGION}[0-9]{{4}}{_DAY_6}[0-9]{{3}}"
_NUMBER_18 = rf"{_REGION}[0-9]{{4}}{_DAY_8}[0-9]{{3}}[0-9Xx]"


def _matches(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike(rf"^{pattern}\z"), F.lit(False))


def _digits(number: Column, count: int) -> list[Column]:
    """Digits of a whole number, first to last, by arithmetic: far cheaper than by characters."""
    return [F.call_function("div", number, F.lit(10**place)) % F.lit(10) for place in range(count - 1, -1, -1)]


def _check_char(digits: list[Column]) -> Column:
    total = reduce(add, [digit * F.lit(weight) for digit, weight in zip(digits, WEIGHTS, strict=True)])
    return F.substring(F.lit(CHECK_CHARS), (total % F.lit(11)).cast("int") + F.lit(1), F.lit(1))


def is_valid_15(c: Column) -> Column:
    """15 ASCII digits, a known region code and a real ``yyMMdd`` date."""
    return _matches(c, _NUMBER_15)


def is_valid_18(c: Column) -> Column:
    """17 ASCII digits and a matching check character, region code and ``yyyyMMdd`` date."""
    expected = _check_char(_digits(F.substring(c, 1, 17).try_cast("bigint"), 17))
    return _matches(c, _NUMBER_18) & (F.upper(F.substring(c, 18, 1)) == expected)


def is_valid(c: Column) -> Column:
    """Valid in the 15 or the 18 character form."""
    return is_valid_15(c) | is_valid_18(c)


def to_18(c: Column, otherwise: Column | None = None) -> Column:
    """Upgrade a valid 15 digit number; anything else stays as it is, or becomes ``otherwise``.

    To check the result, put it in a column first: a check reads its input many times.
    """
    # the cast ignores the control characters around the digits
    number = c.try_cast("bigint")
    digits = _digits(number, 15)
    check = _check_char([*digits[:6], F.lit(1), F.lit(9), *digits[6:]])
    area = F.call_function("div", number, F.lit(10**9)).cast("string")
    rest = F.lpad((number % F.lit(10**9)).cast("string"), 9, "0")
    found = _matches(c, rf"[\x00-\x20]*{_NUMBER_15}[\x00-\x20]*")
    return F.when(found, F.concat(area, F.lit("19"), rest, check)).otherwise(c if otherwise is None else otherwise)


def validity_class(c: Column) -> Column:
    """``blank``, ``valid_15``, ``valid_18`` or ``invalid``."""
    return (
        F.when(is_blank(c), F.lit("blank"))
        .when(is_valid_15(c), F.lit("valid_15"))
        .when(is_valid_18(c), F.lit("valid_18"))
        .otherwise(F.lit("invalid"))
    )
