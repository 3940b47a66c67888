"""Blank, trim, list and keyword expressions over string columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters removed by a control trim, U+0000 to U+0020.
CONTROL_CHARS = "".join(chr(code) for code in range(0x21))

# The characters that count as white space in a blank test.
# U+00A0, U+2007 and U+202F are not among them.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2008\u2009\u200a"
    "\u2028\u2029\u205f\u3000"
)


def is_blank(c: Column) -> Column:
    """True for null, empty and all-white-space text; never null.

    A left trim stops at the first character that stays, so this is cheap on long texts.
    """
    return F.coalesce(F.ltrim(c, F.lit(WHITESPACE)) == F.lit(""), F.lit(True))


def blank_to(c: Column, default: Column | str | None = "") -> Column:
    """The text itself, or ``default`` where it is blank."""
    other = default if isinstance(default, Column) else F.lit(default)
    return F.when(is_blank(c), other).otherwise(c)


def control_trim(c: Column) -> Column:
    """Remove every character up to U+0020 from both ends (``trim`` removes U+0020 only)."""
    return F.btrim(c, F.lit(CONTROL_CHARS))


def clean_text(c: Column, default: Column | str | None = "") -> Column:
    """Control trim, then ``default`` where nothing but white space is left.

    Most texts start and end with a character that settles both questions: one above
    U+0020 at the end, and at the start one that is printable ASCII or above U+3000, the
    last white-space character. Strings compare by code point, so a comparison tells.
    """
    starts_well = ((c >= F.lit("!")) & (c < F.lit("\x7f"))) | (c >= F.lit("\u3001"))
    ends_well = F.right(c, F.lit(1)) >= F.lit("!")
    return F.when(starts_well & ends_well, c).otherwise(blank_to(control_trim(c), default))


def _char_class(separators: str) -> str:
    return "[" + "".join("\\" + s if s in r"\]^-[&" else s for s in separators) + "]+"


def _pieces(c: Column, separators: str) -> Column:
    return F.filter(F.split(c, _char_class(separators)), lambda piece: piece != F.lit(""))


def split_array(c: Column, separators: str = ",") -> Column:
    """Split on any run of separator characters; the whole text is trimmed, entries are not.

    Blank text gives null.
    """
    return F.when(~is_blank(c), _pieces(control_trim(c), separators))


def split_list(c: Column, separators: str = ",") -> Column:
    """As :func:`split_array`, with each entry trimmed and blank entries dropped."""
    trimmed = F.transform(_pieces(c, separators), control_trim)
    return F.when(~is_blank(c), F.filter(trimmed, lambda piece: ~is_blank(piece)))


def split_set(c: Column, separators: str = ",") -> Column:
    """As :func:`split_list`, each entry once, first occurrence kept."""
    return F.array_distinct(split_list(c, separators))


def keyword_prefix(c: Column, keywords: str) -> Column:
    """Text up to and including the first keyword that occurs, tried in list order.

    ``keywords`` is a comma list. Where none occurs the result is the empty string.
    """
    found = []
    for word in [w for w in keywords.split(",") if w]:
        prefix = F.concat(F.substring_index(c, word, 1), F.lit(word))
        found.append(F.when(F.contains(c, F.lit(word)) & ~is_blank(prefix), prefix))
    return F.when(is_blank(c), F.lit("")).otherwise(F.coalesce(*found, F.lit("")))


def equals_listed(c: Column, entries: str) -> Column:
    """True where the value equals one entry of a comma list, or the list text itself."""
    choices = list(dict.fromkeys([*entries.split(","), entries]))
    return ~is_blank(c) & F.coalesce(c.isin(choices), F.lit(False))


def any_blank(columns: Sequence[Column]) -> Column:
    """True where at least one of the columns is blank."""
    if not columns:
        raise ValueError("any_blank needs at least one column")
    return reduce(lambda left, right: left | right, [is_blank(c) for c in columns])


def as_long_or_zero(c: Column) -> Column:
    """Text as a whole number; 0 where it is not one (blank, decimal, hex, words)."""
    return F.coalesce(c.try_cast("bigint"), F.lit(0).cast("bigint"))


def ends_with_any_case(name: str, suffixes: Sequence[str]) -> bool:
    """Plan-time test on a column name."""
    return any(name.lower().endswith(s.lower()) for s in suffixes)
