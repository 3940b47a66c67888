"""Incremental windows over a cursor column, and the cursor that follows a batch."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates
from ..names import bind

# A cursor as it is saved, and as it is compared with printed timestamps.
CURSOR_FORMAT = "%Y%m%d%H%M%S"
PRINTED_FORMAT = "%Y-%m-%d %H:%M:%S"
POLICIES = ("carry", "advance")
RULES = ("export", "append")

_SHAPES = (
    r"(\d{4})-(\d{1,2})-(\d{1,2})(?: (\d{1,2}):(\d{1,2}):(\d{1,2}))?",
    r"(\d{4})/(\d{1,2})/(\d{1,2})(?: (\d{1,2}):(\d{1,2}):(\d{1,2}))?",
    r"(\d{4})\.(\d{1,2})\.(\d{1,2})(?: (\d{1,2}):(\d{1,2}):(\d{1,2}))?",
    r"(\d{4})年(\d{1,2})月(\d{1,2})日",
    r"(\d{4})(\d{2})(\d{2})(?:(\d{2})(\d{2})(\d{2}))?",
)


def read_cursor(text: str) -> dt.datetime:
    """The time in a saved cursor: the date layouts, and eight-digit days."""
    for shape in _SHAPES:
        hit = re.fullmatch(shape, text.strip(), re.ASCII)
        if hit:
            return dt.datetime(*[int(g) for g in hit.groups() if g is not None])
    raise ValueError(f"{text!r} is not a cursor time")


@dataclass(frozen=True)
class CursorWindow:
    """Bounds of one batch. ``start`` None means a full load, ``stop`` None an open end."""

    start: str | None = None
    stop: str | None = None
    inclusive: bool = True

    @classmethod
    def of(cls, cursor: str | None, step_days: int | str | None = None, inclusive: bool = True) -> CursorWindow:
        """``[cursor, cursor + step_days)``; a blank cursor loads all, step 0 or blank has no end."""
        if cursor is None or not str(cursor).strip():
            return cls(inclusive=inclusive)
        start = str(cursor).strip()
        step = int(str(step_days).strip() or 0) if step_days is not None else 0
        if not step:
            return cls(start, None, inclusive)
        stop = read_cursor(start) + dt.timedelta(days=step)
        return cls(start, stop.strftime(CURSOR_FORMAT), inclusive)


def saved(text: str) -> str:
    """A cursor as it is saved: 14 digits where it is a time, else the text itself."""
    try:
        return read_cursor(text).strftime(CURSOR_FORMAT)
    except ValueError:
        return text


def _bound(text: str, kind: T.DataType, stored_as_text: bool, round_up: bool = True) -> Column:
    """A bound in the column's own type, so that the comparison reaches the scan.

    The time goes in as text and becomes a wall-clock time: no time zone but the session's
    ever touches it. A day compares by its midnight, so a bound within a day moves to the
    next midnight where rows at it or after it are in (or before it are out).
    """
    if isinstance(kind, T.StringType):
        return F.lit(text if stored_as_text else read_cursor(text).strftime(PRINTED_FORMAT))
    time = read_cursor(text)
    if isinstance(kind, T.DateType) and round_up and time.time() != dt.time():
        time = dt.datetime.combine(time.date() + dt.timedelta(days=1), dt.time())
    return F.lit(time.strftime(PRINTED_FORMAT)).cast("timestamp_ntz").cast(kind)


def _compares_stored(cursor_type: str | None, rule: str) -> bool:
    """Whether a text column is compared with the cursor as it is stored.

    An export prints the cursor unless the type is ``string``; an append prints it only if
    the type is ``timestamp``.
    """
    named = (cursor_type or "").strip().lower()
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}, not {rule!r}")
    return named == "string" if rule == "export" else named != "timestamp"


def day_test(df: DataFrame, day_column: str, window: CursorWindow) -> Column:
    """The bounds of a window in days, over a column that holds the day of the cursor column.

    The column may be a date or timestamp, eight digits as text or number, or ``yyyy-MM-dd`` text. As
    a partition column it lets the scan leave out whole folders. A bound that is no time, and
    another type of column, prune nothing. Rows without a day are kept for the exact test.
    """
    name = bind(df, day_column)
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType

    def bounds(time: dt.datetime) -> list[Column]:
        """The day in each form that the column may have."""
        if isinstance(kind, T.StringType):
            return [F.lit(time.strftime("%Y%m%d")), F.lit(time.strftime("%Y-%m-%d"))]
        if isinstance(kind, T.IntegralType):
            return [F.lit(int(time.strftime("%Y%m%d"))).cast(kind)]
        return [F.lit(time.strftime("%Y-%m-%d")).cast(kind)] if isinstance(kind, T.DatetimeType) else []

    def test(text: str | None, compare: Callable[[Column, Column], Column]) -> Column | None:
        try:
            days = bounds(read_cursor(text)) if text else []
        except ValueError:
            return None
        if not days:
            return None
        if len(days) == 1:
            return compare(c, days[0])
        dashed = F.substring(c, 5, 1) == F.lit("-")
        return (~dashed & compare(c, days[0])) | (dashed & compare(c, days[1]))

    tests = [test(window.start, Column.__ge__), test(window.stop, Column.__le__)]
    held = [t for t in tests if t is not None]
    return c.isNull() | reduce(Column.__and__, held) if held else F.lit(True)


def window_test(
    df: DataFrame,
    cursor_column: str,
    window: CursorWindow,
    cursor_type: str | None = None,
    rule: str = "export",
    day_column: str | None = None,
) -> Column:
    """Whether a row belongs to a batch.

    A string column is compared as text: with the cursor as it is stored, or with a printed
    ``yyyy-MM-dd HH:mm:ss``; :func:`_compares_stored` says which, by ``cursor_type`` and rule.
    """
    if window.start is None:
        return F.lit(True)
    name = bind(df, cursor_column)
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    as_text = _compares_stored(cursor_type, rule)
    low = _bound(window.start, kind, as_text, round_up=window.inclusive)
    test = c >= low if window.inclusive else c > low
    if window.stop is not None:
        test = test & (c < _bound(window.stop, kind, as_text))
    return test & day_test(df, day_column, window) if day_column else test


def in_window(
    df: DataFrame,
    cursor_column: str,
    window: CursorWindow,
    cursor_type: str | None = None,
    rule: str = "export",
    day_column: str | None = None,
) -> DataFrame:
    """Rows of one batch; the bounds are pushed into the scan.

    ``day_column`` names a partition column that holds the day of the cursor column; bounds on it are
    worked out from the window (:func:`day_test`), so that only the folders of its days are read.
    """
    if window.start is None:
        return df
    return df.where(window_test(df, cursor_column, window, cursor_type, rule, day_column))


def cursor_time(df: DataFrame, cursor_column: str) -> Column:
    """A cursor column as a wall-clock time; null where text is no date."""
    name = bind(df, cursor_column)
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp_ntz")
    return dates.parse_cursor(F.substring_index(c.cast("string"), ".", 1))


def next_cursor_column(greatest: Column, start: Column, stop: Column, policy: str, run_time: Column) -> Column:
    """The cursor after a batch, all in 14-digit text.

    ``carry``: the greatest value of the batch, or the old cursor when it is empty.
    ``advance``: the same, but where the batch is empty or did not move the cursor, the
    window end, which is cut at the run time so that rows still to come are not skipped.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    if policy == "carry":
        return F.coalesce(greatest, start)
    end = F.greatest(F.least(stop, F.when(stop.isNotNull(), run_time)), start)
    moved = F.when(start.isNull() | (greatest > start), greatest)
    return F.coalesce(moved, end, start)


def next_cursor(
    greatest: dt.datetime | None, window: CursorWindow, policy: str = "carry", run_time: dt.datetime | None = None
) -> str | None:
    """As :func:`next_cursor_column`, for one batch on the driver.

    ``run_time`` is the session's wall-clock time (:func:`cellferry.session.session_time`), which
    is also what cursors are; a window with an end needs it.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    top = greatest.strftime(CURSOR_FORMAT) if greatest else None
    start = saved(window.start) if window.start else None
    if policy == "carry" or start is None:
        return top or start
    if top and top > start:
        return top
    if window.stop is None:
        return start
    if run_time is None:
        raise ValueError("a window with an end is cut at the run time, which is missing")
    return max(min(window.stop, run_time.strftime(CURSOR_FORMAT)), start)
