"""Date and time column helpers for zone-less (``timestamp_ntz``) values.

Every helper is a built-in Spark expression, so it stays inside whole-stage
codegen. They reproduce T-SQL ``DATETIME`` semantics:

* ``DATEDIFF(MINUTE|DAY, a, b)`` counts unit *boundaries* crossed, not
  elapsed units (16:30:59 -> 16:31:01 is one minute). Built from calendar
  fields, so no time zone can leak in.
* ``DATEPART(WEEKDAY, x)`` is Sunday=1 (``dayofweek``).
* ``CAST(x AS TIME)`` comparisons keep the fraction of a second.
* ``DATEADD(DAY, DATEDIFF(DAY, 0, x), 0)`` is the midnight of x, and
  ``DATEADD(WEEK, DATEDIFF(WEEK, 0, d - 1), 0)`` is the Monday of d's week.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from dockmart.functions.text import ColumnOrName, col

NTZ = TimestampNTZType()


def safe_timestamp(c: ColumnOrName, formats: Sequence[str] = ()) -> Column:
    """``TRY_CAST(x AS DATETIME)``: a ``timestamp_ntz`` or NULL.

    ISO text and timestamps convert directly; other layouts are tried in
    order from ``formats`` (Spark datetime patterns, optional sections
    allowed) on the text without blanks around it. Bad text gives NULL. A
    failed pattern parse is costly, so a layout that begins with digits is only
    tried on text that does; a layout that begins with a name is always tried.
    """
    x = col(c)
    parsed = x.try_cast(NTZ)
    if not formats:
        return parsed
    text = F.trim(x.cast("string"))
    digits = F.substring(text, 1, 1).between("0", "9")
    alternatives = []
    for fmt in formats:
        found = F.try_to_timestamp(text, F.lit(fmt)).cast(NTZ)
        alternatives.append(F.when(digits, found) if _begins_with_digits(fmt) else found)
    return F.coalesce(parsed, *alternatives)


def _begins_with_digits(fmt: str) -> bool:
    """True where all text of a Spark datetime pattern starts with a digit."""
    return re.match(r"(y|u|d|H|h|k|K|m|s|M{1,2}(?!M))", fmt) is not None


def date_of(ts: ColumnOrName) -> Column:
    """``CAST(x AS DATE)``."""
    return F.to_date(col(ts))


def padded(n: Column, width: int = 2) -> Column:
    """A calendar field as zero-padded text (fast: no ``java.util.Formatter``)."""
    return F.lpad(n.cast("string"), width, "0")


def time_text(ts: ColumnOrName) -> Column:
    """``CAST(x AS TIME)`` for display, as ``HH:mm:ss`` text.

    Built from the calendar fields, so the session time zone never applies.
    """
    x = col(ts)
    return F.concat(padded(F.hour(x)), F.lit(":"), padded(F.minute(x)), F.lit(":"), padded(F.second(x)))


def stamp_text(ts: ColumnOrName, date_sep: str = "-", time_sep: str = ":") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` (separators configurable) from the calendar fields."""
    x = col(ts)
    return F.concat(
        padded(F.year(x), 4), F.lit(date_sep), padded(F.month(x)), F.lit(date_sep), padded(F.dayofmonth(x)),
        F.lit(" "), padded(F.hour(x)), F.lit(time_sep), padded(F.minute(x)), F.lit(time_sep), padded(F.second(x)),
    )


def seconds_of_day(ts: ColumnOrName) -> Column:
    """Time of day in seconds, with the fraction (decimal)."""
    x = col(ts)
    return F.hour(x) * 3600 + F.minute(x) * 60 + F.extract(F.lit("SECOND"), x)


def clock_seconds(hhmmss: str) -> Decimal:
    """'HH:mm[:ss]' -> seconds of the day, as the bound of a time range."""
    parts = [int(p) for p in hhmmss.split(":")]
    while len(parts) < 3:
        parts.append(0)
    h, m, s = parts
    return Decimal(h * 3600 + m * 60 + s)


def time_between(ts: ColumnOrName, start: str, end: str) -> Column:
    """``CAST(x AS TIME) BETWEEN 'start' AND 'end'`` (inclusive, exact)."""
    sod = seconds_of_day(ts)
    return sod.between(F.lit(clock_seconds(start)), F.lit(clock_seconds(end)))


def weekday_number(ts: ColumnOrName) -> Column:
    """``DATEPART(WEEKDAY, x)`` with Sunday=1."""
    return F.dayofweek(col(ts))


def weekday_name(ts: ColumnOrName) -> Column:
    """``DATENAME(WEEKDAY, x)``: full English day name."""
    return F.date_format(F.to_date(col(ts)), "EEEE")


def year_of(ts: ColumnOrName) -> Column:
    """``YEAR(x)``."""
    return F.year(col(ts))


def midnight(ts: ColumnOrName, day_offset: int = 0) -> Column:
    """Midnight of x's day (plus ``day_offset`` days) as ``timestamp_ntz``."""
    d = F.to_date(col(ts))
    if day_offset:
        d = F.date_add(d, day_offset)
    return d.cast(NTZ)


def add_hours(ts: Column, hours: int) -> Column:
    """``DATEADD(HOUR, n, x)`` on a zone-less timestamp."""
    return ts + F.make_dt_interval(hours=F.lit(hours))


def add_minutes(ts: ColumnOrName, minutes: ColumnOrName) -> Column:
    """``DATEADD(MINUTE, n, x)``; ``minutes`` may be a column."""
    return F.timestamp_add("MINUTE", col(minutes), col(ts))


def minute_of_day(ts: ColumnOrName) -> Column:
    x = col(ts)
    return F.hour(x) * 60 + F.minute(x)


def minute_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``DATEDIFF(MINUTE, start, end)``: minute boundaries crossed (int)."""
    a, b = col(start), col(end)
    days = F.datediff(F.to_date(b), F.to_date(a))
    return (days * 1440 + minute_of_day(b) - minute_of_day(a)).cast("int")


def day_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``DATEDIFF(DAY, start, end)``: midnights crossed (int)."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start))).cast("int")


def week_start(d: ColumnOrName) -> Column:
    """``DATEADD(WEEK, DATEDIFF(WEEK, 0, CAST(d AS DATETIME) - 1), 0)``.

    T-SQL weeks turn on Sunday and day 0 is Monday 1900-01-01, so the ``- 1``
    moves a Sunday into the week before: the result is the Monday on or
    before d, as a ``timestamp_ntz`` at midnight.
    """
    day = F.to_date(col(d))
    return F.date_sub(day, F.weekday(day)).cast(NTZ)


def now_local() -> Column:
    """``GETDATE()``: the local wall-clock time of the query."""
    return F.localtimestamp()
