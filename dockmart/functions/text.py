"""Text and number column helpers (all built-in Spark expressions).

T-SQL behaviour reproduced here:

* ``CONCAT`` treats NULL as the empty string and accepts any type
  (``concat_text``); Spark's ``concat`` would return NULL.
* ``TRY_CAST(REPLACE(x, '.', '') AS INT)`` reads dots as thousands separators
  (``dotted_int``); the strict form fails on bad text like ``CAST``.
* ``CAST(decimal AS INT)`` truncates toward zero (``trunc_int``).
* Comparisons follow :class:`dockmart.config.TextRules`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockmart.config import TextRules

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_text(*parts: Column | str | int) -> Column:
    """``CONCAT(a, b, ...)``: NULL parts count as '', numbers are printed.

    Columns are given as :class:`Column`; plain Python values are literals.
    """
    cols = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws("", *cols)


def dotted_int(c: ColumnOrName, strict: bool = False) -> Column:
    """``[TRY_]CAST(REPLACE(x, '.', '') AS INT)``.

    ``strict=False`` gives NULL for text that is not a number (TRY_CAST);
    ``strict=True`` fails the query, like a plain CAST under ANSI mode.
    """
    cleaned = F.replace(col(c).cast("string"), F.lit("."), F.lit(""))
    return cleaned.cast("int") if strict else cleaned.try_cast("int")


def trunc_int(c: ColumnOrName) -> Column:
    """``CAST(x AS INT)`` of a decimal or float: truncates toward zero."""
    return col(c).cast("int")


def normalized(c: ColumnOrName, rules: TextRules) -> Column:
    """The column as the comparison rules see it."""
    out = col(c)
    if rules.ignore_trailing_blanks:
        out = F.rtrim(out)
    if rules.case_insensitive:
        out = F.upper(out)
    return out


def _norm_lit(value: str, rules: TextRules) -> str:
    if rules.ignore_trailing_blanks:
        value = value.rstrip(" ")
    if rules.case_insensitive:
        value = value.upper()
    return value


def text_eq(c: ColumnOrName, value: str, rules: TextRules = TextRules()) -> Column:
    return normalized(c, rules) == F.lit(_norm_lit(value, rules))


def text_ne(c: ColumnOrName, value: str, rules: TextRules = TextRules()) -> Column:
    return normalized(c, rules) != F.lit(_norm_lit(value, rules))


def text_in(c: ColumnOrName, values: Iterable[str], rules: TextRules = TextRules()) -> Column:
    return normalized(c, rules).isin([_norm_lit(v, rules) for v in values])


def text_not_in(c: ColumnOrName, values: Iterable[str], rules: TextRules = TextRules()) -> Column:
    """``x NOT IN (...)``: NULL x is not kept (three-valued logic)."""
    return ~text_in(c, values, rules)


def text_startswith(c: ColumnOrName, prefix: str, rules: TextRules = TextRules()) -> Column:
    """``x LIKE 'prefix%'``."""
    if rules.case_insensitive:
        return F.upper(col(c)).startswith(prefix.upper())
    return col(c).startswith(prefix)


def text_contains(c: ColumnOrName, part: str, rules: TextRules = TextRules()) -> Column:
    """``x LIKE '%part%'``."""
    if rules.case_insensitive:
        return F.upper(col(c)).contains(part.upper())
    return col(c).contains(part)


def join_key(c: ColumnOrName, rules: TextRules = TextRules()) -> Column:
    """A text join key compared under ``rules``."""
    return normalized(c, rules)
