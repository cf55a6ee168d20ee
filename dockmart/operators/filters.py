"""Row filters of the reports, with SQL's NULL rules spelt out.

``x <> v`` and ``x NOT IN (...)`` drop NULL x (three-valued logic); the
``*_or_null`` forms keep them, as the ALMS loads report does for columns that
come from the outer side of a join. With exact text rules every predicate is
a plain comparison that Spark pushes to the Parquet reader.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmart.config import TextRules
from dockmart.functions.dates import NTZ
from dockmart.functions.text import ColumnOrName, col, text_in, text_not_in


def in_or_null(c: ColumnOrName, values: Iterable[str], rules: TextRules = TextRules()) -> Column:
    """``(x IN (...) OR x IS NULL)``."""
    return text_in(c, values, rules) | col(c).isNull()


def not_in_or_null(c: ColumnOrName, values: Iterable[str], rules: TextRules = TextRules()) -> Column:
    """``(x NOT IN (...) OR x IS NULL)``."""
    return text_not_in(c, values, rules) | col(c).isNull()


def between_times(c: ColumnOrName, start: datetime, end: datetime) -> Column:
    """``x BETWEEN start AND end`` on a zone-less timestamp (inclusive)."""
    return col(c).between(F.lit(start).cast(NTZ), F.lit(end).cast(NTZ))
