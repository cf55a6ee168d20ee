"""Data checks the source reports keep as commented-out queries.

Uniqueness of keys, duplicates per key, data-entry success rates and shift
counts. Each returns a small DataFrame computed with grouped aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmart.operators.aggregates import count_when, with_group_totals


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """``COUNT(DISTINCT key)`` against ``COUNT(*)`` in one row."""
    return df.agg(
        F.count_distinct(F.col(key)).alias("distinct_keys"),
        F.count(F.lit(1)).alias("all_rows"),
    )


def rows_per_key(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, most first (``GROUP BY key ORDER BY 2 DESC``)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).orderBy(F.desc("row_count"), F.asc(key))


def _pct(part: Column, whole: Column) -> Column:
    """``100.0 * part / whole`` of two INTs as T-SQL has it: DECIMAL(26,12), further digits cut off; NULL for no whole.

    DECIMAL(4,1) times INT is DECIMAL(15,1); divided by INT (10 digits) the
    scale is max(6, 1 + 10 + 1). The digits come from an integer division.
    """
    scaled = part.cast("decimal(24,0)") * F.lit(10**14).cast("decimal(15,0)")
    digits = F.call_function("div", scaled, F.nullif(whole, F.lit(0)).cast("decimal(24,0)"))
    return (digits.cast("decimal(20,0)") * F.lit("0.000000000001").cast("decimal(13,12)")).cast("decimal(26,12)")


def entry_success(
    stops: DataFrame,
    is_pick: str = "Is Pick",
    is_drop: str = "Is Drop",
    actual_arrival_date: str = "Actual Arrival Date",
    actual_departure_date: str = "Actual Departure Date",
) -> DataFrame:
    """Arrival/departure data-entry rates at pick and drop stops (one row)."""
    pick = F.col(is_pick) == 1
    drop = F.col(is_drop) == 1
    no_arr = F.col(actual_arrival_date).isNull()
    no_dep = F.col(actual_departure_date).isNull()
    sums = stops.agg(
        count_when(pick).alias("total_pick"),
        count_when(pick & no_arr).alias("missing_arr_pick"),
        count_when(pick & no_dep).alias("missing_dep_pick"),
        count_when(drop).alias("total_drop"),
        count_when(drop & no_arr).alias("missing_arr_drop"),
        count_when(drop & no_dep).alias("missing_dep_drop"),
    )
    return sums.select(
        "total_pick",
        "missing_arr_pick",
        _pct(F.col("missing_arr_pick"), F.col("total_pick")).alias("missing_arr_pct_pick"),
        "missing_dep_pick",
        _pct(F.col("missing_dep_pick"), F.col("total_pick")).alias("missing_dep_pct_pick"),
        "total_drop",
        "missing_arr_drop",
        _pct(F.col("missing_arr_drop"), F.col("total_drop")).alias("missing_arr_pct_drop"),
        "missing_dep_drop",
        _pct(F.col("missing_dep_drop"), F.col("total_drop")).alias("missing_dep_pct_drop"),
    )


def tags_per_shift(
    stops: DataFrame, day: str, crew: str, tag: str, route: str | None = None, excluded_prefix: str | None = None
) -> DataFrame:
    """Distinct load tags per day and crew, without the routes that start with ``excluded_prefix``."""
    if route is not None and excluded_prefix is not None:
        stops = stops.where(F.col(route).isNull() | ~F.col(route).startswith(excluded_prefix))
    return stops.groupBy(day, crew).agg(F.count_distinct(F.col(tag)).alias("distinct_tags"))


def inbound_per_shift(
    stops: DataFrame, by: Sequence[str], tag: str, counted: Column, out: str = "inbound_count"
) -> DataFrame:
    """``COUNT(CASE WHEN counted THEN tag END) OVER (PARTITION BY by)`` on every row."""
    return with_group_totals(stops, by, **{out: F.count(F.when(counted, F.col(tag)))})


def any_in_group(df: DataFrame, by: str, hit: Column, out: str) -> DataFrame:
    """``MAX(CASE WHEN hit THEN 1 ELSE 0 END) OVER (PARTITION BY by)`` on every row."""
    return with_group_totals(df, [by], **{out: F.max(F.when(hit, F.lit(1)).otherwise(F.lit(0)))})
