"""Properties of the column rules over generated times, and hot-key behaviour.

Hypothesis draws a batch of timestamps per example; each batch is evaluated in
one Spark job so the number of jobs stays small.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from dockmart.functions import dates as D
from dockmart.functions import rules as R
from dockmart.operators.aggregates import with_group_totals
from dockmart.operators.joins import not_in

STAMPS = st.datetimes(min_value=datetime(1999, 1, 1), max_value=datetime(2031, 12, 31))
PAIRS = st.lists(st.tuples(STAMPS, st.integers(min_value=-20000, max_value=20000)), min_size=1, max_size=60)


@settings(max_examples=5, deadline=None)
@given(PAIRS)
def test_time_rule_properties(spark, pairs):
    rows = [(t, t + timedelta(minutes=m, seconds=s % 60)) for t, m in pairs for s in (0, 37)]
    df = spark.createDataFrame(rows, "p timestamp_ntz, e timestamp_ntz")
    out = df.select(
        "p",
        "e",
        R.late_hours("p", "e").alias("h"),
        D.week_start("p").alias("w"),
        R.crew("p").alias("crew"),
        R.shift_start("p").alias("shift"),
        D.minute_diff("p", "e").alias("m"),
        D.minute_diff("e", "p").alias("back"),
    ).collect()
    for r in out:
        assert r.h is None or r.h >= 0
        assert r.w.weekday() == 0 and r.w <= r.p < r.w + timedelta(days=7)
        assert (r.crew is None) == (r.shift is None)
        if r.shift is not None:
            assert r.shift <= r.p < r.shift + timedelta(hours=12)
        assert r.m == -r.back
        exact = (r.e.replace(second=0, microsecond=0) - r.p.replace(second=0, microsecond=0))
        assert r.m == int(exact.total_seconds() // 60)


def test_hot_key_group_totals_and_not_in(spark):
    # one route / key holds a third of all rows
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("R"), (F.col("id") % 997).cast("string")))
        .alias("route"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id")).alias("load_id"),
    )
    mine = with_group_totals(df, ["route"], n=F.count("load_id"))
    win = df.withColumn("n", F.count("load_id").over(Window.partitionBy("route")))
    assert mine.exceptAll(win).count() == 0 and win.exceptAll(mine).count() == 0
    hot = mine.where(F.col("route") == "HOT").select("n").distinct().collect()
    assert len(hot) == 1 and hot[0].n == df.where("route = 'HOT' AND load_id IS NOT NULL").count()

    keys = df.select(F.col("load_id").alias("k"))
    excluded = df.where(F.col("route") == "HOT").where(F.col("load_id").isNotNull()).select("load_id")
    kept = not_in(keys, "k", excluded, "load_id")
    expected = keys.where(F.col("k").isNotNull()).exceptAll(excluded.withColumnRenamed("load_id", "k"))
    assert kept.count() == expected.count()
