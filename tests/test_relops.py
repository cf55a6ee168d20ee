"""Relational operators: NULL-aware NOT IN, group totals, lists, role joins."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dockmart.operators.aggregates import first_per_key, keys_without, latest_per_key, ordered_lists, with_group_totals
from dockmart.operators.joins import left_join_on, not_in, role_join, trimmed_key_join
from dockmart.config import TextRules
from harness import not_in_sql_form


def _keys(spark, values, name="k"):
    return spark.createDataFrame([(v,) for v in values], f"{name} long")


@pytest.mark.parametrize(
    "excluded,expected",
    [
        ([2], [1, 4]),  # NULL key dropped, listed key dropped
        ([2, None], []),  # a NULL in the list empties the result
        ([], [1, 2, None, 4]),  # empty list keeps everything, NULL key too
        ([7], [1, 2, 4]),
    ],
)
def test_not_in_null_semantics(spark, excluded, expected):
    left = _keys(spark, [1, 2, None, 4])
    right = _keys(spark, excluded, "x")
    got = sorted((r.k for r in not_in(left, "k", right, "x").collect()), key=lambda v: (v is None, v))
    want = sorted(expected, key=lambda v: (v is None, v))
    assert got == want
    sql_form = sorted((r.k for r in not_in_sql_form(left, "k", right, "x").collect()), key=lambda v: (v is None, v))
    assert sql_form == want


def test_keys_without(spark):
    rows = [(1, 1, 1), (1, 1, 0), (2, 1, 0), (2, 0, 1), (3, 0, 1), (None, 1, 0)]
    df = spark.createDataFrame(rows, "k long, member int, hit int")
    got = {r.k for r in keys_without(df, "k", F.col("member") == 1, F.col("hit") == 1).collect()}
    assert got == {2, None}  # 1 has a hit, 3 has no member row


def test_with_group_totals_equals_window(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", None), (None, 3), (None, 4), ("b", 5)], "route string, id long"
    )
    mine = with_group_totals(df, ["route"], n=F.count("id"))
    win = df.withColumn("n", F.count("id").over(Window.partitionBy("route")))
    assert sorted(mine.collect(), key=str) == sorted(win.collect(), key=str)
    assert "Window" not in mine._jdf.queryExecution().executedPlan().toString()


def test_ordered_lists_align_and_skip_nulls(spark):
    rows = [(1, "B", "Bee", None), (1, "A", "Ay", "P1"), (1, "A", "Alt", "P2"), (2, None, None, None)]
    df = spark.createDataFrame(rows, "k long, code string, name string, planner string")
    out = {
        r.k: r
        for r in ordered_lists(df, "k", {"code": "codes", "name": "names", "planner": "planners"},
                               ["code", "name", "planner"]).collect()
    }
    assert out[1].codes == "A, A, B"
    assert out[1].names == "Alt, Ay, Bee"
    assert out[1].planners == "P2, P1"
    assert (out[2].codes, out[2].names, out[2].planners) == (None, None, None)


def test_latest_per_key(spark):
    df = spark.createDataFrame([("t1", 1, "x"), ("t1", 3, "y"), ("t2", 2, "z"), ("t1", 3, "a")],
                               "tag string, id long, v string")
    got = {r.tag: (r.id, r.v) for r in latest_per_key(df, "tag", "id").collect()}
    assert got == {"t1": (3, "y"), "t2": (2, "z")}


def test_first_per_key(spark):
    rows = [("t1", 3, "x"), ("t1", 1, "y"), ("t1", 1, "b"), ("t2", 2, "z"), ("t3", None, "n"), ("t3", 5, "m"), (None, 1, "k")]
    df = spark.createDataFrame(rows, "tag string, id long, v string")
    got = {r.tag: (r.id, r.v) for r in first_per_key(df, "tag", "id").collect()}
    assert got == {"t1": (1, "b"), "t2": (2, "z"), "t3": (None, "n"), None: (1, "k")}


def test_role_join_keeps_row_with_wrong_role(spark):
    loads = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id long, car long")
    partners = spark.createDataFrame([(10, "C10", "Carrier"), (20, "C20", "Client")], "pid long, num string, type string")
    out = {r.id: r.car_num for r in role_join(loads, partners, "car", "pid", "type", "Carrier", {"num": "car_num"})
           .collect()}
    assert out == {1: "C10", 2: None, 3: None}


def test_left_join_with_left_condition_in_on(spark):
    ld = spark.createDataFrame([("t1", 1, "Open"), ("t2", 2, "Adjusted")], "tag string, id long, status string")
    ll = spark.createDataFrame([("t1", 1, 100), ("t2", 2, 200)], "ltag string, lid long, leg long")
    out = left_join_on(ld, ll, [("tag", "ltag"), ("id", "lid")], F.col("status") != "Adjusted")
    assert sorted((r.tag, r.leg) for r in out.collect()) == [("t1", 100), ("t2", None)]


def test_trimmed_key_join(spark):
    stops = spark.createDataFrame([("10",), ("S1",), ("hut",)], "code string")
    locs = spark.createDataFrame([("  10 ", "Plant"), ("S1", "Acme"), ("HUT  ", "Hq")], "lc string, name string")
    exact = {r.code: r.name for r in trimmed_key_join(stops, locs, "code", "lc", {"name": "name"}).collect()}
    assert exact == {"10": "Plant", "S1": "Acme", "hut": None}
    ci = trimmed_key_join(stops, locs, "code", "lc", {"name": "name"}, TextRules.sql_server())
    assert {r.code: r.name for r in ci.collect()}["hut"] == "Hq"
