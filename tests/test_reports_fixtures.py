"""The four reports on hand-made source tables (FIXTURES.md section C).

Each report is compared with the oracle SQL run by DuckDB over the same
fixture tables, and the cases the fixtures were built for are asserted.
"""

from __future__ import annotations

from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from dockmart.config import MartConfig
from dockmart.oracle import reports as O
from dockmart.plans import loads, stops
from dockmart.sources import schemas as SC
from dockmart.sources.tables import Tables3G, TablesALMS
from harness import compare

AS_OF = datetime(2025, 6, 20, 12, 0)
AS_OF_SQL = "TIMESTAMP '2025-06-20 12:00:00'"
T0 = datetime(2025, 6, 16, 0, 0)


def _as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


# --- ALMS fixtures -----------------------------------------------------------------------


def _stop(leg, seq, code, pick, drop, cus="HUT", arr="2025-06-16 07:00:00", dep="2025-06-16 08:00:00",
          est="2025-06-16 09:30:00", aarr=None, adep=None, route="AVS01", version="1", dist="1.234"):
    return ("R" if route is None else route, version, "1", leg, 100 + (leg or 0), f"{leg}-1", seq, "Active",
            code, f"Stop {code}", pick, drop, arr, dep, est, aarr, adep, 30 * seq, dist, cus, T0)


ALMS_STOPS = [
    _stop(1, 1, "S1", 1, 0, adep="2025-06-16 08:20:00"),
    _stop(1, 1, "S1", 1, 0, adep="2025-06-16 08:20:00"),  # exact duplicate
    _stop(1, 2, "10", 0, 1, arr="06/16/2025 16:30", dep="06/16/2025 17:00", adep="2025-06-16 21:05:00"),
    _stop(1, 3, "S1", None, None, arr="garbage", dep="", est=None),
    _stop(2, 1, "S2", 0, 1),  # drops only at foreign locations -> excluded
    _stop(3, 1, "S1", 1, 0, dep="2025-06-21 08:00:00"),  # no drop at all -> kept, Open
    _stop(3, 2, "S3", 0, 0, est="2025-06-16 07:00:00"),
    _stop(4, 1, "10A", 0, 1),  # 10A is not a plant for the delivery check -> excluded
    _stop(5, 1, "S3", 1, 0),
    _stop(5, 2, "S9", 0, 1, cus="DMS"),  # other customer: ignored by the check, filtered out
    _stop(6, 1, "11", 1, 1, cus="FMS", adep="2025-06-16 07:20:00"),
    _stop(7, 1, "S1", None, 0, cus="AVS", arr="20250617 05:00:00"),
    _stop(7, 2, "FMS", None, 1, cus="AVS", arr="2025-06-17 04:30:00", adep="2025-06-16 12:30:00"),
]
ALMS_LOCATIONS = [
    ("  S1 ", "Acme", "Planner A", "Supplier"),
    ("S1", "Acme Corp", None, "Supplier"),  # one code, two names
    ("10", "Plant 10", None, "Plant"),  # other type: not a supplier
    ("S3", "Third", "P3", None),  # untyped: kept
]


def _leg(tag, load_tag, leg_id, load_id, route="AVS01", version="1", life="Active (1)", carrier="CR1", cus="AVS",
         end="06/18/2025 14:00", est="TBD", dist="1.234"):
    return (tag, load_tag, leg_id, load_id, route, version, "1", "TL", "TR1", None, "2025-06-16 06:00:00", end, est,
            life, "Active", carrier, None if carrier is None else f"Carrier {carrier}", dist, 2025, 25, T0, cus)


ALMS_LOADS = [
    ("T1", 1, "Open", "RP1"), ("T2", 2, "Adjusted", "RP1"), ("T3", 3, "Open", "RP1"), ("T4", 4, "Open", None),
    ("T5", 5, "Open", "RP1"), ("T6", 6, "Open", "RP1"), ("T7", 7, "Open", "RP1"),
]
ALMS_LEGS = [
    _leg("T1-1", "T1", 1, 1),
    _leg("T1-1", "T1", 1, 1),  # duplicate leg row
    _leg("T1-2", "T1", 6, 1, route="FMS02", version=None, cus="FMS", dist="abc"),
    _leg("T2-1", "T2", 3, 2),  # Adjusted load
    _leg("T4-1", "T4", 7, 4, route=None, life=None, carrier=None, cus=None, dist=""),
    _leg("T5-1", "T5", 3, 5, cus="DMS"),
    _leg("T6-1", "T6", 3, 6, life="ACA Cancelled (5)"),
    _leg("T7-1", "T7", 2, 7),  # leg 2 has no plant delivery
]


@pytest.fixture(scope="module")
def alms(spark):
    return TablesALMS(
        loads=spark.createDataFrame(ALMS_LOADS, SC.LOAD_ALMS),
        legs=spark.createDataFrame(ALMS_LEGS, SC.LEG_ALMS),
        stops=spark.createDataFrame(ALMS_STOPS, SC.LEG_STOP_ALMS),
        locations=spark.createDataFrame(ALMS_LOCATIONS, SC.LOCATION_ALMS),
    )


def _duck_alms(t: TablesALMS) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name, df in [("load_alms", t.loads), ("leg_alms", t.legs), ("leg_stop_alms", t.stops),
                     ("location_alms", t.locations)]:
        con.register(name, df.toArrow())
    return con


def _sql(text: str) -> str:
    return text.replace("TIMESTAMP '1999-06-30 12:00:00'", AS_OF_SQL)


def test_alms_stops_report_fixture(alms):
    df = stops.stops_alms_report(alms, _as_of())
    assert not compare(df, _duck_alms(alms), _sql(O.stops_alms_sql(standins=False)))
    rows = df.collect()
    legs = {r["Loadleg ID"] for r in rows}
    assert legs == {1, 3, 5, 6, 7}
    assert sum(1 for r in rows if r["Loadleg ID"] == 1 and r["Stop Sequence"] == 1) == 1  # DISTINCT
    assert [r["Stop Sequence"] for r in rows if r["Loadleg ID"] == 5] == [1]
    first = {(r["Loadleg ID"], r["Stop Sequence"]): r for r in rows}
    assert first[(1, 1)]["Supplier(s)"] == "S1, S1"  # code 10 is a plant, not a supplier
    assert first[(1, 1)]["Name(s)"] == "Acme, Acme Corp"
    assert first[(1, 2)]["Crew"] == "A" and first[(1, 3)]["Crew"] is None
    assert first[(1, 3)]["Planned Departure"] is None and first[(1, 3)]["On-Time"] is None
    assert first[(3, 1)]["On-Time"] == "Open"
    assert first[(7, 2)]["Shift Start Time"] == datetime(2025, 6, 16, 18, 0)
    assert first[(6, 1)]["Dunnage/Freight"] == "Dunnage/Freight"
    assert first[(1, 2)]["Distance from Last Stop"] == 1234


def test_alms_loads_report_fixture(alms):
    df = loads.loads_alms_report(alms)
    assert not compare(df, _duck_alms(alms), O.loads_alms_sql(standins=False))
    rows = df.collect()
    assert sorted(r["Loadleg Tag"] for r in rows) == ["T1-1", "T1-2", "T4-1"]
    by_tag = {r["Loadleg Tag"]: r for r in rows}
    assert by_tag["T4-1"]["Load Count Per Route"] == 1  # NULL route is one partition
    assert by_tag["T1-1"]["Load Count Per Carrier"] == 2
    assert by_tag["T1-2"]["Distance"] is None and by_tag["T1-1"]["Distance"] == 1234
    assert by_tag["T1-2"]["Route-Version"] == "FMS02-"


def test_alms_null_leg_in_exclusion_list_empties_report(spark, alms):
    bad = spark.createDataFrame([_stop(None, 1, "S2", 0, 1)], SC.LEG_STOP_ALMS)
    t = TablesALMS(alms.loads, alms.legs, alms.stops.unionByName(bad), alms.locations)
    assert stops.stops_alms_report(t, _as_of()).count() == 0
    assert loads.loads_alms_report(t).count() == 0


# --- 3G fixtures -----------------------------------------------------------------------------


def _load(i, status, client_dest=100, carrier=900):
    return (i, f"L{i}", status, client_dest, 1, carrier, datetime(2025, 6, 16, 6), datetime(2025, 6, 18, 14),
            1234.5, T0)


def _stop3(load, num, loc, typ, arr=datetime(2025, 6, 17, 7, 0), late=datetime(2025, 6, 17, 8, 0),
           exp=datetime(2025, 6, 17, 9, 30), aarr=None, adep=None):
    return (load, num, loc, typ, arr, late, exp, aarr, adep, 30, 12.7, T0)


G3_LOADS = [
    _load(1, "InTransit"), _load(2, "Delivered", 102), _load(3, "Tendered"), _load(4, "Tendered"),
    _load(5, "InTransit"), _load(6, "Canceled"), _load(7, "InTransit"), _load(8, "Delivered", 101, 901),
]
G3_STOPS = [
    _stop3(1, 1, 101, "Pickup", adep=datetime(2025, 6, 17, 8, 10)),
    _stop3(1, 2, 100, "Delivery"),
    _stop3(2, 1, 102, "Delivery"),
    _stop3(3, 1, 101, "Pickup", late=None),
    _stop3(5, 1, 999, "Delivery"),  # unknown location counts as foreign
    _stop3(6, 1, 100, "Delivery"),
    _stop3(7, 1, 100, "Delivery"),
    _stop3(8, 1, 100, "Delivery", arr=datetime(2025, 6, 15, 19, 0)),
    _stop3(8, 2, 103, "Pickup"),
]
G3_LOCS = [(100, "Hutchinson AVS"), (101, "Acme Supply"), (102, "Foreign Co"), (103, "Plant near Hutchinson")]
G3_PARTNERS = [
    (900, "CAR1", "Carrier One", "Carrier"), (901, "CLT9", "Client Nine", "Client"),
    (800, "HUT", "Hutchinson", "Client"), (801, "HUT", "Hutchinson 2", "Client"), (802, "OTH", "Other", "Client"),
]
G3_CLIENTS = [(1, 800), (2, 800), (3, 800), (4, 800), (5, 800), (6, 800), (7, 802), (8, 800), (8, 801)]


@pytest.fixture(scope="module")
def g3(spark):
    return Tables3G(
        load=spark.createDataFrame(G3_LOADS, SC.LOAD_3G),
        stop=spark.createDataFrame(G3_STOPS, SC.STOP_3G),
        loc=spark.createDataFrame(G3_LOCS, SC.LOC_3G),
        partner=spark.createDataFrame(G3_PARTNERS, SC.TRADING_PARTNER_3G),
        mode=spark.createDataFrame([(1, "Truck")], SC.TRANSPORT_MODE_3G),
        load_client=spark.createDataFrame(G3_CLIENTS, SC.LOAD_CLIENT_3G),
        load_order=spark.createDataFrame([(1, 5000), (1, 5001)], SC.LOAD_ORDER_3G),
        order_header=spark.createDataFrame([(5000, 800), (5001, 802)], SC.ORDER_HEADER_3G),
    )


def _duck_3g(t: Tables3G) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name, df in [("load_3g", t.load), ("stop_3g", t.stop), ("loc_3g", t.loc), ("partner_3g", t.partner),
                     ("mode_3g", t.mode), ("load_client_3g", t.load_client), ("load_order_3g", t.load_order),
                     ("order_header_3g", t.order_header)]:
        con.register(name, df.toArrow())
    return con


def test_3g_stops_report_fixture(g3):
    df = stops.stops_3g_report(g3, _as_of())
    assert not compare(df, _duck_3g(g3), _sql(O.stops_3g_sql(standins=False)))
    rows = df.collect()
    assert sorted({r["Loadleg ID"] for r in rows}) == ["L1", "L3", "L4", "L8"]
    l4 = [r for r in rows if r["Loadleg ID"] == "L4"]
    assert len(l4) == 1 and l4[0]["Stop Sequence"] is None and l4[0]["Load ID"] is None
    assert len([r for r in rows if r["Loadleg ID"] == "L8"]) == 4  # two clients double the stops
    l1 = {r["Stop Sequence"]: r for r in rows if r["Loadleg ID"] == "L1"}
    assert l1[1]["Supplier(s)"] == "101" and l1[1]["Name(s)"] == "Acme Supply"
    assert l1[2]["Is HUT Location"] == "Yes" and l1[2]["Dunnage/Freight"] == "Freight"
    assert l1[1]["Distance from Last Stop"] == 12


def test_3g_stops_report_limit(g3):
    cfg = MartConfig(stops_3g_limit=2)
    assert stops.stops_3g_report(g3, _as_of(), cfg).count() == 2


def test_3g_loads_report_fixture(g3):
    df = loads.loads_3g_report(g3)
    assert not compare(df, _duck_3g(g3), O.loads_3g_sql(standins=False))
    rows = {r["Load ID"]: r for r in df.collect()}
    assert sorted(rows) == [1, 3, 4, 7, 8]
    assert rows[1]["Carrier"] == "CAR1 - Carrier One"
    assert rows[8]["Carrier Code"] is None and rows[8]["Carrier"] == " - "  # partner 901 is a client
    assert rows[1]["Activity"] == "AVS" and rows[8]["Activity"] == "OTHER"
    assert "Trailer2" in df.columns


def test_3g_null_load_among_foreign_deliveries_empties_reports(spark, g3):
    bad = spark.createDataFrame([_stop3(None, 1, 102, "Delivery")], SC.STOP_3G)
    t = Tables3G(g3.load, g3.stop.unionByName(bad), g3.loc, g3.partner, g3.mode, g3.load_client,
                 g3.load_order, g3.order_header)
    assert loads.loads_3g_report(t).count() == 0
    assert stops.stops_3g_report(t, _as_of()).count() == 0


def test_3g_letter_case_follows_text_rules(spark, g3):
    from dockmart.config import TextRules

    extra_load = spark.createDataFrame([_load(9, "InTransit")], SC.LOAD_3G)
    extra_stop = spark.createDataFrame([_stop3(9, 1, 104, "Delivery")], SC.STOP_3G)
    extra_loc = spark.createDataFrame([(104, "HUTCHINSON Annex")], SC.LOC_3G)
    extra_client = spark.createDataFrame([(9, 800)], SC.LOAD_CLIENT_3G)
    t = Tables3G(g3.load.unionByName(extra_load), g3.stop.unionByName(extra_stop), g3.loc.unionByName(extra_loc),
                 g3.partner, g3.mode, g3.load_client.unionByName(extra_client), g3.load_order, g3.order_header)
    exact = {r["Load ID"] for r in loads.loads_3g_report(t).collect()}
    assert 9 not in exact  # 'HUTCHINSON' does not contain 'Hutchinson' byte for byte
    ci_cfg = MartConfig(text=TextRules.sql_server())
    ci = {r["Load ID"] for r in loads.loads_3g_report(t, ci_cfg).collect()}
    assert ci == exact | {9}
    rows = [r for r in stops.stops_3g_report(t, _as_of(), ci_cfg).collect() if r["Loadleg ID"] == "L9"]
    assert [r["Is HUT Location"] for r in rows] == ["Yes"]


def test_order_legs_stand_at_their_first_load(spark, g3):
    loads_table = spark.createDataFrame([(1, "L1"), (2, "L2"), (3, "L3")], "LoadId long, LoadNum string")
    legs = [(10, 5000), (11, 5001), (12, 9999), (13, None)]
    travels = [(10, 2, 2), (10, 1, 1), (10, 3, 3), (11, 7, 1), (11, 8, 2), (12, 1, 2), (13, 1, 2), (14, 1, 7), (15, 1, None)]
    partners = [(800, "HUT", "Hq", "Client"), (802, "C802", "Haul", "Carrier")]
    t = Tables3G(
        loads_table, g3.stop, spark.createDataFrame([(7, "Plant")], SC.LOC_3G), spark.createDataFrame(partners, SC.TRADING_PARTNER_3G),
        g3.mode, g3.load_client, g3.load_order,
        order_header=spark.createDataFrame([(5000, 800, 7), (5001, 802, 8)], SC.ORDER_HEADER_DEST_3G),
        order_leg=spark.createDataFrame(legs, SC.ORDER_LEG_3G),
        order_leg_load=spark.createDataFrame(travels, SC.ORDER_LEG_LOAD_3G),
    )
    got = sorted(tuple(r) for r in loads.order_legs_3g(t).fillna(-1).fillna("-").collect())
    assert got == [
        (1, 10, 5000, "HUT", "Plant"),
        (1, 11, 5001, "-", "-"),  # a carrier is no client, its destination is unknown
        (2, 12, -1, "-", "-"),
        (2, 13, -1, "-", "-"),
        (3, -1, -1, "-", "-"),
    ]


def _stops_of_legs(spark, legs):
    """Customer stops: ``legs`` lists (leg, code, drop)."""
    x = spark.createDataFrame(legs, "leg long, code string, is_drop int").withColumn("nr", F.monotonically_increasing_id())
    known = {"Loadleg_ID": F.col("leg"), "Stop_Code": F.col("code"), "Is_Drop": F.col("is_drop"), "cus": F.lit("AVS"), "Stop_Seq": (F.col("nr") % 1000).cast("int")}
    return x.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SC.LEG_STOP_ALMS.fields])


@pytest.mark.parametrize("marks", [1, 8, 1 << 27])
@pytest.mark.parametrize("without_leg", [None, 0, 1])
def test_marks_drop_no_leg_that_stays(spark, monkeypatch, marks, without_leg):
    """F2-F6: foreign legs that share a place with a leg that stays are left to the exact test."""
    from dockmart.plans import common

    monkeypatch.setattr(common, "MARKS", marks)
    legs = [(i, code, drop) for i in range(-20, 40) for code, drop in [("S1", 0), ("10" if i % 3 == 0 else "S2", 1 if i % 5 else 0)]]
    if without_leg is not None:
        legs.append((None, "S9", without_leg))
    rows = [r["Loadleg ID"] for r in stops.alms_stop_rows(_stops_of_legs(spark, legs)).collect()]
    stay = [i for i in range(-20, 40) if i % 3 == 0 or i % 5 == 0 for _ in range(2)]
    assert sorted(x for x in rows if x is not None) == ([] if without_leg == 1 else stay) and None not in rows
    # no foreign leg at all: a stop without a leg stays too
    rows = [r["Loadleg ID"] for r in stops.alms_stop_rows(_stops_of_legs(spark, [(1, "10", 1), (None, "S9", 0)])).collect()]
    assert sorted(rows, key=str) == [1, None]


def test_most_foreign_legs_are_dropped_before_the_rows_are_dealt(spark):
    """F2-F6: no more than the rows that stay, and a few, reach the anti join's exchange."""
    from dockmart.plans import common

    rows = _stops_of_legs(spark, [(i, "10" if i % 10 == 0 else "S2", 1) for i in range(2000)])
    left = common.marked_legs(rows, "Loadleg_ID", common.leg_codes_alms(rows)).count()
    assert 200 <= left < 300


@pytest.mark.parametrize("marks", [1 << 16, 1 << 28])
def test_rows_are_not_dealt_by_leg_for_a_long_list(spark, monkeypatch, marks):
    """F3-F5: a list of foreign legs beyond the broadcast threshold; the rows are dealt by whole rows only, as the few legs that
    the marks leave in doubt (about 80, or none) are broadcast."""
    from dockmart.plans import common

    monkeypatch.setattr(common, "MARKS", marks)
    foreign = spark.range(40_000).selectExpr("id AS leg", "if(id % 10 = 0, '10', 'S2') AS code", "1 AS is_drop")
    rows = _stops_of_legs(spark, foreign.collect())
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {name: spark.conf.get(name, None) for name in names}
    try:
        for name in names:
            spark.conf.set(name, "64k")
        df = stops.alms_stop_rows(rows).select("Loadleg ID")
        qe = df._jdf.queryExecution()
        assert sorted(r["Loadleg ID"] for r in df.collect()) == list(range(0, 40_000, 10))
        final = qe.executedPlan().toString().split("Initial Plan")[0]
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert "SortMergeJoin" not in final and "ShuffledHashJoin" not in final
    anti = [line for line in final.splitlines() if "LeftAnti" in line]
    assert all("BroadcastHashJoin" in line for line in anti) and (anti or marks > 1 << 16)


def test_tables_are_saved_in_buckets_without_an_exchange(spark, tmp_path):
    """each task writes the buckets of the rows it reads; the rows are not dealt by key before."""
    import re
    from pathlib import Path

    from dockmart.sources import tables as T

    rows = _stops_of_legs(spark, [(i // 2, f"S{i}", 0) for i in range(300)]).repartition(3).cache()
    empty = {f: spark.createDataFrame([], s) for f, s in (("loads", SC.LOAD_ALMS), ("legs", SC.LEG_ALMS), ("locations", SC.LOCATION_ALMS))}
    spark.sql(f"CREATE DATABASE saved_test LOCATION 'file://{tmp_path}'")
    try:
        T.save_catalog(TablesALMS(stops=rows, **empty), "saved_test", f"file://{tmp_path}", 4)
        back = T.catalog_alms(spark, "saved_test").stops
        assert sorted(r["Stop_Code"] for r in back.collect()) == sorted(f"S{i}" for i in range(300))
        assert back.groupBy("Loadleg_ID").count().filter("count = 2").count() == 150
        files = [f.name for f in Path(tmp_path).rglob("part-*.parquet") if "LEG_STOP" in str(f)]
    finally:
        spark.sql("DROP DATABASE saved_test CASCADE")
        rows.unpersist()
    names = [re.match(r"part-(\d+)-.*_(\d+)\.", f) for f in files]
    assert len({(m[1], m[2]) for m in names}) == 12
