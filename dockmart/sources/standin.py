"""Source tables derived from the driver's TPC-H style test tables.

The test data has no freight tables, so each source table is derived from
one test table by a projection (no joins, no row filters): every row of the
test table becomes one source row, so the work of a report grows with the
test data. Roles:

* orders   -> loads (3G ``Load``; ALMS loads and their single leg)
* lineitem -> stops (``l_linenumber`` is the stop sequence, ``l_suppkey`` the
  location, ``l_returnflag`` the stop type: A delivery, R pickup, N other;
  ``l_linestatus`` O means not yet departed)
* supplier -> locations, customer -> trading partners, region -> modes,
  events -> planned/actual times for the column-rule queries.

Times are built from ``l_shipdate`` and the other numeric columns so that
every crew window, on-time band and minute boundary occurs. The same
derivations, written in SQL, are in :mod:`dockmart.sources.standin_sql`.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockmart.functions.dates import NTZ, padded, stamp_text
from dockmart.sources.tables import Tables3G, TablesALMS

# Reference "now" of the reports on the test tables (GETDATE()).
AS_OF_STOPS = datetime(1999, 6, 30, 12, 0, 0)
AS_OF_EVENTS = datetime(2024, 1, 20, 12, 0, 0)


def as_of_stops() -> Column:
    return F.lit(AS_OF_STOPS).cast(NTZ)


def as_of_events() -> Column:
    return F.lit(AS_OF_EVENTS).cast(NTZ)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, as its files are split."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _secs(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def _mins(ts: Column, minutes: Column | int) -> Column:
    return F.timestamp_add("MINUTE", minutes if isinstance(minutes, Column) else F.lit(minutes), ts)


def iso_text(ts: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' from the calendar fields (zone-free); NULL stays NULL."""
    return stamp_text(ts)


def us_text(ts: Column) -> Column:
    """'MM/dd/yyyy HH:mm:ss'; NULL stays NULL."""
    return F.concat(
        padded(F.month(ts)), F.lit("/"), padded(F.dayofmonth(ts)), F.lit("/"), padded(F.year(ts), 4),
        F.lit(" "), padded(F.hour(ts)), F.lit(":"), padded(F.minute(ts)), F.lit(":"), padded(F.second(ts)),
    )


def dotted(amount: Column) -> Column:
    """A money amount as text with a dot before the last three digits."""
    whole = F.floor(amount).cast("bigint")
    return F.concat(
        F.floor(amount / 1000).cast("bigint").cast("string"),
        F.lit("."),
        F.lpad((whole % 1000).cast("string"), 3, "0"),
    )


def _code(key: Column) -> Column:
    """Stop/location code of a supplier key: five plant codes, else S<key>."""
    m = key % 25
    return (
        F.when(m == 0, "10").when(m == 1, "10A").when(m == 2, "11").when(m == 3, "FMS").when(m == 4, "AVS")
        .otherwise(F.concat(F.lit("S"), key.cast("string")))
    )


def _location_code(key: Column) -> Column:
    """Location code of a supplier key: keys 1-5 are the plants, 6 repeats the first, else S<key>.

    Stops name a plant by one key in five, at any size; a plant has one or two locations, so the join of
    stops to locations grows with the stops alone.
    """
    return (
        F.when(key.isin(1, 6), "10").when(key == 2, "10A").when(key == 3, "11").when(key == 4, "FMS").when(key == 5, "AVS")
        .otherwise(F.concat(F.lit("S"), key.cast("string")))
    )


# --- stop times from lineitem ----------------------------------------------------


def stop_times(li: DataFrame) -> DataFrame:
    """lineitem plus planned/estimated/actual times (``_arr`` ... ``_acta``)."""
    arr = _secs(F.col("l_shipdate"), ((F.col("l_partkey") * 7) % 1440) * 60 + F.col("l_suppkey") % 60)
    dep = _mins(arr, 45)
    est = _mins(dep, F.floor(F.col("l_extendedprice")) % 400 - 100)
    actd = F.when(
        F.col("l_linestatus") != "O",
        _secs(dep, (F.floor(F.col("l_extendedprice") / 7) % 360 - 60) * 60 + F.col("l_partkey") % 60),
    )
    return li.withColumns({"_arr": arr, "_dep": dep, "_est": est, "_actd": actd}).withColumn(
        "_acta", _mins(F.col("_actd"), -30)
    )


# --- 3G --------------------------------------------------------------------------


def load_3g(orders: DataFrame) -> DataFrame:
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    status = (
        F.when((pr == "5-LOW") & (st == "P"), "Canceled")
        .when((pr == "4-NOT SPECIFIED") & (st == "P"), "TenderExpired")
        .when(st == "F", "Delivered")
        .when(st == "O", "InTransit")
        .otherwise("Tendered")
    )
    od = F.col("o_orderdate")
    return orders.select(
        F.col("o_orderkey").alias("LoadId"),
        F.concat(F.lit("L"), F.col("o_orderkey").cast("string")).alias("LoadNum"),
        status.alias("DataValue_LoadTmsStatus"),
        (F.col("o_custkey") % 50).alias("LocIdDest"),
        (F.substring(pr, 1, 1).cast("bigint") - 1).alias("TransportModeId"),
        F.col("o_custkey").alias("TradingPartnerIdCarrier"),
        _mins(od, 6 * 60).alias("DateTime_PlannedStart"),
        _mins(od, 2 * 1440 + 14 * 60).alias("DateTime_PlannedEnd"),
        F.col("o_totalprice").alias("Dist_Tot"),
        _mins(od, 3 * 1440).alias("DateLastModified"),
    )


def stop_3g(lineitem: DataFrame) -> DataFrame:
    t = stop_times(lineitem)
    rf = F.col("l_returnflag")
    return t.select(
        F.col("l_orderkey").alias("LoadId"),
        F.col("l_linenumber").alias("StopNum"),
        F.col("l_suppkey").alias("LocId"),
        F.when(rf == "A", "Delivery").when(rf == "R", "Pickup").otherwise("Transfer").alias("DataValue_StopType"),
        F.col("_arr").alias("DateTime_PlannedArrival"),
        F.col("_dep").alias("DateTime_LateArrival"),
        F.when(F.col("l_tax") != 0, F.col("_est")).alias("DateTime_ExpectedDeparture"),
        F.col("_acta").alias("DateTime_ActualArrival"),
        F.col("_actd").alias("DateTime_ActualDeparture"),
        (F.col("l_linenumber") * 30).alias("DurationTransitTimeFromPrevStop"),
        (F.col("l_extendedprice") / 100).alias("Dist_FromPrevStop"),
        _mins(F.col("l_shipdate"), 1440).alias("DateLastModified"),
    )


def loc_3g(supplier: DataFrame) -> DataFrame:
    n = F.col("s_nationkey")
    name = (
        F.when(n == 0, "Hutchinson AVS")
        .when(n == 1, "Hutchinson Cadillac")
        .when(n == 2, "Hutchinson FMS Wh")
        .when(n == 3, "Hutchinson FMS")
        .when(n == 4, "HUTCHINSON Annex")
        .when(n == 5, F.concat(F.col("s_name"), F.lit(" at Hutchinson")))
        .when(n == 6, F.lit(None).cast("string"))
        .otherwise(F.col("s_name"))
    )
    return supplier.select(F.col("s_suppkey").alias("LocId"), name.alias("AddrName"))


def partner_3g(customer: DataFrame) -> DataFrame:
    seg = F.col("c_mktsegment")
    return customer.select(
        F.col("c_custkey").alias("TradingPartnerId"),
        F.when(seg == "AUTOMOBILE", "HUT")
        .otherwise(F.concat(F.lit("C"), F.col("c_custkey").cast("string")))
        .alias("TradingPartnerNum"),
        F.col("c_name").alias("TradingPartnerName"),
        F.when(seg.isin("MACHINERY", "FURNITURE"), "Carrier").otherwise("Client").alias("DataValue_TradingPartnerType"),
    )


def mode_3g(region: DataFrame) -> DataFrame:
    return region.select(
        F.col("r_regionkey").cast("bigint").alias("TransportModeId"), F.col("r_name").alias("TransportModeName")
    )


def load_client_3g(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_orderkey").alias("LoadId"), F.col("o_custkey").alias("TradingPartnerIdClient"))


def load_order_3g(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.col("l_orderkey").alias("LoadId"), F.col("l_partkey").alias("OrdHeaderId"))


def order_header_3g(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("OrdHeaderId"),
        (F.col("p_size") * 10).cast("bigint").alias("TradingPartnerIdClient"),
        F.col("p_size").cast("bigint").alias("LocIdDest"),
    )


def _order_leg_id() -> Column:
    return (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("OrdLegId")


def order_leg_3g(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(_order_leg_id(), F.col("l_partkey").alias("OrdHeaderId"))


def order_leg_load_3g(lineitem: DataFrame) -> DataFrame:
    """One to three load legs an order leg; the one with the smallest number need not be of the order's own load."""
    step = F.explode(F.sequence(F.lit(0), (F.col("l_linenumber") % 3).cast("int"))).alias("__k")
    return lineitem.select(_order_leg_id(), "l_orderkey", step).select(
        "OrdLegId", (F.lit(10) - F.col("__k")).cast("int").alias("LegSeq"), (F.col("l_orderkey") + F.col("__k")).alias("LoadId")
    )


def tables_3g(spark: SparkSession, sf_dir: str) -> Tables3G:
    r = lambda n: read(spark, sf_dir, n)
    orders, lineitem = r("orders"), r("lineitem")
    return Tables3G(
        load=load_3g(orders),
        stop=stop_3g(lineitem),
        loc=loc_3g(r("supplier")),
        partner=partner_3g(r("customer")),
        mode=mode_3g(r("region")),
        load_client=load_client_3g(orders),
        load_order=load_order_3g(lineitem),
        order_header=order_header_3g(r("part")),
        order_leg=order_leg_3g(lineitem),
        order_leg_load=order_leg_load_3g(lineitem),
    )


# --- ALMS ------------------------------------------------------------------------


def load_alms(orders: DataFrame) -> DataFrame:
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    status = (
        F.when((pr == "5-LOW") & (st == "P"), "Adjusted")
        .when(st == "F", "Closed")
        .when(st == "O", "Open")
        .otherwise("Planned")
    )
    return orders.select(
        F.col("o_orderkey").cast("string").alias("Load_Tag"),
        F.col("o_orderkey").alias("Load_ID"),
        status.alias("Status"),
        F.concat(F.lit("RP-"), st).alias("Rptn"),
    )


def leg_alms(orders: DataFrame) -> DataFrame:
    st, pr, od = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate")
    prefix = F.when(pr == "1-URGENT", "AVS").when(pr == "2-HIGH", "FMS").when(pr == "3-MEDIUM", "DMSDL").otherwise("HUT")
    route = F.when(
        pr != "4-NOT SPECIFIED",
        F.concat(prefix, F.lpad(F.floor(F.col("o_custkey") / 100).cast("string"), 3, "0")),
    )
    end = _mins(od, 2 * 1440 + 14 * 60)
    life = (
        F.when(pr == "2-HIGH", F.lit(None).cast("string"))
        .when((pr == "3-MEDIUM") & (st == "P"), "ACA Cancelled (5)")
        .when(pr == "3-MEDIUM", "Tendered (2)")
        .otherwise("Active (1)")
    )
    carrier = F.when(
        ~((pr == "3-MEDIUM") & (st == "O")),
        F.concat(F.lit("CR"), st, F.lpad(F.floor(F.col("o_custkey") / 500).cast("string"), 2, "0")),
    )
    distance = (
        F.when(st == "F", dotted(F.col("o_totalprice")))
        .when(st == "O", F.floor(F.col("o_totalprice")).cast("bigint").cast("string"))
        .otherwise("n/a")
    )
    return orders.select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit("-1")).alias("Loadleg_tag"),
        F.col("o_orderkey").cast("string").alias("Load_Tag"),
        F.col("o_orderkey").alias("Loadleg_Id"),
        F.col("o_orderkey").alias("Load_ID"),
        route.alias("Route"),
        F.when(st == "F", "1").when(st == "O", "2").alias("Version"),
        F.lit("1").alias("Leg"),
        F.when(st == "F", "TL").otherwise("LTL").alias("Mode"),
        F.concat(F.lit("TR"), F.col("o_custkey").cast("string")).alias("Trailer_1"),
        F.when(st == "O", F.concat(F.lit("TR"), F.col("o_orderkey").cast("string"))).alias("Trailer_2"),
        iso_text(_mins(od, 6 * 60)).alias("Start_Time"),
        F.when(st == "O", us_text(end)).otherwise(iso_text(end)).alias("End_Time"),
        F.when(pr == "1-URGENT", "TBD").otherwise(iso_text(_mins(od, 5 * 60))).alias("Est_Start_Time"),
        life.alias("Life_Cycle_Seq"),
        F.lit("Active").alias("Status"),
        carrier.alias("Carrier_Code"),
        F.concat(F.lit("Carrier "), st).alias("Carrier_Name"),
        distance.alias("Distance"),
        F.year(od).alias("Year"),
        F.weekofyear(od).alias("Week"),
        _mins(od, 1440).alias("Last_update"),
        F.when(pr == "1-URGENT", "AVS").when(pr == "2-HIGH", "FMS").when(pr == "4-NOT SPECIFIED", F.lit(None))
        .otherwise("DMS").alias("cus"),
    )


def leg_stop_alms(lineitem: DataFrame) -> DataFrame:
    t = stop_times(lineitem)
    rf, ls, sk = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_suppkey")
    is_pick = F.when(rf == "R", 1).when(rf == "A", 0)
    is_drop = (
        F.when(rf == "A", 1)
        .when(rf == "R", F.when(ls == "O", 1).otherwise(0))
        .otherwise(F.when(ls == "O", 0))
    )
    cus = (
        F.when(sk % 10 == 9, "DMS")
        .when(sk % 10 == 8, F.lit(None).cast("string"))
        .when(sk % 10 == 7, "FMS")
        .when(ls == "O", "HUT")
        .otherwise("AVS")
    )
    text = lambda c: F.when(rf == "N", us_text(F.col(c))).otherwise(iso_text(F.col(c)))
    return t.select(
        F.concat(F.lit("R"), F.lpad(F.floor(F.col("l_orderkey") / 1000).cast("string"), 4, "0")).alias("Route"),
        F.when(rf != "N", "1").alias("Version"),
        F.lit("1").alias("Leg"),
        F.col("l_orderkey").alias("Loadleg_ID"),
        F.col("l_orderkey").alias("Load_ID"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-1")).alias("LoadLeg_Tag"),
        F.col("l_linenumber").alias("Stop_Seq"),
        F.when(ls == "O", "Active").otherwise("Completed").alias("CC_Active_Status"),
        _code(sk).alias("Stop_Code"),
        F.concat(F.lit("Stop "), sk.cast("string")).alias("Stop_Name"),
        is_pick.alias("Is_Pick"),
        is_drop.alias("Is_Drop"),
        text("_arr").alias("Arr_Time"),
        text("_dep").alias("Dep_Time"),
        F.when(F.col("l_tax") == 0, "TBD").otherwise(iso_text(F.col("_est"))).alias("Est_Dep_Time"),
        text("_acta").alias("Actl_Arr_Time"),
        text("_actd").alias("Actl_Dep_Time"),
        (F.col("l_linenumber") * 30).alias("Travel_Time"),
        dotted(F.col("l_extendedprice")).alias("Distance_From_last_Stop"),
        cus.alias("cus"),
        _mins(F.col("l_shipdate"), 1440).alias("Last_update"),
    )


def location_alms(supplier: DataFrame) -> DataFrame:
    n = F.col("s_nationkey")
    return supplier.select(
        F.concat(F.lit(" "), _location_code(F.col("s_suppkey")), F.lit("  ")).alias("Location_Code"),
        F.col("s_name").alias("Location_Name"),
        F.when(n >= 5, F.concat(F.lit("Planner "), n.cast("string"))).alias("LE"),
        F.when(n < 3, F.lit(None).cast("string")).when(n < 18, "Supplier").otherwise("Carrier").alias("LocationType"),
    )


def tables_alms(spark: SparkSession, sf_dir: str) -> TablesALMS:
    orders = read(spark, sf_dir, "orders")
    return TablesALMS(
        loads=load_alms(orders),
        legs=leg_alms(orders),
        stops=leg_stop_alms(read(spark, sf_dir, "lineitem")),
        locations=location_alms(read(spark, sf_dir, "supplier")),
    )


# --- events as stop times ----------------------------------------------------------


def event_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with planned/actual/estimated times for the column-rule queries.

    planned = ts; actual = ts + (floor(value) - 100) minutes, NULL for errors;
    estimated = ts + (floor(value) - 50) minutes.
    """
    ev = read(spark, sf_dir, "events")
    v = F.floor(F.col("value")).cast("int")
    return ev.select(
        "event_id",
        "event_type",
        "user_id",
        F.col("ts").alias("planned"),
        F.when(F.col("event_type") != "error", _mins(F.col("ts"), v - 100)).alias("actual"),
        _mins(F.col("ts"), v - 50).alias("estimated"),
    )
