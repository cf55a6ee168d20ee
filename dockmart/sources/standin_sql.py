"""The stand-in source tables of :mod:`dockmart.sources.standin`, in SQL.

Used by the DuckDB oracle (``oracle_sql()``): each stand-in is a CTE over the
driver's pre-registered views. The expressions are written independently of
the Spark ones; ``tests/test_standin.py`` checks that both give the same rows.
"""

from __future__ import annotations

AS_OF_STOPS_SQL = "TIMESTAMP '1999-06-30 12:00:00'"
AS_OF_EVENTS_SQL = "TIMESTAMP '2024-01-20 12:00:00'"


def _iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def _us(ts: str) -> str:
    return f"strftime({ts}, '%m/%d/%Y %H:%M:%S')"


def _dotted(x: str) -> str:
    return (
        f"(CAST(CAST(floor({x} / 1000) AS BIGINT) AS VARCHAR) || '.' || "
        f"lpad(CAST(CAST(floor({x}) AS BIGINT) % 1000 AS VARCHAR), 3, '0'))"
    )


def _location_code(key: str) -> str:
    """Location code of a supplier key: keys 1-5 are the plants, 6 repeats the first."""
    return (
        f"(CASE {key} WHEN 1 THEN '10' WHEN 6 THEN '10' WHEN 2 THEN '10A' WHEN 3 THEN '11' "
        f"WHEN 4 THEN 'FMS' WHEN 5 THEN 'AVS' ELSE 'S' || CAST({key} AS VARCHAR) END)"
    )


def _code(key: str) -> str:
    return (
        f"(CASE {key} % 25 WHEN 0 THEN '10' WHEN 1 THEN '10A' WHEN 2 THEN '11' "
        f"WHEN 3 THEN 'FMS' WHEN 4 THEN 'AVS' ELSE 'S' || CAST({key} AS VARCHAR) END)"
    )


STOP_TIMES = """
stop_times AS (
  SELECT *, _actd - INTERVAL 30 MINUTE AS _acta FROM (
    SELECT *,
      _dep + to_minutes(CAST(floor(l_extendedprice) AS BIGINT) % 400 - 100) AS _est,
      CASE WHEN l_linestatus <> 'O' THEN _dep + to_seconds(
        (CAST(floor(l_extendedprice / 7) AS BIGINT) % 360 - 60) * 60 + l_partkey % 60) END AS _actd
    FROM (
      SELECT *, _arr + INTERVAL 45 MINUTE AS _dep FROM (
        SELECT *, l_shipdate + to_seconds(((l_partkey * 7) % 1440) * 60 + l_suppkey % 60) AS _arr
        FROM lineitem) a) b) c)"""

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "stop_times": ((), STOP_TIMES),
    "load_3g": (
        (),
        """
load_3g AS (
  SELECT o_orderkey AS LoadId,
    'L' || CAST(o_orderkey AS VARCHAR) AS LoadNum,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'Canceled'
         WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'TenderExpired'
         WHEN o_orderstatus = 'F' THEN 'Delivered'
         WHEN o_orderstatus = 'O' THEN 'InTransit'
         ELSE 'Tendered' END AS DataValue_LoadTmsStatus,
    o_custkey % 50 AS LocIdDest,
    CAST(substr(o_orderpriority, 1, 1) AS BIGINT) - 1 AS TransportModeId,
    o_custkey AS TradingPartnerIdCarrier,
    o_orderdate + INTERVAL 6 HOUR AS DateTime_PlannedStart,
    o_orderdate + INTERVAL 2 DAY + INTERVAL 14 HOUR AS DateTime_PlannedEnd,
    o_totalprice AS Dist_Tot,
    o_orderdate + INTERVAL 3 DAY AS DateLastModified
  FROM orders)""",
    ),
    "stop_3g": (
        ("stop_times",),
        """
stop_3g AS (
  SELECT l_orderkey AS LoadId, l_linenumber AS StopNum, l_suppkey AS LocId,
    CASE l_returnflag WHEN 'A' THEN 'Delivery' WHEN 'R' THEN 'Pickup' ELSE 'Transfer' END AS DataValue_StopType,
    _arr AS DateTime_PlannedArrival,
    _dep AS DateTime_LateArrival,
    CASE WHEN l_tax <> 0 THEN _est END AS DateTime_ExpectedDeparture,
    _acta AS DateTime_ActualArrival,
    _actd AS DateTime_ActualDeparture,
    l_linenumber * 30 AS DurationTransitTimeFromPrevStop,
    l_extendedprice / 100 AS Dist_FromPrevStop,
    l_shipdate + INTERVAL 1 DAY AS DateLastModified
  FROM stop_times)""",
    ),
    "loc_3g": (
        (),
        """
loc_3g AS (
  SELECT s_suppkey AS LocId,
    CASE s_nationkey WHEN 0 THEN 'Hutchinson AVS' WHEN 1 THEN 'Hutchinson Cadillac'
      WHEN 2 THEN 'Hutchinson FMS Wh' WHEN 3 THEN 'Hutchinson FMS' WHEN 4 THEN 'HUTCHINSON Annex'
      WHEN 5 THEN s_name || ' at Hutchinson' WHEN 6 THEN NULL ELSE s_name END AS AddrName
  FROM supplier)""",
    ),
    "partner_3g": (
        (),
        """
partner_3g AS (
  SELECT c_custkey AS TradingPartnerId,
    CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'HUT' ELSE 'C' || CAST(c_custkey AS VARCHAR) END AS TradingPartnerNum,
    c_name AS TradingPartnerName,
    CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'Carrier' ELSE 'Client' END
      AS DataValue_TradingPartnerType
  FROM customer)""",
    ),
    "mode_3g": (
        (),
        """
mode_3g AS (
  SELECT CAST(r_regionkey AS BIGINT) AS TransportModeId, r_name AS TransportModeName FROM region)""",
    ),
    "load_client_3g": (
        (),
        """
load_client_3g AS (SELECT o_orderkey AS LoadId, o_custkey AS TradingPartnerIdClient FROM orders)""",
    ),
    "load_order_3g": (
        (),
        """
load_order_3g AS (SELECT l_orderkey AS LoadId, l_partkey AS OrdHeaderId FROM lineitem)""",
    ),
    "order_header_3g": (
        (),
        """
order_header_3g AS (
  SELECT p_partkey AS OrdHeaderId, CAST(p_size * 10 AS BIGINT) AS TradingPartnerIdClient, CAST(p_size AS BIGINT) AS LocIdDest
  FROM part)""",
    ),
    "order_leg_3g": (
        (),
        """
order_leg_3g AS (SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS OrdLegId, l_partkey AS OrdHeaderId FROM lineitem)""",
    ),
    "order_leg_load_3g": (
        (),
        """
order_leg_load_3g AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS OrdLegId, CAST(10 - k AS INTEGER) AS LegSeq,
    CAST(l_orderkey + k AS BIGINT) AS LoadId
  FROM lineitem JOIN (VALUES (0), (1), (2)) steps(k) ON k <= l_linenumber % 3)""",
    ),
    "load_alms": (
        (),
        """
load_alms AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS Load_Tag, o_orderkey AS Load_ID,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'Adjusted'
         WHEN o_orderstatus = 'F' THEN 'Closed' WHEN o_orderstatus = 'O' THEN 'Open'
         ELSE 'Planned' END AS Status,
    'RP-' || o_orderstatus AS Rptn
  FROM orders)""",
    ),
    "leg_alms": (
        (),
        f"""
leg_alms AS (
  SELECT CAST(o_orderkey AS VARCHAR) || '-1' AS Loadleg_tag,
    CAST(o_orderkey AS VARCHAR) AS Load_Tag,
    o_orderkey AS Loadleg_Id, o_orderkey AS Load_ID,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN
      (CASE o_orderpriority WHEN '1-URGENT' THEN 'AVS' WHEN '2-HIGH' THEN 'FMS'
            WHEN '3-MEDIUM' THEN 'DMSDL' ELSE 'HUT' END)
      || lpad(CAST(CAST(floor(o_custkey / 100) AS BIGINT) AS VARCHAR), 3, '0') END AS Route,
    CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' END AS Version,
    '1' AS Leg,
    CASE WHEN o_orderstatus = 'F' THEN 'TL' ELSE 'LTL' END AS Mode,
    'TR' || CAST(o_custkey AS VARCHAR) AS Trailer_1,
    CASE WHEN o_orderstatus = 'O' THEN 'TR' || CAST(o_orderkey AS VARCHAR) END AS Trailer_2,
    {_iso("o_orderdate + INTERVAL 6 HOUR")} AS Start_Time,
    CASE WHEN o_orderstatus = 'O' THEN {_us("o_orderdate + INTERVAL 2 DAY + INTERVAL 14 HOUR")}
         ELSE {_iso("o_orderdate + INTERVAL 2 DAY + INTERVAL 14 HOUR")} END AS End_Time,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'TBD'
         ELSE {_iso("o_orderdate + INTERVAL 5 HOUR")} END AS Est_Start_Time,
    CASE WHEN o_orderpriority = '2-HIGH' THEN NULL
         WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN 'ACA Cancelled (5)'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'Tendered (2)'
         ELSE 'Active (1)' END AS Life_Cycle_Seq,
    'Active' AS Status,
    CASE WHEN NOT (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O') THEN
      'CR' || o_orderstatus || lpad(CAST(CAST(floor(o_custkey / 500) AS BIGINT) AS VARCHAR), 2, '0') END
      AS Carrier_Code,
    'Carrier ' || o_orderstatus AS Carrier_Name,
    CASE WHEN o_orderstatus = 'F' THEN {_dotted("o_totalprice")}
         WHEN o_orderstatus = 'O' THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)
         ELSE 'n/a' END AS Distance,
    CAST(year(o_orderdate) AS INTEGER) AS Year,
    CAST(weekofyear(o_orderdate) AS INTEGER) AS Week,
    o_orderdate + INTERVAL 1 DAY AS Last_update,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'AVS' WHEN '2-HIGH' THEN 'FMS'
         WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'DMS' END AS cus
  FROM orders)""",
    ),
    "leg_stop_alms": (
        ("stop_times",),
        f"""
leg_stop_alms AS (
  SELECT 'R' || lpad(CAST(CAST(floor(l_orderkey / 1000) AS BIGINT) AS VARCHAR), 4, '0') AS Route,
    CASE WHEN l_returnflag <> 'N' THEN '1' END AS Version,
    '1' AS Leg,
    l_orderkey AS Loadleg_ID, l_orderkey AS Load_ID,
    CAST(l_orderkey AS VARCHAR) || '-1' AS LoadLeg_Tag,
    l_linenumber AS Stop_Seq,
    CASE WHEN l_linestatus = 'O' THEN 'Active' ELSE 'Completed' END AS CC_Active_Status,
    {_code("l_suppkey")} AS Stop_Code,
    'Stop ' || CAST(l_suppkey AS VARCHAR) AS Stop_Name,
    CAST(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS INTEGER) AS Is_Pick,
    CAST(CASE WHEN l_returnflag = 'A' THEN 1
         WHEN l_returnflag = 'R' THEN (CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)
         ELSE (CASE WHEN l_linestatus = 'O' THEN 0 END) END AS INTEGER) AS Is_Drop,
    CASE WHEN l_returnflag = 'N' THEN {_us("_arr")} ELSE {_iso("_arr")} END AS Arr_Time,
    CASE WHEN l_returnflag = 'N' THEN {_us("_dep")} ELSE {_iso("_dep")} END AS Dep_Time,
    CASE WHEN l_tax = 0 THEN 'TBD' ELSE {_iso("_est")} END AS Est_Dep_Time,
    CASE WHEN l_returnflag = 'N' THEN {_us("_acta")} ELSE {_iso("_acta")} END AS Actl_Arr_Time,
    CASE WHEN l_returnflag = 'N' THEN {_us("_actd")} ELSE {_iso("_actd")} END AS Actl_Dep_Time,
    l_linenumber * 30 AS Travel_Time,
    {_dotted("l_extendedprice")} AS Distance_From_last_Stop,
    CASE WHEN l_suppkey % 10 = 9 THEN 'DMS' WHEN l_suppkey % 10 = 8 THEN NULL
         WHEN l_suppkey % 10 = 7 THEN 'FMS' WHEN l_linestatus = 'O' THEN 'HUT'
         ELSE 'AVS' END AS cus,
    l_shipdate + INTERVAL 1 DAY AS Last_update
  FROM stop_times)""",
    ),
    "location_alms": (
        (),
        f"""
location_alms AS (
  SELECT ' ' || {_location_code("s_suppkey")} || '  ' AS Location_Code,
    s_name AS Location_Name,
    CASE WHEN s_nationkey >= 5 THEN 'Planner ' || CAST(s_nationkey AS VARCHAR) END AS LE,
    CASE WHEN s_nationkey < 3 THEN NULL WHEN s_nationkey < 18 THEN 'Supplier' ELSE 'Carrier' END AS LocationType
  FROM supplier)""",
    ),
    "event_stops": (
        (),
        """
event_stops AS (
  SELECT event_id, event_type, user_id, ts AS planned,
    CASE WHEN event_type <> 'error' THEN ts + to_minutes(CAST(floor(value) AS BIGINT) - 100) END AS actual,
    ts + to_minutes(CAST(floor(value) AS BIGINT) - 50) AS estimated
  FROM events)""",
    ),
}


def with_standins(*names: str) -> str:
    """``WITH`` clause defining the named stand-ins (and what they need)."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        deps, _ = CTES[n]
        for d in deps:
            visit(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",".join(CTES[n][1] for n in ordered)
