"""Declared schemas of the source tables and the report column names.

The source systems publish no DDL; names come from the reports' use and
types from that use (ids as ``bigint``, free text and lenient times as
``string``). Every read uses these schemas, nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


S, L, I, D, TS = StringType(), LongType(), IntegerType(), DoubleType(), TimestampNTZType()

# --- 3G -----------------------------------------------------------------------

LOAD_3G = _schema(
    ("LoadId", L),
    ("LoadNum", S),
    ("DataValue_LoadTmsStatus", S),
    ("LocIdDest", L),
    ("TransportModeId", L),
    ("TradingPartnerIdCarrier", L),
    ("DateTime_PlannedStart", TS),
    ("DateTime_PlannedEnd", TS),
    ("Dist_Tot", D),
    ("DateLastModified", TS),
)
STOP_3G = _schema(
    ("LoadId", L),
    ("StopNum", I),
    ("LocId", L),
    ("DataValue_StopType", S),
    ("DateTime_PlannedArrival", TS),
    ("DateTime_LateArrival", TS),
    ("DateTime_ExpectedDeparture", TS),
    ("DateTime_ActualArrival", TS),
    ("DateTime_ActualDeparture", TS),
    ("DurationTransitTimeFromPrevStop", I),
    ("Dist_FromPrevStop", D),
    ("DateLastModified", TS),
)
LOC_3G = _schema(("LocId", L), ("AddrName", S))
TRADING_PARTNER_3G = _schema(
    ("TradingPartnerId", L),
    ("TradingPartnerNum", S),
    ("TradingPartnerName", S),
    ("DataValue_TradingPartnerType", S),
)
TRANSPORT_MODE_3G = _schema(("TransportModeId", L), ("TransportModeName", S))
LOAD_CLIENT_3G = _schema(("LoadId", L), ("TradingPartnerIdClient", L))
LOAD_ORDER_3G = _schema(("LoadId", L), ("OrdHeaderId", L))
ORDER_HEADER_3G = _schema(("OrdHeaderId", L), ("TradingPartnerIdClient", L))
# read only for the joins through order legs
ORDER_HEADER_DEST_3G = _schema(("OrdHeaderId", L), ("TradingPartnerIdClient", L), ("LocIdDest", L))
ORDER_LEG_3G = _schema(("OrdLegId", L), ("OrdHeaderId", L))
ORDER_LEG_LOAD_3G = _schema(("OrdLegId", L), ("LegSeq", I), ("LoadId", L))

TABLES_3G = {
    "Load": LOAD_3G,
    "Stop": STOP_3G,
    "Loc": LOC_3G,
    "TradingPartner": TRADING_PARTNER_3G,
    "TransportMode": TRANSPORT_MODE_3G,
    "Vw3g_Load_ClientAndCount": LOAD_CLIENT_3G,
    "Vw3g_Load_Ord": LOAD_ORDER_3G,
    "OrdHeader": ORDER_HEADER_3G,
}
ORDER_LEG_TABLES_3G = {"OrdHeader": ORDER_HEADER_DEST_3G, "OrdLeg": ORDER_LEG_3G, "OrdLeg_LoadLeg": ORDER_LEG_LOAD_3G}

# --- ALMS ---------------------------------------------------------------------

LOAD_ALMS = _schema(("Load_Tag", S), ("Load_ID", L), ("Status", S), ("Rptn", S))
LEG_ALMS = _schema(
    ("Loadleg_tag", S),
    ("Load_Tag", S),
    ("Loadleg_Id", L),
    ("Load_ID", L),
    ("Route", S),
    ("Version", S),
    ("Leg", S),
    ("Mode", S),
    ("Trailer_1", S),
    ("Trailer_2", S),
    ("Start_Time", S),
    ("End_Time", S),
    ("Est_Start_Time", S),
    ("Life_Cycle_Seq", S),
    ("Status", S),
    ("Carrier_Code", S),
    ("Carrier_Name", S),
    ("Distance", S),
    ("Year", I),
    ("Week", I),
    ("Last_update", TS),
    ("cus", S),
)
LEG_STOP_ALMS = _schema(
    ("Route", S),
    ("Version", S),
    ("Leg", S),
    ("Loadleg_ID", L),
    ("Load_ID", L),
    ("LoadLeg_Tag", S),
    ("Stop_Seq", I),
    ("CC_Active_Status", S),
    ("Stop_Code", S),
    ("Stop_Name", S),
    ("Is_Pick", I),
    ("Is_Drop", I),
    ("Arr_Time", S),
    ("Dep_Time", S),
    ("Est_Dep_Time", S),
    ("Actl_Arr_Time", S),
    ("Actl_Dep_Time", S),
    ("Travel_Time", I),
    ("Distance_From_last_Stop", S),
    ("cus", S),
    ("Last_update", TS),
)
LOCATION_ALMS = _schema(("Location_Code", S), ("Location_Name", S), ("LE", S), ("LocationType", S))

TABLES_ALMS = {
    "METRIX_LOAD_hourly_2306": LOAD_ALMS,
    "METRIX_LOAD_LEG_hourly_2306": LEG_ALMS,
    "METRIX_LOAD_LEG_STOP_Hourly_2306": LEG_STOP_ALMS,
    "METRIX_LOCATION": LOCATION_ALMS,
}

# --- report columns (output contract) -----------------------------------------
# FIXED VALUES: column names and order of the reports.

LOADS_COLUMNS = (
    "Loadleg Tag",
    "Load Tag",
    "Activity",
    "Load Status",
    "Route Pattern",
    "Load ID",
    "Route",
    "Load Count Per Route",
    "Version",
    "Leg",
    "Route-Version",
    "Route-Version-Leg",
    "Mode",
    "Loadleg ID",
    "Trailer",
    "Trailer 2",
    "Load Start Time",
    "Load End Date",
    "Load End Time",
    "Estimated Start Time",
    "Life Cycle Sequence",
    "Status",
    "Carrier Code",
    "Carrier Name",
    "Carrier",
    "Load Count Per Carrier",
    "Distance",
    "Year",
    "Week",
    "Load Legs Last Updated",
    "TMS",
)
# The 3G loads report spells the second trailer without the blank.
LOADS_3G_RENAMES = {"Trailer 2": "Trailer2"}

STOPS_COLUMNS = (
    "Route",
    "Version",
    "Leg",
    "Route-Version",
    "Route-Version-Leg",
    "Loadleg ID",
    "Load ID",
    "Loadleg Tag",
    "Loadleg Tag Stop",
    "Active Status",
    "Stop Location",
    "Is HUT Location",
    "Stop Name",
    "Supplier(s)",
    "Name(s)",
    "Planner(s)",
    "Stop Sequence",
    "Is Pick",
    "Is Drop",
    "Dunnage/Freight",
    "Planned Departure",
    "Planned Departure Date",
    "Planned Day of Week",
    "Crew",
    "Shift Start Time",
    "Shift Id",
    "Start of Week",
    "Planned Departure Time",
    "Estimated Departure",
    "Estimated Departure Date",
    "Estimated Departure Time",
    "Late By (Hrs) Sort By This Field in PBI",
    "Late By (Hrs) for PBI Visual",
    "Actual Arrival",
    "Difference",
    "Days Since Planned Departure",
    "On-Time",
    "Actual Arrival Date",
    "Actual Arrival Time",
    "Actual Departure",
    "Actual Departure Date",
    "Actual Departure Time",
    "Travel_Time",
    "Distance from Last Stop",
    "Stop Customer",
    "Loadleg ID Customer Key",
    "Stops Last Updated",
)
