"""Stops reports (47 columns) of both transport systems.

Shape of each report, as a Spark plan:

1. scan the stops (customer filter pushed to the scan where text rules are
   exact) and drop loads/legs with deliveries but none at a plant
   (grouped aggregate + null-aware anti join, :func:`not_in`);
2. ALMS only: ``distinct`` over the 21 base columns (parsed times included),
   as the source's DISTINCT over the raw row;
3. one projection computing every column rule (crew, shift, bands, ...);
4. supplier lists per load/leg (distinct tuples, one sorted ``collect_list``);
5. left join of the rows to their lists, final column order, and the sort
   only when ``MartConfig.sort_reports`` asks for it (ALMS: join and sort come
   before 3, so that exchanges carry the base columns only).

The ALMS stop table is read twice: whole for the rows, and four narrow columns
for the codes of each leg, one exchange from which the exclusion, the marks that
drop most excluded rows before the anti join deals them, and the lists are made. Legs without an id are looked for with a filter that reaches
the reader, which skips row groups without them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmart import config as C
from dockmart.config import DEFAULT_CONFIG, MartConfig
from dockmart.functions import dates as D
from dockmart.functions import rules as R
from dockmart.functions.text import concat_text, dotted_int, text_in, text_not_in, trunc_int
from dockmart.operators.aggregates import distinct_rows
from dockmart.operators.joins import left_dim, not_in
from dockmart.plans.common import (
    customer_stops_3g,
    leg_codes_alms,
    loads_without_plant_delivery_3g,
    supplier_lists_3g,
    supplier_lists_alms,
    without_marked_foreign_legs,
)
from dockmart.sources.schemas import STOPS_COLUMNS
from dockmart.sources.tables import Tables3G, TablesALMS


def _null_text() -> Column:
    return F.lit(None).cast("string")


def _time_columns(prefix: str, ts: Column) -> dict[str, Column]:
    """``<prefix>``, ``<prefix> Date``, ``<prefix> Time`` of one parsed time."""
    return {prefix: ts, f"{prefix} Date": D.date_of(ts), f"{prefix} Time": D.time_text(ts)}


def measures(rows: DataFrame, as_of: Column | None, cfg: MartConfig) -> DataFrame:
    """The derived columns of ``final_data`` (same for both sources).

    Needs the raw columns ``Planned Departure``, ``Planned Departure Date``,
    ``Actual Departure``, ``Late By (Hrs)``, ``Crew``, ``Shift Start Time``,
    ``Loadleg ID Customer Key`` parts are added by the caller.
    """
    now = as_of if as_of is not None else D.now_local()
    pdep, adep = F.col("Planned Departure"), F.col("Actual Departure")
    out = rows.withColumns(
        {
            "Late By (Hrs)": R.clamp_at_zero(F.col("Late By (Hrs)")),
            "Start of Week": D.week_start(F.col("Planned Departure Date")),
            "Shift Id": R.shift_id("Crew", "Shift Start Time"),
            "Difference": D.minute_diff(pdep, adep),
            "Days Since Planned Departure": D.day_diff(pdep, now),
            "On-Time": R.on_time_band(pdep, adep, now),
        }
    )
    return out.withColumns(
        {
            "Late By (Hrs) Sort By This Field in PBI": R.late_hours_while_open(adep, F.col("Late By (Hrs)")),
            "Late By (Hrs) for PBI Visual": R.lateness_display(adep, F.col("Late By (Hrs)"), F.col("On-Time")),
        }
    )


def _with_lists(rows: DataFrame, lists: DataFrame) -> DataFrame:
    l2 = lists.withColumnRenamed("Loadleg ID", "__list_key")
    return rows.join(l2, rows["Loadleg ID"] == l2["__list_key"], "left").drop("__list_key")


def _finish(final: DataFrame, lists: DataFrame, sort_keys: list[str], cfg: MartConfig) -> DataFrame:
    out = _with_lists(final, lists).select(*[F.col(f"`{c}`") for c in STOPS_COLUMNS])
    return out.orderBy(*sort_keys) if cfg.sort_reports else out


# --- ALMS ------------------------------------------------------------------------


def alms_base_rows(stops: DataFrame, cfg: MartConfig = DEFAULT_CONFIG, codes: DataFrame | None = None) -> DataFrame:
    """The distinct rows of the ALMS stops report in the 21 columns that all others are made of.

    ``codes`` is :func:`leg_codes_alms` of the same stops, where the caller shares it.
    """
    rules = cfg.text
    s = stops.where(text_in("cus", C.STOP_CUSTOMER_CODES, rules))
    codes = leg_codes_alms(stops, rules) if codes is None else codes
    s = without_marked_foreign_legs(s, "Loadleg_ID", stops, codes, rules)
    fmts = cfg.timestamp_formats
    base: dict[str, Column] = {
        "Route": F.col("Route"),
        "Version": F.col("Version"),
        "Leg": F.col("Leg"),
        "Loadleg ID": F.col("Loadleg_ID"),
        "Load ID": F.col("Load_ID"),
        "Loadleg Tag": F.col("LoadLeg_Tag"),
        "Active Status": F.col("CC_Active_Status"),
        "Stop Location": F.col("Stop_Code"),
        "Stop Name": F.col("Stop_Name"),
        "Stop Sequence": F.col("Stop_Seq"),
        "Is Pick": F.col("Is_Pick"),
        "Is Drop": F.col("Is_Drop"),
        "Planned Departure": D.safe_timestamp("Dep_Time", fmts),
        "Estimated Departure": D.safe_timestamp("Est_Dep_Time", fmts),
        "Planned Arrival": D.safe_timestamp("Arr_Time", fmts),
        "Actual Arrival": D.safe_timestamp("Actl_Arr_Time", fmts),
        "Actual Departure": D.safe_timestamp("Actl_Dep_Time", fmts),
        "Travel_Time": F.col("Travel_Time"),
        "Distance from Last Stop": dotted_int("Distance_From_last_Stop", strict=True),
        "Stop Customer": R.customer_group("cus", rules),
        "Stops Last Updated": F.col("Last_update"),
    }
    return distinct_rows(s.select(*[c.alias(n) for n, c in base.items()]))


def alms_derived(rows: DataFrame, cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """:func:`alms_base_rows` with the 19 raw columns that are functions of them."""
    rules = cfg.text
    arr, dep, est = F.col("Planned Arrival"), F.col("Planned Departure"), F.col("Estimated Departure")
    route, version = F.col("Route"), F.col("Version")
    derived: dict[str, Column] = {
        "Route-Version": concat_text(route, C.KEY_DASH, version),
        "Route-Version-Leg": concat_text(route, C.KEY_DASH, version, C.KEY_DASH, F.col("Leg")),
        "Loadleg Tag Stop": concat_text(F.col("Loadleg Tag"), C.KEY_SPACED_DASH, F.col("Stop Sequence")),
        "Is HUT Location": R.plant_flag_by_code("Stop Location", rules),
        "Dunnage/Freight": R.freight_direction_by_flags("Is Pick", "Is Drop", "Stop Location", rules),
        "Planned Departure Date": D.date_of(dep),
        "Estimated Departure Date": D.date_of(est),
        "Estimated Departure Time": D.time_text(est),
        "Late By (Hrs)": R.late_hours_raw(dep, est, cfg.late_hours_overflow_null),
        "Planned Day of Week": D.weekday_name(arr),
        "Crew": R.crew(arr, "Route", cfg.crew_suppressed_route_prefix, rules),
        "Shift Start Time": R.shift_start(arr),
        "Actual Arrival Date": D.date_of("Actual Arrival"),
        "Actual Arrival Time": D.time_text("Actual Arrival"),
        "Planned Arrival Date": D.date_of(arr),
        "Planned Arrival Time": D.time_text(arr),
        "Planned Departure Time": D.time_text(dep),
        "Actual Departure Date": D.date_of("Actual Departure"),
        "Actual Departure Time": D.time_text("Actual Departure"),
    }
    return rows.withColumns(derived)


def alms_stop_rows(stops: DataFrame, cfg: MartConfig = DEFAULT_CONFIG, codes: DataFrame | None = None) -> DataFrame:
    """``raw_data`` of the ALMS stops report: filtered, derived, distinct rows.

    The source takes DISTINCT over all 40 raw columns. 19 of them are
    functions of the other 21 (dates, time text, crew, shift, flags, keys),
    so the distinct is taken over those 21 base columns and the rest is
    derived afterwards: the same rows, but the shuffle carries about half the
    bytes and the rules run on deduplicated rows only.
    """
    return alms_derived(alms_base_rows(stops, cfg, codes), cfg)


def stops_alms_report(
    tables: TablesALMS, as_of: Column | None = None, cfg: MartConfig = DEFAULT_CONFIG
) -> DataFrame:
    """The ALMS stops report (47 columns), ordered by leg and stop sequence.

    The lists are joined to the 21 base columns, and these are sorted: each
    derived column is made after the last exchange.
    """
    codes = leg_codes_alms(tables.stops, cfg.text)
    lists = supplier_lists_alms(tables.stops, tables.locations, cfg.text, codes)
    rows = _with_lists(alms_base_rows(tables.stops, cfg, codes), lists)
    if cfg.sort_reports:
        rows = rows.orderBy("Loadleg ID", "Stop Sequence")
    final = measures(alms_derived(rows, cfg), as_of, cfg).withColumn(
        "Loadleg ID Customer Key", concat_text(F.col("Loadleg ID"), C.KEY_DASH, F.col("Stop Customer"))
    )
    return final.select(*[F.col(f"`{c}`") for c in STOPS_COLUMNS])


#: The narrow sample of stops that shows missing times: output name -> column of the rows.
SAMPLE_COLUMNS = {
    "Loadleg Tag": "Loadleg Tag",
    "Route": "Route",
    "Stop Loc": "Stop Location",
    "Stop Seq": "Stop Sequence",
    "Is Pick": "Is Pick",
    "Is Drop": "Is Drop",
    "Planned Arr.": "Planned Arrival Date",
    "Actual Arr.": "Actual Arrival Date",
    "Planned Dep.": "Planned Departure Date",
    "Actual Dep.": "Actual Departure Date",
    "On-Time": "On-Time",
}


def stops_alms_sample(tables: TablesALMS, as_of: Column | None = None, cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """The rows of the ALMS stops report in 11 columns; neither lists nor other columns are made for it."""
    rows = measures(alms_stop_rows(tables.stops, cfg), as_of, cfg)
    return rows.select(*[F.col(f"`{c}`").alias(n) for n, c in SAMPLE_COLUMNS.items()])


# --- 3G --------------------------------------------------------------------------


def g3_stop_rows(tables: Tables3G, cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """``raw_data`` of the 3G stops report: the customer's loads with their stops."""
    rules = cfg.text
    loads = tables.load.where(text_not_in("DataValue_LoadTmsStatus", C.EXCLUDED_LOAD_STATUSES, rules))
    loads = not_in(loads, "LoadId", loads_without_plant_delivery_3g(tables.stop, tables.loc, rules))
    load_clients = customer_stops_3g(tables, rules)
    x = loads.select("LoadId", "LoadNum", "DataValue_LoadTmsStatus").join(
        load_clients, F.col("LoadId") == F.col("__bridge_load")
    )
    stop = tables.stop.select(*[F.col(c).alias(f"s_{c}") for c in tables.stop.columns])
    x = x.join(stop, x["LoadId"] == stop["s_LoadId"], "left")
    x = left_dim(x, tables.loc, "s_LocId", "LocId", {"AddrName": "__loc_name"})
    if cfg.stops_3g_limit is not None:
        x = x.orderBy("LoadNum", "s_StopNum", "s_LocId", "client_num").limit(cfg.stops_3g_limit)
    fmts = cfg.timestamp_formats
    x = x.withColumns(
        {
            "__dep": D.safe_timestamp("s_DateTime_LateArrival", fmts),
            "__est": D.safe_timestamp("s_DateTime_ExpectedDeparture", fmts),
            "__arr": D.safe_timestamp("s_DateTime_PlannedArrival", fmts),
            "__aarr": D.safe_timestamp("s_DateTime_ActualArrival", fmts),
            "__adep": D.safe_timestamp("s_DateTime_ActualDeparture", fmts),
        }
    )
    arr, stype, name = F.col("__arr"), F.col("s_DataValue_StopType"), F.col("__loc_name")
    cols: dict[str, Column] = {
        "Route": _null_text(),
        "Version": _null_text(),
        "Leg": _null_text(),
        "Route-Version": _null_text(),
        "Route-Version-Leg": _null_text(),
        "Loadleg ID": F.col("LoadNum"),
        "Load ID": F.col("s_LoadId"),
        "Loadleg Tag": F.col("LoadNum"),
        "Loadleg Tag Stop": concat_text(F.col("LoadNum"), C.KEY_SPACED_DASH, F.col("s_StopNum")),
        "Active Status": R.active_status("DataValue_LoadTmsStatus", rules),
        "Stop Location": F.col("s_LocId"),
        "Is HUT Location": R.plant_flag_by_name(name, rules),
        "Stop Name": name,
        "Stop Sequence": F.col("s_StopNum"),
        "Is Pick": R.stop_type_flag(stype, C.STOP_TYPE_PICKUP, rules),
        "Is Drop": R.stop_type_flag(stype, C.STOP_TYPE_DELIVERY, rules),
        "Dunnage/Freight": R.freight_direction_by_type(stype, name, rules),
        "Planned Departure": F.col("__dep"),
        "Planned Departure Date": D.date_of("__dep"),
        **_time_columns("Estimated Departure", F.col("__est")),
        "Late By (Hrs)": R.late_hours_raw("__dep", "__est", cfg.late_hours_overflow_null),
        "Planned Day of Week": D.weekday_name(arr),
        "Crew": R.crew(arr),
        "Shift Start Time": R.shift_start(arr),
        **_time_columns("Actual Arrival", F.col("__aarr")),
        **_time_columns("Planned Arrival", arr),
        "Planned Departure Time": D.time_text("__dep"),
        "Actual Departure": F.col("__adep"),
        "Actual Departure Date": D.date_of("__adep"),
        "Actual Departure Time": D.time_text("__adep"),
        "Travel_Time": F.col("s_DurationTransitTimeFromPrevStop"),
        "Distance from Last Stop": trunc_int("s_Dist_FromPrevStop"),
        "Stop Customer": F.col("client_num"),
        "Loadleg ID Customer Key": concat_text(F.col("LoadNum"), C.KEY_DASH, F.col("client_num")),
        "Stops Last Updated": F.col("s_DateLastModified"),
    }
    return x.select(*[c.alias(n) for n, c in cols.items()])


def stops_3g_report(tables: Tables3G, as_of: Column | None = None, cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """The 3G stops report (47 columns), ordered by load number and stop."""
    final = measures(g3_stop_rows(tables, cfg), as_of, cfg)
    lists = supplier_lists_3g(tables, cfg.text)
    return _finish(final, lists, ["Loadleg Tag", "Stop Sequence"], cfg)
