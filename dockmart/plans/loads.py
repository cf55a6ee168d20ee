"""Loads reports (31 columns) of both transport systems.

3G: loads of the customer's plants with their destination, mode and carrier
(two roles of the trading-partner table), distinct rows. The source also
joins the load-order bridge, the order header and the client partner, but no
column or filter uses them and the final DISTINCT removes their fan-out, so
they are left out: same rows, three joins fewer.

ALMS: loads joined to their legs, filtered on leg customer and life cycle,
legs without a plant delivery removed, distinct rows, then load counts per
route and per carrier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmart import config as C
from dockmart.config import DEFAULT_CONFIG, MartConfig, TextRules
from dockmart.functions import dates as D
from dockmart.functions import rules as R
from dockmart.functions.text import concat_text, dotted_int, text_in, text_ne, text_not_in
from dockmart.operators.aggregates import distinct_rows, first_per_key, with_counts_by
from dockmart.operators.joins import left_dim, left_join_on, not_in, role_join
from dockmart.plans.common import loads_without_plant_delivery_3g, without_foreign_legs
from dockmart.sources.schemas import LOADS_3G_RENAMES, LOADS_COLUMNS
from dockmart.sources.tables import Tables3G, TablesALMS


def _null(type_name: str):
    return F.lit(None).cast(type_name)


def loads_3g_report(tables: Tables3G, cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """The 3G loads report (31 columns, ``Trailer2`` spelt as the source does)."""
    rules = cfg.text
    ld = tables.load.where(text_not_in("DataValue_LoadTmsStatus", C.EXCLUDED_LOAD_STATUSES, rules))
    ld = not_in(ld, "LoadId", loads_without_plant_delivery_3g(tables.stop, tables.loc, rules))
    ld = left_dim(ld, tables.loc, "LocIdDest", "LocId", {"AddrName": "__dest_name"})
    ld = left_dim(ld, tables.mode, "TransportModeId", "TransportModeId", {"TransportModeName": "__mode"})
    ld = role_join(
        ld,
        tables.partner,
        "TradingPartnerIdCarrier",
        "TradingPartnerId",
        "DataValue_TradingPartnerType",
        C.PARTNER_ROLE_CARRIER,
        {"TradingPartnerNum": "__car_num", "TradingPartnerName": "__car_name"},
        rules,
    )
    fmts = cfg.timestamp_formats
    start = D.safe_timestamp("DateTime_PlannedStart", fmts)
    end = D.safe_timestamp("DateTime_PlannedEnd", fmts)
    cols = {
        "Loadleg Tag": F.col("LoadNum"),
        "Load Tag": F.col("LoadNum"),
        "Activity": R.activity_by_destination("__dest_name", rules),
        "Load Status": F.col("DataValue_LoadTmsStatus"),
        "Route Pattern": _null("string"),
        "Load ID": F.col("LoadId"),
        "Route": _null("string"),
        "Load Count Per Route": _null("int"),
        "Version": _null("string"),
        "Leg": _null("string"),
        "Route-Version": _null("string"),
        "Route-Version-Leg": _null("string"),
        "Mode": F.col("__mode"),
        "Loadleg ID": F.col("LoadId"),
        "Trailer": _null("string"),
        "Trailer 2": _null("string"),
        "Load Start Time": start,
        "Load End Date": D.date_of(end),
        "Load End Time": end,
        "Estimated Start Time": _null("timestamp_ntz"),
        "Life Cycle Sequence": F.col("DataValue_LoadTmsStatus"),
        "Status": F.lit(C.LOAD_ROW_STATUS_3G),
        "Carrier Code": F.col("__car_num"),
        "Carrier Name": F.col("__car_name"),
        "Carrier": concat_text(F.col("__car_num"), C.KEY_SPACED_DASH, F.col("__car_name")),
        "Load Count Per Carrier": _null("int"),
        "Distance": F.col("Dist_Tot"),
        "Year": D.year_of("DateTime_PlannedStart"),
        "Week": _null("int"),
        "Load Legs Last Updated": F.col("DateLastModified"),
        "TMS": F.lit(C.TMS_3G),
    }
    out = ld.select(*[cols[c].alias(LOADS_3G_RENAMES.get(c, c)) for c in LOADS_COLUMNS])
    return out.distinct()


def alms_load_rows(tables: TablesALMS, cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """``loads_data`` of the ALMS loads report: distinct load-leg rows (28 columns)."""
    rules = cfg.text
    ld = tables.loads.where(text_ne("Status", C.EXCLUDED_ALMS_LOAD_STATUS, rules))
    legs = tables.legs.select(*[F.col(c).alias(f"ll_{c}") for c in tables.legs.columns])
    j = left_join_on(
        ld,
        legs,
        [("Load_Tag", "ll_Load_Tag"), ("Load_ID", "ll_Load_ID")],
        left_condition=text_ne(ld["Status"], C.EXCLUDED_ALMS_LOAD_STATUS, rules),
        rules=rules,
    )
    cus, life = F.col("ll_cus"), F.col("ll_Life_Cycle_Seq")
    j = j.where(text_in(cus, C.LEG_CUSTOMER_CODES, rules) | cus.isNull())
    j = j.where(text_not_in(life, C.EXCLUDED_LIFE_CYCLES, rules) | life.isNull())
    j = without_foreign_legs(j, "ll_Loadleg_Id", tables.stops, rules)
    fmts = cfg.timestamp_formats
    # DISTINCT over the 23 columns the other five are computed from (all of
    # them output columns), then derive: same rows, narrower shuffle.
    base = {
        "Loadleg Tag": F.col("ll_Loadleg_tag"),
        "Load Tag": F.col("Load_Tag"),
        "Load Status": F.col("Status"),
        "Route Pattern": F.col("Rptn"),
        "Load ID": F.col("Load_ID"),
        "Route": F.col("ll_Route"),
        "Version": F.col("ll_Version"),
        "Leg": F.col("ll_Leg"),
        "Mode": F.col("ll_Mode"),
        "Loadleg ID": F.col("ll_Loadleg_Id"),
        "Trailer": F.col("ll_Trailer_1"),
        "Trailer 2": F.col("ll_Trailer_2"),
        "Load Start Time": D.safe_timestamp("ll_Start_Time", fmts),
        "Load End Time": D.safe_timestamp("ll_End_Time", fmts),
        "Estimated Start Time": D.safe_timestamp("ll_Est_Start_Time", fmts),
        "Life Cycle Sequence": life,
        "Status": F.col("ll_Status"),
        "Carrier Code": F.col("ll_Carrier_Code"),
        "Carrier Name": F.col("ll_Carrier_Name"),
        "Distance": dotted_int("ll_Distance"),
        "Year": F.col("ll_Year"),
        "Week": F.col("ll_Week"),
        "Load Legs Last Updated": F.col("ll_Last_update"),
    }
    rows = distinct_rows(j.select(*[c.alias(n) for n, c in base.items()]))
    route, version = F.col("Route"), F.col("Version")
    return rows.withColumns(
        {
            "Activity": R.activity_by_route(route, rules),
            "Route-Version": concat_text(route, C.KEY_DASH, version),
            "Route-Version-Leg": concat_text(route, C.KEY_DASH, version, C.KEY_DASH, F.col("Leg")),
            "Load End Date": D.date_of("Load End Time"),
            "Carrier": concat_text(F.col("Carrier Code"), C.KEY_SPACED_DASH, F.col("Carrier Name")),
        }
    )


def loads_alms_report(tables: TablesALMS, cfg: MartConfig = DEFAULT_CONFIG) -> DataFrame:
    """The ALMS loads report (31 columns) with load counts per route and carrier."""
    counts = {"Load Count Per Route": "Route", "Load Count Per Carrier": "Carrier Code"}
    rows = with_counts_by(alms_load_rows(tables, cfg), "Load ID", counts, cfg.text)
    rows = rows.withColumn("TMS", F.lit(C.TMS_ALMS))
    return rows.select(*[F.col(f"`{c}`") for c in LOADS_COLUMNS])


def order_legs_3g(tables: Tables3G, rules: TextRules = TextRules()) -> DataFrame:
    """Loads with the order legs whose first load leg they are, those legs' orders, clients and destinations.

    The joins that the source keeps as a comment. An order leg may travel
    with several load legs; the one with the lowest number names its load, so
    each order leg stands at one load at most. Loads without order legs keep
    one row, and so do legs without order, client or known destination.
    """
    first = first_per_key(tables.order_leg_load, "OrdLegId", "LegSeq")
    x = left_dim(tables.load.select("LoadId"), first, "LoadId", "LoadId", {"OrdLegId": "OrdLegId"})
    x = left_dim(x, tables.order_leg, "OrdLegId", "OrdLegId", {"OrdHeaderId": "__order"})
    order = {"OrdHeaderId": "OrdHeaderId", "TradingPartnerIdClient": "__client", "LocIdDest": "__dest"}
    x = left_dim(x, tables.order_header, "__order", "OrdHeaderId", order)
    x = role_join(
        x,
        tables.partner,
        "__client",
        "TradingPartnerId",
        "DataValue_TradingPartnerType",
        C.PARTNER_ROLE_CLIENT,
        {"TradingPartnerNum": "client_num"},
        rules,
    )
    x = left_dim(x, tables.loc, "__dest", "LocId", {"AddrName": "order_dest"})
    return x.select("LoadId", "OrdLegId", "OrdHeaderId", "client_num", "order_dest")
