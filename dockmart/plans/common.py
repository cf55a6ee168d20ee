"""Steps shared by the loads and stops reports of each source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmart import config as C
from dockmart.config import TextRules
from dockmart.functions import rules as R
from dockmart.functions.text import text_eq, text_in
from dockmart.operators.aggregates import count_when, keys_without, ordered_lists
from dockmart.operators.joins import left_dim, not_in, trimmed_key_join


def loads_without_plant_delivery_3g(stop: DataFrame, loc: DataFrame, rules: TextRules = TextRules()) -> DataFrame:
    """3G loads with delivery stops, none of them at a customer location.

    ``SELECT s.LoadId FROM Stop s LEFT JOIN Loc ON s.LocId = loc.LocId
    WHERE type = 'Delivery' GROUP BY s.LoadId
    HAVING SUM(CASE WHEN AddrName LIKE '%<customer>%' THEN 1 ELSE 0 END) = 0``.
    A delivery whose location is unknown counts as foreign.
    """
    deliveries = stop.where(text_eq("DataValue_StopType", C.STOP_TYPE_DELIVERY, rules)).select("LoadId", "LocId")
    with_names = left_dim(deliveries, loc, "LocId", "LocId", {"AddrName": "__name"})
    return keys_without(with_names, "LoadId", F.lit(True), R.mentions_customer("__name", rules))


def legs_without_plant_delivery_alms(stops: DataFrame, rules: TextRules = TextRules()) -> DataFrame:
    """ALMS legs whose drop stops (customer stops only) include no plant code."""
    s = stops.where(text_in("cus", C.STOP_CUSTOMER_CODES, rules))
    return keys_without(s, "Loadleg_ID", F.col("Is_Drop") == 1, text_in("Stop_Code", C.PLANT_DELIVERY_CODES, rules))


def leg_codes_alms(stops: DataFrame, rules: TextRules = TextRules()) -> DataFrame:
    """(Loadleg_ID, Stop_Code, dropped): the codes of each leg's customer stops, and whether a drop is among them.

    The facts that both the plant-delivery exclusion and the supplier lists
    are made of, grouped once: ``dropped`` is an aggregate that both read, so
    both plans hold the same exchange and Spark runs it once.
    """
    s = stops.where(text_in("cus", C.STOP_CUSTOMER_CODES, rules) & F.col("Loadleg_ID").isNotNull())
    return s.groupBy("Loadleg_ID", "Stop_Code").agg(F.max(F.when(F.col("Is_Drop") == 1, 1).otherwise(0)).alias("dropped"))


def leg_drops_alms(codes: DataFrame, rules: TextRules = TextRules()) -> DataFrame:
    """(leg, dropped, hits) of :func:`leg_codes_alms`: whether a leg has drops, and how many codes of plants are dropped at.

    The leg is returned as an aggregate of itself: what a join infers about
    its key then stays above the aggregate, and all below is the same plan
    for every use.
    """
    hits = count_when((F.col("dropped") == 1) & text_in("Stop_Code", C.PLANT_DELIVERY_CODES, rules))
    found = codes.groupBy("Loadleg_ID").agg(F.max("dropped").alias("__dropped"), hits.alias("__hits"), F.max("Loadleg_ID").alias("__leg"))
    return found.select("__leg", "__dropped", "__hits")


def _is_foreign() -> Column:
    return (F.col("__dropped") == 1) & (F.col("__hits") == 0)


def foreign_legs_alms(codes: DataFrame, rules: TextRules = TextRules()) -> DataFrame:
    """Legs of :func:`leg_codes_alms` with drops, none of them at a plant (as ``legs_without_plant_delivery_alms``, without
    the NULL leg)."""
    return leg_drops_alms(codes, rules).where(_is_foreign()).select(F.col("__leg").alias("Loadleg_ID"))


#: Places of the marks of legs that stay: 32 MB in all, whatever the number of legs; and places that each leg marks.
MARKS = 1 << 28
_PLACES_PER_LEG = 4
_BITMAP = 1 << 15  # places in one of Spark's bitmaps


def _bitmap_number(leg: str) -> Column:
    return F.pmod(F.xxhash64(leg), F.lit(max(1, MARKS // _BITMAP)))


def _bit(leg: str, i: int) -> Column:
    """The ``i``-th place of a leg in its bitmap."""
    return F.shiftright(F.xxhash64(F.lit(1), leg), 15 * i).bitwiseAND(F.lit(min(_BITMAP, MARKS) - 1))


def _is_set(bitmap: str, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def _leg_marks(codes: DataFrame, rules: TextRules) -> DataFrame:
    """(__number, __marks): the places of legs that are not foreign, in bitmaps."""
    kept = leg_drops_alms(codes, rules).where(~_is_foreign())
    bits = F.explode(F.array(*[_bit("__leg", i) for i in range(_PLACES_PER_LEG)])).alias("__bit")
    places = kept.select(_bitmap_number("__leg").alias("__number"), bits)
    return places.groupBy("__number").agg(F.bitmap_construct_agg("__bit").alias("__marks"))


def _with_marks(rows: DataFrame, key: str, marks: DataFrame) -> DataFrame:
    """``rows`` whose leg has all its places marked, or that have no leg."""
    marked = F.lit(True)
    for i in range(_PLACES_PER_LEG):
        marked = marked & _is_set("__marks", _bit(key, i))
    found = rows.join(F.broadcast(marks), _bitmap_number(key) == F.col("__number"), "left")
    return found.where(F.col(key).isNull() | marked).drop("__number", "__marks")


def marked_legs(rows: DataFrame, key: str, codes: DataFrame, rules: TextRules = TextRules()) -> DataFrame:
    """``rows`` without most of the foreign legs, before anything wide is dealt by leg; rows without a leg stay.

    For rows of the stops that ``codes`` was made of: every leg among them
    must be in ``codes``. Each leg of ``codes`` that is not foreign marks
    some of ``MARKS`` places by its hash. The marks are small and of bounded
    size, so every task has them: a row with a place that has no mark belongs
    to a foreign leg. Foreign legs whose places other legs have marked stay
    for the exact test (:func:`doubtful_legs`).
    """
    return _with_marks(rows, key, _leg_marks(codes, rules))


def doubtful_legs(codes: DataFrame, rules: TextRules = TextRules()) -> DataFrame:
    """(__legs, __of): the foreign legs that :func:`marked_legs` leaves, one list a bitmap.

    Few as long as legs are fewer than places. The number of the bitmap is
    an aggregate, so that all uses share one exchange (see :func:`leg_drops_alms`).
    """
    foreign = leg_drops_alms(codes, rules).where(_is_foreign()).select("__leg")
    left = _with_marks(foreign, "__leg", _leg_marks(codes, rules)).where(F.col("__leg").isNotNull())
    found = left.groupBy(_bitmap_number("__leg").alias("__g")).agg(F.collect_list("__leg").alias("__legs"), F.max(_bitmap_number("__leg")).alias("__of"))
    return found.select("__legs", "__of")


def without_marked_foreign_legs(rows: DataFrame, key: str, stops: DataFrame, codes: DataFrame, rules: TextRules = TextRules()) -> DataFrame:
    """``rows WHERE key NOT IN (legs with drops, none at a plant)`` for rows of ``stops``: most by the marks, the rest by an anti join.

    A second set of marks says which rows may be in the list of doubtful legs
    at all. As the rows wait for it, the size of that list is measured before
    adaptive execution decides whether the rows are dealt by leg for the anti
    join; a list that is small by then is broadcast, and they are not.
    """
    doubtful = doubtful_legs(codes, rules)
    each = doubtful.where(F.col("__of") >= 0).select("__of", F.explode("__legs").alias("__leg"))  # reads the number, so that the plan is shared
    doubts = each.groupBy("__of").agg(F.bitmap_construct_agg(_bit("__leg", 0)).alias("__doubts"))
    s = marked_legs(rows, key, codes, rules)
    s = s.join(F.broadcast(doubts), _bitmap_number(key) == F.col("__of"), "left")
    s = s.withColumn("__doubt", F.coalesce(_is_set("__doubts", _bit(key, 0)), F.lit(False))).drop("__of", "__doubts")
    unnamed = legs_without_plant_delivery_alms(stops.where(F.col("Loadleg_ID").isNull()), rules)
    listed = foreign_legs_alms(codes, rules)
    kept = not_in(s, key, each.select("__leg"), "__leg", null_listed=unnamed, listed=listed, where=F.col("__doubt"))
    return kept.drop("__doubt")


def without_foreign_legs(rows: DataFrame, key: str, stops: DataFrame, rules: TextRules, codes: DataFrame | None = None) -> DataFrame:
    """``rows WHERE key NOT IN (legs with drops, none at a plant)``; ``codes``: ``leg_codes_alms(stops)``, if shared."""
    codes = leg_codes_alms(stops, rules) if codes is None else codes
    unnamed = legs_without_plant_delivery_alms(stops.where(F.col("Loadleg_ID").isNull()), rules)
    return not_in(rows, key, foreign_legs_alms(codes, rules), "Loadleg_ID", null_listed=unnamed)


def customer_stops_3g(tables, rules: TextRules = TextRules()) -> DataFrame:
    """Loads of the customer (client number) with their client number.

    ``Load LEFT JOIN Vw3g_Load_ClientAndCount LEFT JOIN TradingPartner ...
    WHERE clt.TradingPartnerNum = '<customer>'``: the WHERE rejects NULLs, so
    both joins are inner joins.
    """
    clients = tables.partner.where(R.client_is_customer("TradingPartnerNum", rules)).select(
        F.col("TradingPartnerId").alias("__client_id"), F.col("TradingPartnerNum").alias("client_num")
    )
    bridge = tables.load_client.select(F.col("LoadId").alias("__bridge_load"), "TradingPartnerIdClient")
    load_clients = bridge.join(clients, bridge["TradingPartnerIdClient"] == clients["__client_id"]).select(
        "__bridge_load", "client_num"
    )
    return load_clients


def supplier_lists_3g(tables, rules: TextRules = TextRules()) -> DataFrame:
    """3G supplier lists: pickup locations of the customer's loads, one row per load.

    Distinct (load number, location, name) tuples, then ordered ``STRING_AGG``
    lists of location ids and names.
    """
    load_clients = customer_stops_3g(tables, rules)
    loads = tables.load.select("LoadId", "LoadNum")
    pickups = tables.stop.where(text_eq("DataValue_StopType", C.STOP_TYPE_PICKUP, rules)).select(
        F.col("LoadId").alias("__stop_load"), "LocId"
    )
    rows = loads.join(pickups, loads["LoadId"] == pickups["__stop_load"]).join(
        load_clients, loads["LoadId"] == load_clients["__bridge_load"]
    )
    rows = left_dim(rows, tables.loc, "LocId", "LocId", {"AddrName": "Location Name"})
    tuples = rows.select(
        F.col("LoadNum").alias("Loadleg ID"), F.col("LocId").alias("Stop Location"), "Location Name"
    ).distinct()
    return ordered_lists(
        tuples,
        "Loadleg ID",
        {"Stop Location": "Supplier(s)", "Location Name": "Name(s)"},
        order_by=["Stop Location", "Location Name"],
    ).withColumn("Planner(s)", F.lit(None).cast("string"))


def supplier_lists_alms(
    stops: DataFrame, locations: DataFrame, rules: TextRules = TextRules(), codes: DataFrame | None = None
) -> DataFrame:
    """ALMS supplier lists: one row per leg with codes, names and planners.

    Customer stops joined to the location master on the trimmed code; only
    supplier locations or stops whose location is unknown or untyped are
    kept (the type test sits after the outer join). A code with two names
    appears twice, as the distinct is on the whole tuple. Repeated codes of a
    leg go before the join; rows without a leg, which no report can show, too.
    ``codes``: the leg's codes, where :func:`leg_codes_alms` has them already.
    """
    if codes is None:
        s = stops.where(text_in("cus", C.STOP_CUSTOMER_CODES, rules) & F.col("Loadleg_ID").isNotNull())
        s = s.select("Loadleg_ID", "Stop_Code").distinct()
    else:
        s = codes.where(F.col("dropped") >= 0).select("Loadleg_ID", "Stop_Code")  # reads the column, so that the plan is shared
    j = trimmed_key_join(
        s,
        locations,
        "Stop_Code",
        "Location_Code",
        {"Location_Name": "Location Name", "LE": "Planner", "LocationType": "__type"},
        rules,
    )
    j = j.where(text_eq("__type", C.SUPPLIER_LOCATION_TYPE, rules) | F.col("__type").isNull())
    tuples = j.select(
        F.col("Loadleg_ID").alias("Loadleg ID"),
        F.col("Stop_Code").alias("Stop Location"),
        "Location Name",
        "Planner",
    ).distinct()
    return ordered_lists(
        tuples,
        "Loadleg ID",
        {"Stop Location": "Supplier(s)", "Location Name": "Name(s)", "Planner": "Planner(s)"},
        order_by=["Stop Location", "Location Name", "Planner"],
    )
