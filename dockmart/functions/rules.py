"""Business rules of the receiving mart as column expressions.

Each rule takes columns and returns a column; the reports compose them with
``select``/``withColumns``. No Python runs per row: every rule is a chain of
``when`` over built-in expressions.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockmart import config as C
from dockmart.config import TextRules
from dockmart.functions import dates
from dockmart.functions.text import col, ColumnOrName, concat_text, text_contains, text_eq, text_in, text_not_in, text_startswith

_ZERO_HOURS = Decimal("0.00")


# --- value maps -------------------------------------------------------------


def value_map(c: ColumnOrName, mapping: dict[str, object], default: object = None, rules: TextRules = TextRules()) -> Column:
    """``CASE x WHEN k THEN v ... [ELSE default] END`` over text."""
    out = None
    for key, value in mapping.items():
        hit = text_eq(c, key, rules)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    if default is not None:
        out = out.otherwise(F.lit(default))
    return out


def activity_by_destination(dest_name: ColumnOrName, rules: TextRules = TextRules()) -> Column:
    """3G business unit from the destination name (else OTHER)."""
    return value_map(dest_name, C.ACTIVITY_BY_DEST_NAME, C.ACTIVITY_OTHER, rules)


def activity_by_route(route: ColumnOrName, rules: TextRules = TextRules()) -> Column:
    """ALMS business unit from the route's first letters (else NULL)."""
    return value_map(F.left(col(route), F.lit(C.ROUTE_PREFIX_LENGTH)), C.ACTIVITY_BY_ROUTE_PREFIX, rules=rules)


def active_status(load_status: ColumnOrName, rules: TextRules = TextRules()) -> Column:
    """3G load status -> Completed / Inactive / Active."""
    return value_map(load_status, C.ACTIVE_STATUS_BY_LOAD_STATUS, C.ACTIVE_STATUS_DEFAULT, rules)


def customer_group(cus: ColumnOrName, rules: TextRules = TextRules()) -> Column:
    """ALMS customer code -> HUT or OTHER."""
    return F.when(text_in(cus, C.CUSTOMER_GROUP_CODES, rules), F.lit(C.CUSTOMER_GROUP_IN)).otherwise(
        F.lit(C.CUSTOMER_GROUP_OUT)
    )


# --- plant and direction --------------------------------------------------------


def is_customer_location_name(name: ColumnOrName, rules: TextRules = TextRules()) -> Column:
    """3G: the location name starts with the customer name (NULL name -> false)."""
    return text_startswith(name, C.CUSTOMER_NAME, rules)


def mentions_customer(name: ColumnOrName, rules: TextRules = TextRules()) -> Column:
    """3G plant-delivery test: the name contains the customer name."""
    return text_contains(name, C.CUSTOMER_NAME, rules)


def plant_flag_by_name(name: ColumnOrName, rules: TextRules = TextRules()) -> Column:
    """3G ``Is HUT Location``: Yes/No."""
    return F.when(is_customer_location_name(name, rules), F.lit(C.YES)).otherwise(F.lit(C.NO))


def plant_flag_by_code(code: ColumnOrName, rules: TextRules = TextRules()) -> Column:
    """ALMS ``Is HUT Location``: Yes/No."""
    return F.when(text_in(code, C.HUT_LOCATION_CODES, rules), F.lit(C.YES)).otherwise(F.lit(C.NO))


def stop_type_flag(stop_type: ColumnOrName, value: str, rules: TextRules = TextRules()) -> Column:
    """3G ``CASE type WHEN value THEN 1 ELSE 0 END``."""
    return F.when(text_eq(stop_type, value, rules), F.lit(1)).otherwise(F.lit(0))


def freight_direction_by_type(stop_type: ColumnOrName, loc_name: ColumnOrName, rules: TextRules = TextRules()) -> Column:
    """3G freight direction from the stop type and the location name.

    Other types -> ''; pickup at the customer -> Dunnage, else Freight;
    delivery at the customer -> Freight, else Dunnage; NULL type -> NULL.
    """
    at_plant = is_customer_location_name(loc_name, rules)
    pickup = text_eq(stop_type, C.STOP_TYPE_PICKUP, rules)
    delivery = text_eq(stop_type, C.STOP_TYPE_DELIVERY, rules)
    return (
        F.when(text_not_in(stop_type, (C.STOP_TYPE_PICKUP, C.STOP_TYPE_DELIVERY), rules), F.lit(C.DIR_NONE))
        .when(pickup & at_plant, F.lit(C.DIR_DUNNAGE))
        .when(pickup, F.lit(C.DIR_FREIGHT))
        .when(delivery & at_plant, F.lit(C.DIR_FREIGHT))
        .when(delivery, F.lit(C.DIR_DUNNAGE))
    )


def freight_direction_by_flags(
    is_pick: ColumnOrName, is_drop: ColumnOrName, code: ColumnOrName, rules: TextRules = TextRules()
) -> Column:
    """ALMS freight direction from the pick/drop flags and the stop code."""
    p, d = col(is_pick), col(is_drop)
    at_dock = text_in(code, C.DUNNAGE_PLANT_CODES, rules)
    return (
        F.when((p == 0) & (d == 0), F.lit(C.DIR_NONE))
        .when((p == 1) & (d == 1), F.lit(C.DIR_BOTH))
        .when((p == 1) & at_dock, F.lit(C.DIR_DUNNAGE))
        .when(p == 1, F.lit(C.DIR_FREIGHT))
        .when((d == 1) & at_dock, F.lit(C.DIR_FREIGHT))
        .when(d == 1, F.lit(C.DIR_DUNNAGE))
        .when(p.isNull() & d.isNull(), F.lit(C.DIR_NONE))
    )


def in_out_label(is_pick: ColumnOrName, is_drop: ColumnOrName) -> Column:
    """Inbound/outbound label from the pick/drop flags."""
    p, d = col(is_pick), col(is_drop)
    return (
        F.when((p == 0) & (d == 0), F.lit(C.IO_NONE))
        .when((p == 1) & (d == 1), F.lit(C.IO_BOTH))
        .when(p == 1, F.lit(C.IO_OUT))
        .when(d == 1, F.lit(C.IO_IN))
        .when(p.isNull() & d.isNull(), F.lit(C.IO_NONE))
    )


# --- crew and shift ------------------------------------------------------------


def _rule_hits(arrival: Column, weekdays: tuple[int, ...], start: str, end: str) -> Column:
    return dates.weekday_number(arrival).isin(list(weekdays)) & dates.time_between(arrival, start, end)


def crew(
    arrival: ColumnOrName,
    route: ColumnOrName | None = None,
    suppressed_prefix: str | None = None,
    rules: TextRules = TextRules(),
) -> Column:
    """Crew A/B/C receiving a stop planned to arrive at ``arrival``.

    Rules come from :data:`dockmart.config.CREW_RULES`; times and days not
    covered give NULL. With ``suppressed_prefix``, routes starting with it get
    NULL first (a rule the source keeps commented out).
    """
    a = col(arrival)
    out = None
    if suppressed_prefix is not None and route is not None:
        out = F.when(text_startswith(route, suppressed_prefix, rules), F.lit(None).cast("string"))
    for name, weekdays, start, end, _offset, _hour in C.CREW_RULES:
        hit = _rule_hits(a, weekdays, start, end)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out


def shift_start(arrival: ColumnOrName) -> Column:
    """Start of the shift receiving the stop (``timestamp_ntz``) or NULL."""
    a = col(arrival)
    out = None
    for _name, weekdays, start, end, offset, hour in C.CREW_RULES:
        hit = _rule_hits(a, weekdays, start, end)
        value = dates.add_hours(dates.midnight(a, offset), hour)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def shift_id(crew_col: ColumnOrName, shift_start_col: ColumnOrName) -> Column:
    """``NULLIF(CONCAT(crew, FORMAT(start, 'yyyyMMdd-HH')), '')``."""
    start = col(shift_start_col)
    stamp = F.concat(
        dates.padded(F.year(start), 4), dates.padded(F.month(start)), dates.padded(F.dayofmonth(start)),
        F.lit("-"), dates.padded(F.hour(start)),
    )
    return F.nullif(concat_text(col(crew_col), stamp), F.lit(""))


# --- lateness ------------------------------------------------------------------


def late_hours_raw(planned: ColumnOrName, estimated: ColumnOrName, overflow_null: bool = False) -> Column:
    """``CAST(DATEDIFF(MINUTE, p, e) / 60.0 AS DECIMAL(5,2))`` (may be negative).

    Beyond 999.99 h the cast fails (as the source does) unless
    ``overflow_null``, which gives NULL instead.
    """
    ratio = dates.minute_diff(planned, estimated) / F.lit(Decimal("60.0"))
    return ratio.try_cast("decimal(5,2)") if overflow_null else ratio.cast("decimal(5,2)")


def late_hours(planned: ColumnOrName, estimated: ColumnOrName, overflow_null: bool = False) -> Column:
    """Hours the estimate is after the plan, DECIMAL(5,2), negatives -> 0."""
    return clamp_at_zero(late_hours_raw(planned, estimated, overflow_null))


def clamp_at_zero(hours: Column) -> Column:
    """``CASE WHEN h < 0.0 THEN 0.0 ELSE h END`` (NULL stays NULL)."""
    return F.when(hours < F.lit(_ZERO_HOURS), F.lit(_ZERO_HOURS)).otherwise(hours).cast("decimal(5,2)")


def on_time_band(planned: ColumnOrName, actual: ColumnOrName, as_of: Column | None = None) -> Column:
    """On-time band of a departure (first match wins).

    No actual or no planned time: Open while the plan is not past ``as_of``
    (in minutes), Missing Time after. Otherwise by the signed minute
    difference d: |d| <= 30 on time, d < -30 early, then three late bands.
    Planned NULL gives NULL.
    """
    now = as_of if as_of is not None else dates.now_local()
    d = dates.minute_diff(planned, actual)
    ad = F.abs(d)
    to_now = dates.minute_diff(planned, now)
    return (
        F.when(ad.isNull() & (to_now <= 0), F.lit(C.BAND_OPEN))
        .when(ad.isNull() & (to_now > 0), F.lit(C.BAND_MISSING))
        .when(ad.between(0, C.ON_TIME_TOLERANCE_MIN), F.lit(C.BAND_ON_TIME))
        .when(d < -C.ON_TIME_TOLERANCE_MIN, F.lit(C.BAND_EARLY))
        .when(ad.between(C.ON_TIME_TOLERANCE_MIN + 1, C.LATE_SHORT_MAX_MIN), F.lit(C.BAND_LATE_SHORT))
        .when(ad.between(C.LATE_SHORT_MAX_MIN + 1, C.LATE_MEDIUM_MAX_MIN), F.lit(C.BAND_LATE_MEDIUM))
        .when(ad > C.LATE_MEDIUM_MAX_MIN, F.lit(C.BAND_LATE_LONG))
    )


def late_hours_while_open(actual: ColumnOrName, hours: ColumnOrName) -> Column:
    """Late-by hours only while the stop has not departed."""
    return F.when(col(actual).isNull(), col(hours))


def lateness_display(actual: ColumnOrName, hours: ColumnOrName, band: ColumnOrName) -> Column:
    """Late-by hours as text while open, the on-time band once departed."""
    return F.when(col(actual).isNull(), col(hours).cast("string")).otherwise(col(band).cast("string"))


def days_missed(band: ColumnOrName, days_since: ColumnOrName) -> Column:
    """Days-missed bands of stops whose time is missing."""
    b, n = col(band), col(days_since)
    missed = (
        F.when(n < 1, F.lit(C.MISSED_UNDER_1))
        .when(n.between(1, 2), F.lit(C.MISSED_1_2))
        .when(n.between(3, 4), F.lit(C.MISSED_3_4))
        .when(n.between(5, 6), F.lit(C.MISSED_5_6))
        .when(n >= 7, F.lit(C.MISSED_7_PLUS))
    )
    return (
        F.when(b == F.lit(C.BAND_MISSING), missed)
        .when(b == F.lit(C.BAND_OPEN), F.lit(C.MISSED_OPEN))
        .otherwise(F.lit(C.MISSED_ARRIVED))
    )


def client_is_customer(partner_num: ColumnOrName, rules: TextRules = TextRules()) -> Column:
    """3G: the load's client is the customer."""
    return text_eq(partner_num, C.CUSTOMER_CLIENT_NUM, rules)
