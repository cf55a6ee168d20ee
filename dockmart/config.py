"""Business configuration of the receiving mart.

Everything a report needs to know about the customer, its plants and its
shifts lives here, so that the transforms stay generic. The values in the
block marked FIXED VALUES must equal the source reports' values for the
results to match; they are stated as plain text, in the order they appear
there.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# FIXED VALUES (must equal the source reports; do not reorder or rename)
# --------------------------------------------------------------------------

# Customer name used in location-name matching (prefix for "Is HUT Location",
# substring for the plant-delivery check of the 3G source).
CUSTOMER_NAME = "Hutchinson"
# Trading-partner number of the customer as a client (3G).
CUSTOMER_CLIENT_NUM = "HUT"

# 3G destination names -> business unit ("Activity"); anything else -> OTHER.
ACTIVITY_BY_DEST_NAME = {
    "Hutchinson AVS": "AVS",
    "Hutchinson Cadillac": "AVS",
    "Hutchinson FMS Wh": "FMS",
    "Hutchinson FMS": "FMS",
}
ACTIVITY_OTHER = "OTHER"
# ALMS route prefixes (first 3 characters) -> business unit; else NULL.
ACTIVITY_BY_ROUTE_PREFIX = {"AVS": "AVS", "FMS": "FMS"}
ROUTE_PREFIX_LENGTH = 3

# 3G load status -> active status of a stop; anything else -> Active.
ACTIVE_STATUS_BY_LOAD_STATUS = {
    "Delivered": "Completed",
    "Canceled": "Inactive",
    "TenderExpired": "Inactive",
}
ACTIVE_STATUS_DEFAULT = "Active"
# 3G load statuses dropped from both reports.
EXCLUDED_LOAD_STATUSES = ("TenderExpired", "Canceled")
# Constant status of every 3G load row.
LOAD_ROW_STATUS_3G = "Active"

# 3G stop types and trading-partner roles.
STOP_TYPE_PICKUP = "Pickup"
STOP_TYPE_DELIVERY = "Delivery"
PARTNER_ROLE_CLIENT = "Client"
PARTNER_ROLE_CARRIER = "Carrier"

# ALMS stop codes.
HUT_LOCATION_CODES = ("10", "10A", "11", "FMS", "AVS")  # "Is HUT Location"
DUNNAGE_PLANT_CODES = ("10", "10A", "11")  # freight direction
PLANT_DELIVERY_CODES = ("10", "11", "FMS", "AVS")  # plant-delivery check
# ALMS customer codes.
STOP_CUSTOMER_CODES = ("AVS", "HUT", "FMS")  # stops kept, plant check
LEG_CUSTOMER_CODES = ("AVS", "FMS")  # legs kept (or NULL)
CUSTOMER_GROUP_CODES = ("HUT", "AVS", "FMS")  # -> "HUT", else "OTHER"
CUSTOMER_GROUP_IN = "HUT"
CUSTOMER_GROUP_OUT = "OTHER"
# ALMS load status and leg life-cycle values dropped.
EXCLUDED_ALMS_LOAD_STATUS = "Adjusted"
EXCLUDED_LIFE_CYCLES = (
    "System Cancelled (4)",
    "ACA Cancelled (5)",
    "ACA Adjusted (6)",
    "ACA Rejected (7)",
)
# ALMS location type kept in the supplier lists (NULL type kept as well).
SUPPLIER_LOCATION_TYPE = "Supplier"

# Yes/No flags.
YES = "Yes"
NO = "No"

# Freight direction labels.
DIR_NONE = ""
DIR_DUNNAGE = "Dunnage"
DIR_FREIGHT = "Freight"
DIR_BOTH = "Dunnage/Freight"

# On-time bands, in the order they are tested.
BAND_OPEN = "Open"
BAND_MISSING = "Missing Time"
BAND_ON_TIME = "On-Time (+/- 30 Min.)"
BAND_EARLY = "Early by 31+ Min."
BAND_LATE_SHORT = "Late by 31 to 120 Min."
BAND_LATE_MEDIUM = "Late by 2 to 4 Hrs."
BAND_LATE_LONG = "Late by 4+ Hours"
ON_TIME_TOLERANCE_MIN = 30
LATE_SHORT_MAX_MIN = 120
LATE_MEDIUM_MAX_MIN = 240

# Inbound/outbound labels.
IO_NONE = ""
IO_BOTH = "IB/OB"
IO_OUT = "OB"
IO_IN = "IB"

# Days-missed bands.
MISSED_UNDER_1 = "Missed by Less Than 24 Hrs."
MISSED_1_2 = "Missed by 1-2 Days"
MISSED_3_4 = "Missed by 3-4 Days"
MISSED_5_6 = "Missed by 5-6 Days"
MISSED_7_PLUS = "Missed by 7+ Days"
MISSED_OPEN = "Open"
MISSED_ARRIVED = "Arrived"

# Shift id layout: crew letter + shift start as yyyyMMdd-HH.

# Crew rules. Weekdays are numbered Sunday=1 .. Saturday=7; times are
# inclusive bounds on the planned arrival's time of day; the shift starts
# `day_offset` days from the arrival's date at `start_hour`.
# (crew, weekdays, from, to, day_offset, start_hour)
CREW_RULES = (
    ("A", (2, 3, 4, 5), "06:00:00", "16:30:00", 0, 6),
    ("B", (3, 4, 5, 6), "18:00:00", "23:59:59", 0, 18),
    ("B", (4, 5, 6, 7), "00:00:00", "04:30:00", -1, 18),
    ("C", (6, 7), "06:00:00", "16:30:00", 0, 6),
    ("C", (1, 2), "18:00:00", "23:59:59", 0, 18),
    ("C", (2, 3), "00:00:00", "04:30:00", -1, 18),
)

# Source tags.
TMS_3G = "3G"
TMS_ALMS = "ALMS"

# Separator of the supplier / name / planner lists and of composite keys.
LIST_SEPARATOR = ", "
KEY_DASH = "-"
KEY_SPACED_DASH = " - "

# --------------------------------------------------------------------------
# end of FIXED VALUES
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class TextRules:
    """How text is compared.

    SQL Server's usual collation compares case-insensitively and ignores
    trailing blanks; Spark compares bytes. The default keeps Spark's exact
    comparison so that predicates reach the Parquet reader as pushed
    filters; ``TextRules.sql_server()`` switches every comparison the mart
    makes (equality, IN lists, LIKE, join keys) to the SQL Server rules.
    """

    case_insensitive: bool = False
    ignore_trailing_blanks: bool = False

    @staticmethod
    def sql_server() -> "TextRules":
        return TextRules(case_insensitive=True, ignore_trailing_blanks=True)

    @property
    def exact(self) -> bool:
        return not (self.case_insensitive or self.ignore_trailing_blanks)


@dataclass(frozen=True)
class MartConfig:
    """Knobs of the reports; defaults reproduce the source reports."""

    text: TextRules = field(default_factory=TextRules)
    # Lenient layouts tried after ISO when text is cast to a timestamp.
    timestamp_formats: tuple[str, ...] = (
        "M/d/yyyy[ H:mm[:ss]]",
        "yyyyMMdd[ H:mm[:ss]]",
    )
    # Late-by hours beyond DECIMAL(5,2): fail the query (as the source does)
    # or give NULL.
    late_hours_overflow_null: bool = False
    # Optional row cap of the 3G stops report (the source has TOP 1000
    # without an order); None keeps every row. When set, rows are taken in
    # (load, stop) order.
    stops_3g_limit: int | None = None
    # Optional route prefix whose stops get no crew (commented out in the
    # source); None keeps the source's live behaviour.
    crew_suppressed_route_prefix: str | None = None
    # Order the stops reports by (load/leg, stop) as the source's final ORDER BY
    # does for its BI import. Off by default: a global sort costs a range
    # shuffle plus a sampling pass over the whole input, and a written table
    # has no row order to keep.
    sort_reports: bool = False


DEFAULT_CONFIG = MartConfig()
