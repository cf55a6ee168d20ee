"""Column rules on hand-made values: boundaries, NULLs and T-SQL semantics."""

from __future__ import annotations

from datetime import datetime, time, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from dockmart.config import MartConfig, TextRules
from dockmart.functions import dates as D
from dockmart.functions import rules as R
from dockmart.functions.text import concat_text, dotted_int, text_eq, text_in, text_startswith, trunc_int

NTZ = TimestampNTZType()


def _ts_frame(spark, values, name="ts"):
    return spark.createDataFrame([(v,) for v in values], StructType([StructField(name, NTZ, True)]))


# --- crew and shift: 7 days x boundary times ------------------------------------------

WEEK = [datetime(2025, 6, 15) + timedelta(days=i) for i in range(7)]  # Sunday .. Saturday
TIMES = [
    (0, 0, 0, 0), (4, 30, 0, 0), (4, 30, 0, 500000), (5, 0, 0, 0), (6, 0, 0, 0), (16, 30, 0, 0),
    (16, 30, 0, 500000), (17, 0, 0, 0), (18, 0, 0, 0), (23, 59, 59, 0), (23, 59, 59, 500000),
]


def _expected_crew(dt: datetime):
    """Table 2.11a of the survey, written out independently of CREW_RULES."""
    wd = dt.isoweekday() % 7 + 1  # Sunday=1
    t = dt.time()
    day = datetime(dt.year, dt.month, dt.day)

    def within(lo, hi):
        return time(*lo) <= t <= time(*hi)

    if wd in (2, 3, 4, 5) and within((6, 0), (16, 30)):
        return "A", day + timedelta(hours=6)
    if wd in (3, 4, 5, 6) and within((18, 0), (23, 59, 59)):
        return "B", day + timedelta(hours=18)
    if wd in (4, 5, 6, 7) and within((0, 0), (4, 30)):
        return "B", day - timedelta(days=1) + timedelta(hours=18)
    if wd in (6, 7) and within((6, 0), (16, 30)):
        return "C", day + timedelta(hours=6)
    if wd in (1, 2) and within((18, 0), (23, 59, 59)):
        return "C", day + timedelta(hours=18)
    if wd in (2, 3) and within((0, 0), (4, 30)):
        return "C", day - timedelta(days=1) + timedelta(hours=18)
    return None, None


def test_crew_and_shift_grid(spark):
    stamps = [d.replace(hour=h, minute=m, second=s, microsecond=us) for d in WEEK for h, m, s, us in TIMES]
    df = _ts_frame(spark, stamps + [None])
    out = df.select(
        "ts",
        R.crew("ts").alias("crew"),
        R.shift_start("ts").alias("start"),
        R.shift_id(R.crew("ts"), R.shift_start("ts")).alias("sid"),
    ).collect()
    assert len(out) == len(stamps) + 1
    for row in out:
        if row.ts is None:
            assert (row.crew, row.start, row.sid) == (None, None, None)
            continue
        crew, start = _expected_crew(row.ts)
        assert row.crew == crew, row.ts
        assert row.start == start, row.ts
        assert row.sid == (None if crew is None else crew + start.strftime("%Y%m%d-%H"))
        assert (row.crew is None) == (row.start is None)


def test_crew_suppressed_route(spark):
    df = spark.createDataFrame(
        [(datetime(2025, 6, 16, 7, 0), "DMSDL12"), (datetime(2025, 6, 16, 7, 0), "AVS1")],
        "ts timestamp_ntz, route string",
    )
    out = df.select(R.crew("ts", "route", "DMSDL").alias("c")).collect()
    assert [r.c for r in out] == [None, "A"]


# --- minute and day differences ------------------------------------------------------------


def test_minute_diff_counts_boundaries(spark):
    df = spark.createDataFrame(
        [
            (datetime(2025, 6, 10, 16, 30, 59), datetime(2025, 6, 10, 16, 31, 1), 1),
            (datetime(2025, 6, 10, 16, 30, 0), datetime(2025, 6, 10, 16, 30, 59), 0),
            (datetime(2025, 6, 10, 23, 59, 59), datetime(2025, 6, 11, 0, 0, 0), 1),
            (datetime(2025, 6, 11, 0, 0, 0), datetime(2025, 6, 10, 23, 59, 59), -1),
            (datetime(2024, 2, 28, 12, 0), datetime(2024, 3, 1, 12, 0), 2880),
        ],
        "a timestamp_ntz, b timestamp_ntz, want int",
    )
    for r in df.select(D.minute_diff("a", "b").alias("d"), "want").collect():
        assert r.d == r.want


def test_day_diff_counts_midnights(spark):
    df = spark.createDataFrame(
        [(datetime(2025, 6, 10, 23, 59), datetime(2025, 6, 11, 0, 1), 1)], "a timestamp_ntz, b timestamp_ntz, w int"
    )
    assert df.select(D.day_diff("a", "b").alias("d")).first().d == 1


# --- on-time bands -------------------------------------------------------------------------

AS_OF = datetime(2025, 6, 20, 12, 0)


@pytest.mark.parametrize(
    "delta,band",
    [
        (-31, "Early by 31+ Min."),
        (-30, "On-Time (+/- 30 Min.)"),
        (0, "On-Time (+/- 30 Min.)"),
        (30, "On-Time (+/- 30 Min.)"),
        (31, "Late by 31 to 120 Min."),
        (120, "Late by 31 to 120 Min."),
        (121, "Late by 2 to 4 Hrs."),
        (240, "Late by 2 to 4 Hrs."),
        (241, "Late by 4+ Hours"),
    ],
)
def test_on_time_bands(spark, delta, band):
    planned = datetime(2025, 6, 10, 8, 0)
    df = spark.createDataFrame([(planned, planned + timedelta(minutes=delta))], "p timestamp_ntz, a timestamp_ntz")
    got = df.select(R.on_time_band("p", "a", F.lit(AS_OF).cast(NTZ)).alias("b")).first().b
    assert got == band


def test_on_time_open_missing_and_null(spark):
    rows = [
        (datetime(2025, 6, 21, 8, 0), None, "Open"),  # planned after as_of
        (datetime(2025, 6, 20, 12, 0, 30), None, "Open"),  # same minute as as_of
        (datetime(2025, 6, 19, 8, 0), None, "Missing Time"),
        (None, datetime(2025, 6, 19, 8, 0), None),
        (None, None, None),
    ]
    df = spark.createDataFrame(rows, "p timestamp_ntz, a timestamp_ntz, want string")
    for r in df.select(R.on_time_band("p", "a", F.lit(AS_OF).cast(NTZ)).alias("b"), "want").collect():
        assert r.b == r.want


# --- late hours ----------------------------------------------------------------------------


def test_late_hours_values(spark):
    p = datetime(2025, 6, 10, 8, 0)
    df = spark.createDataFrame(
        [(p, p + timedelta(minutes=90)), (p, p - timedelta(minutes=90)), (p, None), (p, p + timedelta(minutes=1))],
        "p timestamp_ntz, e timestamp_ntz",
    )
    got = [r.h for r in df.select(R.late_hours("p", "e").alias("h")).collect()]
    assert got == [Decimal("1.50"), Decimal("0.00"), None, Decimal("0.02")]
    assert dict(df.select(R.late_hours("p", "e").alias("h")).dtypes)["h"] == "decimal(5,2)"


def test_late_hours_overflow(spark):
    p = datetime(2025, 1, 1)
    df = spark.createDataFrame([(p, p + timedelta(hours=1000))], "p timestamp_ntz, e timestamp_ntz")
    assert df.select(R.late_hours("p", "e", overflow_null=True).alias("h")).first().h is None
    with pytest.raises(Exception):
        df.select(R.late_hours("p", "e").alias("h")).collect()


def test_late_display(spark):
    df = spark.createDataFrame(
        [(None, Decimal("0.00"), "Open"), (datetime(2025, 1, 1), Decimal("1.50"), "On-Time (+/- 30 Min.)")],
        "a timestamp_ntz, h decimal(5,2), band string",
    )
    out = df.select(
        R.late_hours_while_open("a", "h").alias("o"), R.lateness_display("a", "h", "band").alias("v")
    ).collect()
    assert (out[0].o, out[0].v) == (Decimal("0.00"), "0.00")
    assert (out[1].o, out[1].v) == (None, "On-Time (+/- 30 Min.)")


# --- week start, names, parsing ------------------------------------------------------------------


def test_week_start_monday(spark):
    df = _ts_frame(spark, [datetime(2025, 6, 15, 10), datetime(2025, 6, 16, 0), datetime(2025, 6, 21, 23)])
    got = [r.w for r in df.select(D.week_start("ts").alias("w")).collect()]
    assert got == [datetime(2025, 6, 9), datetime(2025, 6, 16), datetime(2025, 6, 16)]


def test_weekday_name_and_number(spark):
    df = _ts_frame(spark, [datetime(2025, 6, 15, 10)])
    r = df.select(D.weekday_name("ts").alias("n"), D.weekday_number("ts").alias("d")).first()
    assert (r.n, r.d) == ("Sunday", 1)


def test_safe_timestamp_layouts(spark):
    fmts = MartConfig().timestamp_formats
    values = [
        ("2025-06-10 14:00:05", datetime(2025, 6, 10, 14, 0, 5)),
        ("06/10/2025 14:00", datetime(2025, 6, 10, 14, 0)),
        ("6/1/2025", datetime(2025, 6, 1)),
        ("20250610", datetime(2025, 6, 10)),
        ("", None),
        ("garbage", None),
        ("TBD", None),
        (None, None),
    ]
    df = spark.createDataFrame(values, StructType([StructField("x", StringType()), StructField("w", NTZ)]))
    for r in df.select(D.safe_timestamp("x", fmts).alias("t"), "w").collect():
        assert r.t == r.w
    r = spark.createDataFrame([("2025-06-10 14:00:05",)], "x string").select(
        D.date_of(D.safe_timestamp("x")).alias("d"), D.time_text(D.safe_timestamp("x")).alias("t")
    ).first()
    assert (str(r.d), r.t) == ("2025-06-10", "14:00:05")


# --- text and numbers -------------------------------------------------------------------------


def test_dotted_int(spark):
    df = spark.createDataFrame([("1.234",), ("",), ("abc",), (None,), ("12",)], "x string")
    assert [r.i for r in df.select(dotted_int("x").alias("i")).collect()] == [1234, None, None, None, 12]
    with pytest.raises(Exception):
        spark.createDataFrame([("abc",)], "x string").select(dotted_int("x", strict=True)).collect()


def test_trunc_int(spark):
    df = spark.createDataFrame([(12.7,), (-12.7,)], "x double")
    assert [r.i for r in df.select(trunc_int("x").alias("i")).collect()] == [12, -12]


def test_concat_treats_null_as_empty(spark):
    df = spark.createDataFrame([("R1", None, 3)], "a string, b string, n int")
    r = df.select(concat_text(F.col("a"), "-", F.col("b"), "-", F.col("n")).alias("k")).first()
    assert r.k == "R1--3"


def test_freight_direction_flag_combinations(spark):
    rows = [
        (0, 0, "S1", ""), (1, 1, "S1", "Dunnage/Freight"), (1, 0, "10", "Dunnage"), (1, 0, "S1", "Freight"),
        (0, 1, "11", "Freight"), (0, 1, "FMS", "Dunnage"), (None, None, "S1", ""), (None, 0, "S1", None),
        (None, 1, "10A", "Freight"),
    ]
    df = spark.createDataFrame(rows, "p int, d int, code string, want string")
    for r in df.select(R.freight_direction_by_flags("p", "d", "code").alias("x"), "want").collect():
        assert r.x == r.want


def test_freight_direction_by_type(spark):
    rows = [
        ("Pickup", "Hutchinson AVS", "Dunnage"), ("Pickup", "Acme", "Freight"), ("Pickup", None, "Freight"),
        ("Delivery", "Hutchinson FMS", "Freight"), ("Delivery", "Acme", "Dunnage"), ("Transfer", "X", ""),
        (None, "X", None),
    ]
    df = spark.createDataFrame(rows, "t string, n string, want string")
    for r in df.select(R.freight_direction_by_type("t", "n").alias("x"), "want").collect():
        assert r.x == r.want


def test_in_out_and_days_missed(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (None, None)], "p int, d int")
    assert [r.x for r in df.select(R.in_out_label("p", "d").alias("x")).collect()] == ["IB/OB", "OB", "IB", "", ""]
    bands = spark.createDataFrame(
        [("Missing Time", 0), ("Missing Time", 2), ("Missing Time", 8), ("Open", 1), (None, 1), ("Late by 4+ Hours", 1)],
        "b string, n int",
    )
    got = [r.x for r in bands.select(R.days_missed("b", "n").alias("x")).collect()]
    assert got == ["Missed by Less Than 24 Hrs.", "Missed by 1-2 Days", "Missed by 7+ Days", "Open", "Arrived", "Arrived"]


def test_sql_server_text_rules(spark):
    rules = TextRules.sql_server()
    df = spark.createDataFrame([("hut  ",), ("HUT",), ("hutx",), (None,)], "x string")
    assert [r.e for r in df.select(text_eq("x", "HUT", rules).alias("e")).collect()] == [True, True, False, None]
    assert [r.e for r in df.select(text_in("x", ["Hut"], rules).alias("e")).collect()] == [True, True, False, None]
    exact = [r.e for r in df.select(text_eq("x", "HUT").alias("e")).collect()]
    assert exact == [False, True, False, None]
    names = spark.createDataFrame([("HUTCHINSON Annex",)], "n string")
    assert names.select(text_startswith("n", "Hutchinson", rules).alias("s")).first().s is True
    assert names.select(text_startswith("n", "Hutchinson").alias("s")).first().s is False


def test_value_maps(spark):
    df = spark.createDataFrame([("Hutchinson Cadillac", "FMS123", "Canceled"), ("Other", "XYZ", "Open")],
                               "n string, r string, s string")
    out = df.select(
        R.activity_by_destination("n").alias("a"), R.activity_by_route("r").alias("b"), R.active_status("s").alias("c")
    ).collect()
    assert (out[0].a, out[0].b, out[0].c) == ("AVS", "FMS", "Inactive")
    assert (out[1].a, out[1].b, out[1].c) == ("OTHER", None, "Active")


def test_text_rules_reach_every_comparison(spark):
    from dockmart import config as C
    from dockmart.operators.aggregates import with_group_totals
    from dockmart.operators.joins import left_join_on

    rules = TextRules.sql_server()
    name, unit = next(iter(C.ACTIVITY_BY_DEST_NAME.items()))
    status, state = next(iter(C.ACTIVE_STATUS_BY_LOAD_STATUS.items()))
    df = spark.createDataFrame([("PICKUP ", name.lower() + " ", status.upper() + " ", "ab1")], "t string, n string, s string, k string")
    row = df.select(
        R.stop_type_flag("t", C.STOP_TYPE_PICKUP, rules).alias("flag"),
        R.freight_direction_by_type("t", "n", rules).alias("direction"),
        R.activity_by_destination("n", rules).alias("unit"),
        R.active_status("s", rules).alias("state"),
        R.stop_type_flag("t", C.STOP_TYPE_PICKUP).alias("exact"),
    ).first()
    assert (row.flag, row.unit, row.state, row.exact) == (1, unit, state, 0)
    assert row.direction in (C.DIR_DUNNAGE, C.DIR_FREIGHT)
    other = spark.createDataFrame([("AB1 ", 5)], "rk string, v int")
    assert left_join_on(df, other, [("k", "rk")], rules=rules).first().v == 5
    assert left_join_on(df, other, [("k", "rk")]).first().v is None
    keys = spark.createDataFrame([("a", 1), ("A ", 2), (None, 3)], "k string, id int")
    assert {r.id: r.n for r in with_group_totals(keys, ["k"], rules=rules, n=F.count("id")).collect()} == {1: 2, 2: 2, 3: 1}
