"""Physical-plan properties the design relies on."""

from __future__ import annotations

import contextlib
import io

import pytest

import __spark_entry__ as entry
from dockmart.operators.joins import not_in
from dockmart.queries import QUERIES
from harness import not_in_sql_form
from dockmart.plans import common, stops
from dockmart.sources import tables as T
from dockmart.sources.standin import as_of_stops
from test_reports_fixtures import ALMS_LEGS, ALMS_LOADS, ALMS_LOCATIONS, ALMS_STOPS

PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def plan(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@contextlib.contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


#: Queries that write tables first and return a read of them.
WRITTEN = ("loads_report_published", "stops_report_catalog")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(WRITTEN)))
def test_no_python_in_any_query(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir), "extended")
    assert "REPARTITION_BY" not in text, name  # no stand-in hides a shuffle behind one of its own
    assert not any(node in text for node in PYTHON_NODES), name


def test_not_in_does_not_broadcast_the_list(spark):
    left = spark.range(100).withColumnRenamed("id", "k")
    right = spark.range(50).withColumnRenamed("id", "x")
    with conf(spark, **{"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        ours = plan(not_in(left, "k", right, "x"))
        sql_form = plan(not_in_sql_form(left, "k", right, "x"))
    assert "SortMergeJoin" in ours and "LeftAnti" in ours
    assert "BroadcastHashJoin" not in ours and "BroadcastNestedLoopJoin" not in ours
    # Spark's own NOT IN always broadcasts the list, whatever the threshold.
    assert "BroadcastHashJoin" in sql_form or "BroadcastNestedLoopJoin" in sql_form


def test_customer_filter_reaches_the_parquet_scan(spark, scratch):
    from dockmart.sources import schemas as SC

    bundle = T.TablesALMS(
        loads=spark.createDataFrame(ALMS_LOADS, SC.LOAD_ALMS),
        legs=spark.createDataFrame(ALMS_LEGS, SC.LEG_ALMS),
        stops=spark.createDataFrame(ALMS_STOPS, SC.LEG_STOP_ALMS),
        locations=spark.createDataFrame(ALMS_LOCATIONS, SC.LOCATION_ALMS),
    )
    T.write_tables(bundle, scratch)
    tables = T.parquet_alms(spark, scratch)
    text = plan(stops.stops_alms_report(tables, as_of_stops()))
    assert "PushedFilters: [IsNotNull(cus), In(cus, [AVS,FMS,HUT])" in text or "In(cus, [AVS,FMS,HUT])" in text
    lists = plan(common.supplier_lists_alms(tables.stops, tables.locations))
    assert "ReadSchema: struct<Loadleg_ID:bigint,Stop_Code:string,cus:string>" in lists


def test_unused_bridge_joins_are_absent(spark, sf_dir):
    text = plan(entry.queries()["loads_report_3g"](spark, sf_dir))
    assert "part.parquet" not in text  # order header stand-in is never read
    scans = [line for line in text.splitlines() if "lineitem.parquet" in line]
    assert scans  # stops are read for the plant check only ...
    read = [line for line in text.splitlines() if line.strip().startswith("ReadSchema: struct<l_")]
    assert all("l_extendedprice" not in line for line in read)  # ... with only the needed columns


def test_group_totals_and_latest_need_no_window(spark, sf_dir):
    for name in ("count_per_route", "count_per_carrier", "latest_per_tag", "leg_includes_plant", "loads_report"):
        text = plan(entry.queries()[name](spark, sf_dir))
        assert "Window" not in text, name


def test_supplier_lists_aggregate_partially(spark, sf_dir):
    text = plan(entry.queries()["supplier_lists"](spark, sf_dir))
    assert "partial_collect_list" in text


def test_group_totals_reuse_the_distinct_shuffle(spark, sf_dir):
    df = entry.queries()["loads_report"](spark, sf_dir)
    qe = df._jdf.queryExecution()
    df.collect()
    final = qe.executedPlan().toString()
    assert "isFinalPlan=true" in final
    assert final.count("ReusedExchange") >= 2  # route and carrier totals read the DISTINCT's shuffle
    assert "ReusedSubquery" in final  # the NOT IN rule is computed once


NO_BROADCAST = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def _static_plan(spark, df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stop_table_is_read_twice(spark, sf_dir):
    """Once for the rows, once for the codes of each leg, which exclusion and lists share; a look for legs without an id is
    pushed to the reader."""
    with conf(spark, **NO_BROADCAST, **{"spark.sql.adaptive.enabled": "false"}):
        text = _static_plan(spark, entry.queries()["stops_report"](spark, sf_dir))
    scans = [line for line in text.splitlines() if "FileScan" in line and "l_orderkey" in line]
    whole = [line for line in scans if "isnull(l_orderkey" not in line]
    assert len(whole) == 2 and len(scans) == 3
    assert text.count("ReusedExchange") >= 2


def test_distinct_is_dealt_by_whole_rows_and_counts_take_one_aggregate(spark, sf_dir):
    with conf(spark, **NO_BROADCAST, **{"spark.sql.adaptive.enabled": "false"}):
        for name in ("stops_report", "loads_report"):
            assert "Exchange hashpartitioning(__row" in _static_plan(spark, entry.queries()[name](spark, sf_dir))
        text = _static_plan(spark, entry.queries()["loads_report"](spark, sf_dir))
    # one exchange for the totals of route and carrier, used again for the second
    assert sum("Exchange hashpartitioning(g#" in line and "Reused" not in line for line in text.splitlines()) == 1
    assert text.count("ReusedExchange [g#") == 1


def test_hot_leg_is_spread_over_tasks(spark):
    """A leg with a third of all rows, nothing broadcast: the DISTINCT of the report is not dealt by leg."""
    from pyspark.sql import functions as F

    from dockmart.sources import schemas as SC

    ids = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("leg"), "id")
    known = {"Loadleg_ID": F.col("leg"), "Stop_Seq": (F.col("id") % 100_000).cast("int"), "cus": F.lit("AVS"), "Stop_Code": F.lit("10"), "Is_Drop": F.lit(1)}
    columns = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SC.LEG_STOP_ALMS.fields]
    with conf(spark, **NO_BROADCAST, **{"spark.sql.adaptive.enabled": "false"}):
        rows = stops.alms_stop_rows(ids.select(*columns))
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]


def test_bucketed_stops_need_no_exchange_below_the_anti_join(spark, scratch):
    from dockmart.sources import schemas as SC

    bundle = T.TablesALMS(
        loads=spark.createDataFrame(ALMS_LOADS, SC.LOAD_ALMS),
        legs=spark.createDataFrame(ALMS_LEGS, SC.LEG_ALMS),
        stops=spark.createDataFrame(ALMS_STOPS, SC.LEG_STOP_ALMS),
        locations=spark.createDataFrame(ALMS_LOCATIONS, SC.LOCATION_ALMS),
    )
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucketed_test LOCATION 'file://{scratch}'")
    T.save_catalog(bundle, "bucketed_test", f"file://{scratch}", 16)
    with conf(spark, **NO_BROADCAST, **{"spark.sql.adaptive.enabled": "false"}):
        rows = stops.alms_stop_rows(T.catalog_alms(spark, "bucketed_test").stops)
        lines = _static_plan(spark, rows).splitlines()
        assert rows.count() == stops.alms_stop_rows(bundle.stops).count() > 0
    anti = next(i for i, line in enumerate(lines) if "LeftAnti" in line)
    scan = next(i for i, line in enumerate(lines) if i > anti and "FileScan" in line)
    assert not any("Exchange" in line for line in lines[anti:scan])
    spark.sql("DROP DATABASE bucketed_test CASCADE")


def test_a_failed_write_leaves_the_published_report(spark, scratch):
    from pyspark.sql import functions as F

    from dockmart.sources import sinks

    first = spark.range(5).withColumnRenamed("id", "Load ID")
    version = sinks.publish(first, scratch)
    with pytest.raises(Exception, match="broken"):
        sinks.publish(first.select(F.raise_error(F.concat(F.lit("broken "), F.col("Load ID").cast("string"))).alias("Load ID")), scratch)
    assert sinks.read_published(spark, scratch).count() == 5
    sinks.publish(spark.range(7).withColumnRenamed("id", "Load ID"), scratch)
    assert sinks.read_published(spark, scratch).count() == 7 and sinks.read_published(spark, scratch, version).count() == 5
