"""Batch job: build one report from one source system and publish it.

    spark-submit dockmart/jobs.py --system alms --report stops \\
        --input /data/alms --output /marts/stops_alms [--as-of 2025-06-20T12:00:00]

(or ``python -m dockmart.jobs ...`` with a local session).

``--input`` is a folder of ``<TableName>/`` Parquet folders, or ``--catalog
DB`` reads the tables from a catalog database (the source's ``USE <db>``).
The session comes from the cluster configuration; only the SQL settings the
mart relies on are applied (see :func:`dockmart.session.apply_runtime_conf`).
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

if not __package__:  # started as a script: its own folder is on the path, the package's is not
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from dockmart.config import MartConfig, TextRules
from dockmart.functions.dates import NTZ
from dockmart.plans.loads import loads_3g_report, loads_alms_report
from dockmart.plans.stops import stops_3g_report, stops_alms_report
from dockmart.session import apply_runtime_conf
from dockmart.sources import tables as T
from dockmart.sources.sinks import publish, write_report


def build(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    cfg = MartConfig(
        text=TextRules.sql_server() if args.sql_server_text else TextRules(),
        sort_reports=args.sort,
        stops_3g_limit=args.limit,
    )
    as_of = F.lit(datetime.fromisoformat(args.as_of)).cast(NTZ) if args.as_of else None
    if args.system == "3g":
        tables = T.catalog_3g(spark, args.catalog) if args.catalog else T.parquet_3g(spark, args.input)
        return loads_3g_report(tables, cfg) if args.report == "loads" else stops_3g_report(tables, as_of, cfg)
    tables = T.catalog_alms(spark, args.catalog) if args.catalog else T.parquet_alms(spark, args.input)
    return loads_alms_report(tables, cfg) if args.report == "loads" else stops_alms_report(tables, as_of, cfg)


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="dockmart.jobs", description=__doc__.splitlines()[0])
    p.add_argument("--system", choices=["3g", "alms"], required=True)
    p.add_argument("--report", choices=["loads", "stops"], required=True)
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--input", help="folder of <TableName>/ Parquet folders")
    src.add_argument("--catalog", help="catalog database holding the source tables")
    p.add_argument("--output", required=True, help="Parquet folder, or table name with --as-table")
    p.add_argument("--as-table", action="store_true")
    p.add_argument("--as-of", help="the reports' 'now' (ISO timestamp); default: query time")
    p.add_argument("--sql-server-text", action="store_true", help="case- and trailing-blank-insensitive text")
    p.add_argument("--sort", action="store_true", help="order the stops report as the source does")
    p.add_argument("--limit", type=int, default=None, help="row cap of the 3G stops report (ordered)")
    p.add_argument("--partition-by", action="append", default=[])
    p.add_argument("--publish", action="store_true", help="write a new version under --output and make it the current one")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parse(argv)
    spark = spark or SparkSession.builder.appName(f"dockmart-{args.system}-{args.report}").getOrCreate()
    apply_runtime_conf(spark)
    if args.publish:
        publish(build(spark, args), args.output, args.partition_by)
        return
    write_report(build(spark, args), args.output, partition_by=args.partition_by, as_table=args.as_table)


if __name__ == "__main__":
    main()
