"""Publishing a report (the source's result set imported by the BI tool)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(
    report: DataFrame,
    target: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    as_table: bool = False,
) -> None:
    """Write a report to a Parquet folder or, with ``as_table``, a catalog table.

    ``partition_by`` (for example ``["Planned Departure Date"]``) lets readers
    prune by day; the report's column names contain blanks and brackets,
    which Parquet and catalogs accept as they are. The rows of a partition are
    brought together first, so that not every task writes a file into every
    folder; adaptive execution splits a large partition over several tasks and
    joins small ones.
    """
    if partition_by:
        report = report.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
    writer = report.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if as_table:
        writer.saveAsTable(target)
    else:
        writer.parquet(target)


_LOG = "version string, published timestamp_ntz"


def publish(report: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write a report as a new version under ``root`` and then make it the current one; returns its name.

    A version is a folder of its own that is never written again. It becomes
    current by one row appended to ``<root>/log`` after all of it is there,
    so a reader sees the version before or the whole new one, and a write
    that fails changes nothing. Old versions stay until someone deletes them.
    """
    now = datetime.now(UTC).replace(tzinfo=None)
    version = f"{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    write_report(report, f"{root.rstrip('/')}/versions/{version}", mode="errorifexists", partition_by=partition_by)
    row = report.sparkSession.createDataFrame([(version, now)], _LOG)
    row.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/log")
    return version


def read_published(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The current version of a published report, or the named one."""
    if version is None:
        log = spark.read.schema(_LOG).parquet(f"{root.rstrip('/')}/log")
        version = log.agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{root.rstrip('/')}/versions/{version}")
