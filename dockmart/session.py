"""Spark session helpers.

The library itself never creates a session; callers pass one in. These helpers
are for the entry points (bench, tests, CLI) and keep the settings the
transforms rely on in one place:

* ``spark.sql.session.timeZone=UTC`` – every timestamp in the mart is
  zone-less (``timestamp_ntz``); a UTC session keeps the few places where
  Spark converts through the session zone (``try_to_timestamp``) exact.
* AQE on, with skew-join splitting – joins and aggregates rely on runtime
  statistics instead of hand-placed broadcast hints.
* ``spark.sql.codegen.hugeMethodLimit=8000`` – keep generated methods small
  enough for the JIT (see ``BASE_CONF``).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The report projections are wide; a whole-stage method above 8000 bytes
    # is never JIT-compiled by HotSpot and runs interpreted. Past this size
    # Spark falls back to per-operator code, whose methods are split small.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Session settings the queries rely on at run time (SQL confs only).
RUNTIME_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL confs the mart relies on in an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)


_OWN_DIRS: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir`` of the session; a local run without it has its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    if sc.applicationId not in _OWN_DIRS:
        _OWN_DIRS[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="dockmart-work-")
    return _OWN_DIRS[sc.applicationId]


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "dockmart",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session with the mart's settings (for tests and the bench)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
