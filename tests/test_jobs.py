"""The batch job starts as documented, from any folder."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_job_script_starts_from_another_folder():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    job = os.path.join(ROOT, "dockmart", "jobs.py")
    done = subprocess.run([sys.executable, job, "--help"], cwd=tempfile.gettempdir(), env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "--system" in done.stdout


def test_partitioned_report_has_few_files_a_day(spark, scratch):
    from dockmart.sources.sinks import write_report

    rows = spark.range(4000, numPartitions=16).selectExpr("id", "cast(id % 5 as int) AS `Planned Day [x]`")
    write_report(rows, f"{scratch}/report", partition_by=["Planned Day [x]"])
    days = [d for d in os.listdir(f"{scratch}/report") if "=" in d]
    files = [f for d in days for f in os.listdir(f"{scratch}/report/{d}") if f.endswith(".parquet")]
    assert len(days) == 5 and len(files) <= 10
    assert spark.read.parquet(f"{scratch}/report").count() == 4000


def test_layouts_that_begin_with_blanks_or_names(spark):
    from pyspark.sql import functions as F

    from dockmart.functions.dates import safe_timestamp

    rows = spark.createDataFrame([(" 06/10/2025 14:00",), ("Jun 10 2025 2:00PM",), ("TBD",), (None,), ("2025-06-10 14:00:00",)], "t string")
    got = [r[0] for r in rows.select(F.date_format(safe_timestamp("t", ["MM/dd/yyyy HH:mm", "MMM d yyyy h:mma"]).cast("timestamp"), "HH:mm")).collect()]
    assert got == ["14:00", "14:00", None, None, "14:00"]
