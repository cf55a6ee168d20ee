"""Compare a Spark DataFrame with a DuckDB query over the same Parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm_type(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t) or pa.types.is_string_view(t):
        return "string"
    if pa.types.is_timestamp(t):
        return f"timestamp[{t.tz or ''}]"
    return str(t)


def _norm_value(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _sort_key(row):
    return tuple((0, "") if v is None else (1, str(type(v)), v) for v in row)


def table_rows(tbl: pa.Table, names: list[str]) -> list[tuple]:
    cols = [tbl.column(n).to_pylist() for n in names]
    rows = [tuple(_norm_value(v) for v in r) for r in zip(*cols)] if cols else []
    return sorted(rows, key=_sort_key)


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str, check_types: bool = True) -> list[str]:
    """Differences between a Spark result and a DuckDB result (empty if equal)."""
    left = spark_df.toArrow()
    right = con.sql(sql).to_arrow_table()
    problems = []
    ln, rn = sorted(left.column_names), sorted(right.column_names)
    if ln != rn:
        return [f"columns differ: spark={ln} duckdb={rn}"]
    if check_types:
        for n in ln:
            a, b = _norm_type(left.schema.field(n).type), _norm_type(right.schema.field(n).type)
            if a != b:
                problems.append(f"type of {n!r}: spark={a} duckdb={b}")
    if left.num_rows != right.num_rows:
        problems.append(f"rows: spark={left.num_rows} duckdb={right.num_rows}")
    lrows, rrows = table_rows(left, ln), table_rows(right, ln)
    if lrows != rrows:
        lset, rset = set(lrows), set(rrows)
        diff_l = [r for r in lrows if r not in rset][:3]
        diff_r = [r for r in rrows if r not in lset][:3]
        problems.append(f"values differ; spark-only sample={diff_l} duckdb-only sample={diff_r}")
    return problems


def not_in_sql_form(df, key, excluded, excluded_key=None):
    """``NOT IN`` as SQL writes it (Spark's null-aware anti join, which broadcasts the whole list)."""
    from pyspark.sql import functions as F

    return df.where(~F.col(key).isin(excluded.select(excluded_key or key)))
