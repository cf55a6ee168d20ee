"""Join operators of the mart.

No join here carries a broadcast hint. Whether a side is broadcast is left
to Spark's size check (``spark.sql.autoBroadcastJoinThreshold`` on the
planned size, and AQE on the measured size of each shuffle stage), so a
dimension that grows with the data falls back to a shuffle join by itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmart.config import TextRules
from dockmart.functions.text import join_key, text_eq


def left_dim(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    columns: dict[str, str],
) -> DataFrame:
    """``fact LEFT JOIN dim ON fact.k = dim.k``, adding ``columns`` (dim name -> new name).

    The dimension is projected to its key and the wanted columns first, so
    only those are read and shuffled.
    """
    d = dim.select(F.col(dim_key).alias("__dim_key"), *[F.col(c).alias(n) for c, n in columns.items()])
    return fact.join(d, fact[fact_key] == d["__dim_key"], "left").drop("__dim_key")


def role_join(
    fact: DataFrame,
    partners: DataFrame,
    fact_key: str,
    partner_key: str,
    role_col: str | None,
    role: str | None,
    columns: dict[str, str],
    rules: TextRules = TextRules(),
) -> DataFrame:
    """``LEFT JOIN partners p ON fact.k = p.id AND p.type = role``.

    The role test sits in the ON clause: a partner with another role leaves
    the fact row in place with NULL columns. Filtering the partner table
    before the outer join is the same thing and lets the filter reach the
    scan. Called twice with different roles and names it joins the same
    table in two roles.
    """
    p = partners
    if role_col is not None and role is not None:
        p = p.where(text_eq(role_col, role, rules))
    return left_dim(fact, p, fact_key, partner_key, columns)


def _key(df: DataFrame, name: str, rules: TextRules) -> Column:
    return join_key(df[name], rules) if df.schema[name].dataType.typeName() == "string" else df[name]


def left_join_on(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    left_condition: Column | None = None,
    rules: TextRules = TextRules(),
) -> DataFrame:
    """Left outer join on several key pairs plus an optional left-side test in ON.

    Pairs of text keys are compared under ``rules``.

    A left row failing ``left_condition`` is kept with NULL right columns,
    as SQL does for a predicate in the ON clause of a LEFT JOIN. Right key
    columns are dropped from the result.
    """
    renamed = right
    cond = None
    for lk, rk in keys:
        tmp = f"__r_{rk}"
        renamed = renamed.withColumnRenamed(rk, tmp)
    for lk, rk in keys:
        term = _key(left, lk, rules) == _key(renamed, f"__r_{rk}", rules)
        cond = term if cond is None else cond & term
    if left_condition is not None:
        cond = cond & left_condition
    out = left.join(renamed, cond, "left")
    return out.drop(*[f"__r_{rk}" for _, rk in keys])


def trimmed_key_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    columns: dict[str, str],
    rules: TextRules = TextRules(),
) -> DataFrame:
    """``fact LEFT JOIN dim ON fact.k = LTRIM(RTRIM(dim.k))``.

    The trimmed key is computed once on the dimension side; under SQL Server
    text rules both keys are also normalised (case, trailing blanks).
    """
    d = dim.select(
        join_key(F.trim(F.col(dim_key)), rules).alias("__dim_key"),
        *[F.col(c).alias(n) for c, n in columns.items()],
    )
    f = fact.withColumn("__fact_key", join_key(F.col(fact_key), rules)) if not rules.exact else fact
    fk = "__fact_key" if not rules.exact else fact_key
    out = f.join(d, f[fk] == d["__dim_key"], "left").drop("__dim_key")
    return out.drop("__fact_key") if not rules.exact else out


def not_in(
    df: DataFrame,
    key: str,
    excluded: DataFrame,
    excluded_key: str | None = None,
    null_listed: DataFrame | None = None,
    listed: DataFrame | None = None,
    where: Column | None = None,
) -> DataFrame:
    """``df WHERE key NOT IN (SELECT excluded_key FROM excluded)`` with SQL's NULL rules.

    * empty list: every row is kept, NULL keys included;
    * a NULL in the list: no row is kept;
    * otherwise rows whose key is NULL or in the list are dropped.

    Spark plans ``NOT IN`` as a null-aware anti join that always broadcasts
    the list, which fails once the list outgrows an executor. This form is a
    plain ``left_anti`` join (shuffle or broadcast, chosen on size) plus two
    existence tests, each a one-row scalar subquery, so nothing that grows
    with the data is broadcast.

    Cost: whether the list holds a NULL needs only its rows with a NULL key;
    the ``IS NULL`` filter passes a grouping on that key and reaches the
    Parquet reader, which skips row groups without NULLs. Whether it is empty
    matters to rows with a NULL key only, and not if it holds a NULL: its other
    keys are looked at, the same frame as the anti join's, so that both can
    read one exchange.
    ``null_listed``: a frame that has rows if the list holds a NULL, where the
    caller keeps NULL keys apart and ``excluded`` has none.
    ``listed``: a frame of one column that has a value if the list has one,
    where ``excluded`` holds but the part of it that ``df`` can still meet.
    ``where``: a test of ``df`` that is true for all rows whose key may be in
    ``excluded``; others are not looked up.
    """
    excluded_key = excluded_key or key
    keys = excluded.select(F.col(excluded_key).alias("__nin_key"))
    count = F.count(F.lit(1))
    nulls = (keys.where(F.col("__nin_key").isNull()) if null_listed is None else null_listed).limit(1).select(count).scalar()
    named = keys.where(F.col("__nin_key").isNotNull())
    some = named if listed is None else listed
    rows = some.limit(1).agg(F.count(some.columns[0])).scalar()  # reads the key, so that the plan is shared
    same = df[key] == F.col("__nin_key")
    kept = df.join(
        named,
        same if where is None else same & where,
        "left_anti",
    )
    return kept.where((nulls == 0) & (F.col(key).isNotNull() | (rows == 0)))
