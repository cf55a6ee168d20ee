"""Approximate nearest neighbours with randomly rotated one-bit codes and error bounds.

A vector is centred, normalised and rotated by a random orthogonal matrix; its code keeps the signs, one bit a
dimension, packed. Two scalars correct the code: the distance to the centre and the inner product of the unit vector
with its own code. With them an inner product between the code and a rotated query estimates the true one without bias,
and ``EPSILON`` standard deviations bound the error, so each squared distance has a lower and an upper bound.

For each query, the k-th smallest upper bound is a threshold; every vector whose lower bound does not exceed it is
reranked with the exact distance on the original vectors in double precision. The bounds hold with high probability, so
the search is approximate; what it returns is exactly scored.

Scale: the index is a table (one row a vector: code, scalars, original vector). Vectors are dealt by a hash of their id
into blocks of about ``BLOCK`` rows, queries into blocks of about ``QUERIES``; a task holds one block of each, so memory is
bounded whatever is common or frequent in the data. A task returns at most k rows a query; the last step keeps k a query
with a rank that is limited before its shuffle. The work is queries times rows / one bit codes: the query set is what the
caller states.

Edge cases: vectors that are null, zero, empty or hold a null or a non-finite number take no part, as row or query.
Vectors are compared with those of their own dimension only. Rows that repeat an id are separate candidates; a query's
own id is never returned. A query row that stands several times asks once. An id asked with several vectors has one list:
a row's distance is that to the nearest of them, and each row stands in the list once. Ties go to the smaller id. Fewer candidates than k: all of them. Extra columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockmart.llm.common import staged

BLOCK = 4096
QUERIES = 1024
#: Standard deviations of the estimate that the bounds allow for.
EPSILON = 3.0
SEED = 20

_INDEX = "vec_id long, dim int, code binary, norm double, fit double, vec array<double>"
_FOUND = "query_id long, row long, vec_id long, score double"


def usable(vec: Column) -> Column:
    """Neither null nor zero, and without null, NaN or infinite components."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, dim, vec) of the rows that take part, in double precision."""
    vec = F.col(vec_col).cast("array<double>")
    return (
        table.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec"))
        .filter(F.col("vec_id").isNotNull() & usable(F.col("vec")))
        .select("vec_id", F.size("vec").alias("dim"), "vec")
    )


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix (the Q of a Gaussian matrix, signs fixed), the same on every machine."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def centres(rows: DataFrame) -> dict[int, np.ndarray]:
    """The mean vector of each dimension: sums of one row a batch and dimension, then one number a component."""

    def sums(batches):
        for batch in batches:
            out = []
            for dim, part in batch.groupby("dim"):
                total = np.stack(part["vec"].to_numpy()).sum(0)
                out += [(int(dim), i, float(x), len(part)) for i, x in enumerate(total)]
            yield pd.DataFrame(out, columns=["dim", "i", "x", "n"])

    summed = rows.select("dim", "vec").mapInPandas(sums, "dim int, i int, x double, n long").groupBy("dim", "i")
    means = summed.agg((F.sum("x") / F.sum("n")).alias("mean")).collect()
    found: dict[int, dict[int, float]] = {}
    for r in means:
        found.setdefault(r["dim"], {})[r["i"]] = r["mean"]
    return {dim: np.array([m[i] for i in range(dim)]) for dim, m in found.items()}


def build_index(rows: DataFrame) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """The index of all rows of ``vectors()``, numbered, as a table in the shared folder, and the centres it was built on."""
    middle = centres(rows)

    def encode(batches):
        for batch in batches:
            parts = []
            for dim, part in batch.groupby("dim"):
                dim = int(dim)
                delta = np.stack(part["vec"].to_numpy()) - middle[dim]
                norm = np.linalg.norm(delta, axis=1)
                turned = (delta / np.where(norm > 0, norm, 1)[:, None]) @ rotation(dim)
                bits = turned > 0
                fit = np.where(bits, turned, -turned).sum(1) / np.sqrt(dim)
                codes = [row.tobytes() for row in np.packbits(bits, axis=1)]
                parts.append(part.assign(code=codes, norm=norm, fit=fit))
            yield pd.concat(parts)[["vec_id", "dim", "code", "norm", "fit", "vec"]] if parts else batch.iloc[:0].assign(
                code=b"", norm=0.0, fit=0.0
            )[["vec_id", "dim", "code", "norm", "fit", "vec"]]

    numbered = rows.mapInPandas(encode, _INDEX).withColumn("row", F.monotonically_increasing_id())
    return staged(numbered, "codes"), middle


def _unpack(codes: pd.Series, dim: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    return np.unpackbits(raw, axis=1, count=dim).astype(np.float32) * 2 - 1


def _search_block(data: pd.DataFrame, queries: pd.DataFrame, middle: dict[int, np.ndarray], k: int) -> pd.DataFrame:
    """The k nearest rows of one block for each query of one block."""
    dim = int(data["dim"].iloc[0])
    ids, numbers = data["vec_id"].to_numpy(), data["row"].to_numpy()
    exact = np.stack(data["vec"].to_numpy())
    signs = _unpack(data["code"], dim)
    norm, fit = data["norm"].to_numpy(), np.maximum(data["fit"].to_numpy(), 1e-12)
    spread = EPSILON * np.sqrt(np.maximum(0.0, 1 / fit**2 - 1) / max(1, dim - 1))
    spread = np.where(norm > 0, spread, 0.0)
    out_q, out_r, out_v, out_d = [], [], [], []
    turn = rotation(dim)
    for a in range(0, len(queries), 64):
        part = queries.iloc[a : a + 64]
        q = np.stack(part["vec"].to_numpy())
        delta = q - middle[dim]
        qn = np.linalg.norm(delta, axis=1)
        inner = (signs @ (delta @ turn).T.astype(np.float32)).astype(float) / np.sqrt(dim) / fit[:, None]
        base = norm[:, None] ** 2 + qn[None, :] ** 2 - 2 * norm[:, None] * inner
        slack = 2 * norm[:, None] * qn[None, :] * spread[:, None] + 1e-5 * (norm[:, None] ** 2 + qn[None, :] ** 2)
        for j, query_id in enumerate(part["vec_id"].to_numpy()):
            other = ids != query_id
            low, high = base[:, j] - slack[:, j], base[:, j] + slack[:, j]
            if other.sum() > k:
                keep = np.flatnonzero(other & (low <= np.partition(high[other], k - 1)[k - 1]))
            else:
                keep = np.flatnonzero(other)
            d = np.sqrt(((exact[keep] - q[j]) ** 2).sum(1))
            best = np.lexsort((numbers[keep], ids[keep], d))[:k]
            out_q += [query_id] * len(best)
            out_r += numbers[keep][best].tolist()
            out_v += ids[keep][best].tolist()
            out_d += d[best].tolist()
    return _found(out_q, out_r, out_v, out_d)


def _found(query_id: list, row: list, vec_id: list, score: list) -> pd.DataFrame:
    ids = {"query_id": query_id, "row": row, "vec_id": vec_id}
    return pd.DataFrame({name: np.asarray(x, "int64") for name, x in ids.items()} | {"score": np.asarray(score, float)})


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of ``rows`` for each of ``queries`` (both as ``vectors()``).

    One list for each query id, also where its row repeats or it has several vectors; score is the Euclidean distance.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    index, middle = build_index(rows)
    asked = staged(queries.select("vec_id", "dim", "vec").distinct(), "queries")
    counts = {r["dim"]: r["n"] for r in index.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    asking = {r["dim"]: r["n"] for r in asked.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    out = rows.sparkSession.createDataFrame([], _FOUND)
    for dim in sorted(set(counts) & set(asking)):
        blocks, groups = -(-counts[dim] // BLOCK), -(-asking[dim] // QUERIES)
        # every block of rows meets every block of queries: a grid of (block, group) tasks, each of bounded size
        # (rows that share an id are dealt apart by the hash of their numbers)
        data = index.filter(F.col("dim") == dim).withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "vec_id", "vec"), F.lit(blocks)))
        data = data.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        ask = asked.filter(F.col("dim") == dim).withColumn("grp", F.pmod(F.xxhash64(F.lit(SEED + 1), "vec_id", "vec"), F.lit(groups)).cast("int"))
        ask = ask.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

        def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return _found([], [], [], [])
            return _search_block(left, right, middle, k)

        found = data.groupBy("block", "grp").cogroup(ask.groupBy("block", "grp"))
        out = out.unionByName(found.applyInPandas(search, _FOUND))
    if not asked.groupBy("vec_id").count().filter("count > 1").isEmpty():
        # the k nearest of an id are among the k nearest of its vectors
        out = out.groupBy("query_id", "row", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
