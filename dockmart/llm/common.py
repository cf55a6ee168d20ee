"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import hashlib
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
#: ``bytes.split()`` without arguments splits on exactly these six characters.
WORD = r"[^\x20\x09-\x0D]+"

_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the setting is missing (tests, a local run) one scratch folder per application is made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        _OWN_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="dockmart-shared-")
    return _OWN_DIRS[app]


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession, rows: int = 1000) -> None:
    """Hand Python at most ``rows`` rows at a time (whole texts can be long, and a batch is held in memory), and see that
    the workers can import this package: Spark ships it once to each executor."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        path = Path(tempfile.mkdtemp(prefix="dockmart-ship-")) / f"{root.name}.zip"  # read by the driver only
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(path))
        _SHIPPED.add(app)


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/dockmart-{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor costs its own unfinished tasks, never the work before this point. What the written
    plan shuffled is no longer needed then; Spark deletes shuffle files when the driver collects their garbage, so that
    is asked for here instead of leaving them on the executors' disks until it happens to come.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.2)  # the cleaner works in the background
    return spark.read.schema(schema).parquet(path)


def id_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(mod)


def bounded_label_sample(labels: DataFrame, label: str, eligible: Column, rows_per_class: int, seed: int) -> DataFrame:
    """At most ``rows_per_class`` labelled ids of each class, in the order of a seeded hash.

    The result has at most ``2 * rows_per_class`` rows (doc_id, label), a proven bound for a broadcast.
    Rows with a null id or a label other than 0 and 1 take no part; an id labelled twice counts once with its
    largest label.
    """
    base = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .filter(eligible)
    )
    rank = F.xxhash64(F.lit(seed), "doc_id")
    parts = [
        base.filter(F.col("label") == k).orderBy(rank, "doc_id").limit(rows_per_class) for k in (0, 1)
    ]
    return parts[0].unionByName(parts[1]).groupBy("doc_id").agg(F.max("label").alias("label"))


def sampled_texts(docs: DataFrame, ids: DataFrame, kind: str) -> DataFrame:
    """(doc_id, label, text) of the sampled ids (a bounded number of rows, so they are broadcast): one row an id.

    Where an id repeats, the text with the smallest hash stands for it, so a sample never outgrows its ids.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast(kind).alias("text"))
    found = text.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label")
    return found.agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))


def class_counts(labels: DataFrame, label: str, eligible: Column) -> tuple[int, int]:
    """Eligible rows with label 0 and with label 1."""
    rows = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .filter(eligible)
        .groupBy("label")
        .count()
        .collect()
    )
    found = {r["label"]: r["count"] for r in rows}
    return found.get(0, 0), found.get(1, 0)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> dict:
    """Weighted ridge logistic regression by Newton steps on standardised columns (a bounded sample)."""
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-12, scale, 1.0)
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge * weight.sum())
    penalty[-1] = 1e-6

    def loss(v: np.ndarray) -> float:
        m = z @ v
        return float((weight * (np.logaddexp(0, m) - y * m)).sum() + 0.5 * (penalty * v * v).sum())

    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        grad = z.T @ (weight * (p - y)) + penalty * w
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty) + 1e-9 * np.eye(z.shape[1])
        step = np.linalg.solve(hess, grad)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        after = loss(w)
        if now - after < 1e-9 * max(1.0, abs(now)):
            break
        now = after
    return {"mean": mean.tolist(), "scale": scale.tolist(), "weights": w[:-1].tolist(), "bias": float(w[-1])}


def logistic_score(model: dict, x: np.ndarray) -> np.ndarray:
    z = (x - np.asarray(model["mean"])) / np.asarray(model["scale"])
    m = np.clip(z @ np.asarray(model["weights"]) + model["bias"], -35, 35)
    return 1 / (1 + np.exp(-m))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_ODD = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base to the powers 0 to n-1; up to 4 million of them are kept for the next call."""
    kept = _POWERS.get(int(base))
    if kept is None or len(kept) < n:
        out = np.full(max(n, 1 << 12), base, dtype=np.uint64)
        out[0] = 1
        kept = np.multiply.accumulate(out)
        if len(kept) <= 1 << 22:
            _POWERS[int(base)] = kept
    return kept[:n]


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word of a UTF-8 text."""
    raw = np.frombuffer(data, dtype=np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate(([1], space.view(np.int8), [1])))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of ``values[start:end]`` for each pair: equal content gives equal hashes wherever it stands.

    A polynomial over mixed values, read off prefix sums modulo 2**64, then mixed with the length.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    v = mix64(values.astype(np.uint64) + np.uint64(seed))
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(v * _powers(_ODD, len(v)), dtype=np.uint64)))
    inverse = _powers(_INVERSE, len(v) + 1)
    poly = (prefix[ends] - prefix[starts]) * inverse[starts]
    return mix64(poly + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64))


_CHUNK = 1 << 20


def word_hashes(data: bytes, spans: tuple[np.ndarray, np.ndarray], seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each word of ``data``; about a megabyte of text is worked on at a time."""
    starts, ends = spans
    raw = np.frombuffer(data, dtype=np.uint8)
    if len(raw) <= _CHUNK:
        return span_hashes(_BYTE_VALUES[raw], starts, ends, seed)
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, low + _CHUNK, side="right")))
        high = int(ends[j - 1])
        if high - low > _CHUNK:  # one word longer than a chunk
            out[i] = int.from_bytes(hashlib.blake2b(data[low:high], digest_size=8).digest(), "little")
        else:
            out[i:j] = span_hashes(_BYTE_VALUES[raw[low:high]], starts[i:j] - low, ends[i:j] - low, seed)
        i = j
    return out


def gram_hashes(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` consecutive words (given the words' hashes)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    at = np.arange(count)
    return span_hashes(words, at, at + n, seed)
