"""Quality classifier from compressed sizes under two zstandard dictionaries.

One dictionary is built from text labelled good, one from text labelled bad. Text that resembles the good text
compresses better with the good dictionary. A text is cut into blocks of ``BLOCK`` bytes that are compressed apart, so
the dictionary, not the text's own past, decides. The features are compressed sizes only: the normalised difference
(good - bad) / (good + bad), and, so that repetitive text (which any dictionary compresses to next to nothing) can be
told apart, both sizes against the plain length, and the text's length. A logistic regression, fitted on labelled rows
that the dictionaries have not seen and weighted to the true share of the classes, makes a calibrated score of them.

**Bounds.** Training uses at most ``ROWS`` labelled rows of each class, taken in the order of a hash of the id; the
dictionaries at most ``BLOCKS`` blocks of each class (a few MB on the driver). Everything else covers all rows; whole
texts are scored.

Scale: the sample's ids are two bounded lists, so joining them to the documents is a broadcast of a known size; text is
never shuffled. Scoring is one pass with two dictionaries of 64 KB in the closure.

Edge cases: null and empty texts get the score of size-0 features. With no rows of one class (or none at all) the score
is the share of good labels, or 0.5. Extra columns are ignored by ``score``; ``keep_good`` keeps them. Repeated rows score
alike. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmart.llm.common import bounded_label_sample, class_counts, fit_logistic, logistic_score, sampled_texts, staged

BLOCK = 2048
ROWS = 4000
BLOCKS = 2000
DICT_BYTES = 64 << 10
LEVEL = 3


@dataclass(frozen=True)
class CompressionModel:
    """Two dictionaries and the calibration; small (about 130 KB) and picklable."""

    good: bytes
    bad: bytes
    calibration: dict | None
    prior: float

    def compressors(self) -> tuple:
        return tuple(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False
            )
            for d in (self.good, self.bad)
        )

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.calibration is None:
            return np.full(len(texts), self.prior)
        pair = self.compressors()
        return logistic_score(self.calibration, np.array([features(t, *pair) for t in texts]).reshape(-1, N_FEATURES))


N_FEATURES = 6


def features(data: bytes, good, bad) -> list[float]:
    """Compressed-size features of one whole text."""
    g = b = 0
    worst = -1.0
    for a in range(0, len(data), BLOCK):
        piece = data[a : a + BLOCK]
        x, y = len(good.compress(piece)), len(bad.compress(piece))
        g, b = g + x, b + y
        if len(piece) >= BLOCK // 4 or len(data) <= BLOCK:
            worst = max(worst, (x - y) / (x + y))
    if not data:
        return [0.0] * N_FEATURES
    n = len(data)
    diff = (g - b) / (g + b)
    return [diff, worst, min(g / n, 2.0), min(b / n, 2.0), np.log1p(n), diff * np.log1p(n)]


def build_dictionary(blocks: list[bytes]) -> bytes:
    """A zstandard dictionary of ``blocks``; plain content where there is too little to train on."""
    content = b"".join(blocks)
    if len(blocks) >= 32:
        try:
            size = max(1024, min(DICT_BYTES, len(content) // 8))
            return zstandard.train_dictionary(size, blocks, k=256, d=8).as_bytes()
        except zstandard.ZstdError:
            pass  # the samples were too alike or too short to train on; their content serves as it is
    return content[-DICT_BYTES:]


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [
            (doc_id, label, a // BLOCK, bytes(text[a : a + BLOCK]))
            for doc_id, label, text in batch.itertuples(index=False)
            for a in range(0, len(text), BLOCK)
        ]
        yield pd.DataFrame(rows, columns=["doc_id", "label", "at", "block"])


def fit(docs: DataFrame, labels: DataFrame, eligible: Column, label: str = "quality", rows: int = ROWS, seed: int = 1) -> CompressionModel:
    """Learn from the rows of ``labels`` where ``eligible`` holds (the only labels that are read)."""
    n_bad, n_good = class_counts(labels, label, eligible)
    prior = n_good / (n_good + n_bad) if n_good + n_bad else 0.5
    if not n_good or not n_bad:
        return CompressionModel(b"", b"", None, prior)
    ids = bounded_label_sample(labels, label, eligible, rows, seed)
    sample = staged(sampled_texts(docs.filter(F.length("text") > 0), ids, "binary"), "quality-sample")
    half = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(2))
    pieces = sample.filter(half == 0).mapInPandas(_blocks, "doc_id long, label int, at int, block binary")
    order = F.xxhash64(F.lit(seed + 2), "doc_id", "at")
    chosen = {}
    for k in (0, 1):
        got = pieces.filter(F.col("label") == k).orderBy(order, "doc_id", "at").limit(BLOCKS).collect()
        chosen[k] = [bytes(r["block"]) for r in got]
    if not chosen[0] or not chosen[1]:
        return CompressionModel(b"", b"", None, prior)
    model = CompressionModel(build_dictionary(chosen[1]), build_dictionary(chosen[0]), None, prior)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = model.compressors()
        for batch in batches:
            x = [features(bytes(t), *pair) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "x": x})

    seen = sample.filter(half == 1).mapInPandas(measure, "doc_id long, label int, x array<double>").orderBy("doc_id").collect()
    y = np.array([r["label"] for r in seen], float)
    if not len(y) or y.min() == y.max():
        return CompressionModel(model.good, model.bad, None, prior)
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    calibration = fit_logistic(np.array([r["x"] for r in seen]), y, weight)
    return CompressionModel(model.good, model.bad, calibration, prior)


def scorer(model: CompressionModel):
    """A column function: the score of a binary text column."""

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.scores([b"" if t is None else bytes(t) for t in text]), dtype=float)

    return score


def score(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """(doc_id, score) of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), scorer(model)(F.col("text").cast("binary")).alias("score"))


def keep_good(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """The rows scored 0.5 or more, all columns kept."""
    return docs.filter(scorer(model)(F.col("text").cast("binary")) >= 0.5)
