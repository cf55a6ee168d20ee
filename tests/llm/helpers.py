"""Small tables with the awkward cases that every operator must take, and plain brute-force versions."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, rows, extra=()):
    """Rows (doc_id, text[, source]) as a documents table, with extra columns of clashing names."""
    data = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None) for r in rows]
    df = spark.createDataFrame(data, DOCS)
    from pyspark.sql import functions as F

    for name in extra:
        df = df.withColumn(name, F.lit("clash"))
    return df


def words_of(text):
    return WORD.findall(text or "")


def prose(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary, n).tolist())


def vocabulary(rng, n=400):
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    return np.array(["".join(rng.choice(letters, rng.integers(2, 9))) for _ in range(n)])


def fingerprint(text, shingle=3):
    lowered = re.sub(r"[A-Z]+", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps: list[int], ids: list, bits: int):
    """Component ids of rows by all pairs: the smallest id reachable."""
    n = len(fps)
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    smallest: dict[int, int | None] = {}
    for i in range(n):
        r = find(i)
        if ids[i] is not None:
            smallest[r] = ids[i] if smallest.get(r) is None else min(smallest[r], ids[i])
    return [smallest.get(find(i)) for i in range(n)]


def removed(rows, k):
    """(n_words, n_removed, kept words) of each (doc_id, text) by window sets."""
    first: dict[tuple, int] = {}
    for doc_id, text in rows:
        w = words_of(text)
        if doc_id is None:
            continue
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = words_of(text)
        gone = set()
        for i in range(len(w) - k + 1):
            if doc_id is not None and first[tuple(w[i : i + k])] < doc_id:
                gone.update(range(i, i + k))
        out.append((len(w), len(gone), [x for i, x in enumerate(w) if i not in gone]))
    return out
