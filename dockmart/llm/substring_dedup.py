"""Exact removal of repeated word passages through a compacted de Bruijn graph.

A window of k words is an edge of the de Bruijn graph from its first k-1 words to its last k-1 words. An edge
repeats if it starts in documents with different ids. A word goes if a window covers it whose edge also starts in
a document with a smaller doc_id.

1. **Minimisers.** Every window holds k-m+1 grams of m words; the one with the smallest hash (leftmost of equals) is
   its minimiser. Equal windows have equal minimisers, and about 2/(k-m+2) of all grams are minimisers of some
   window, so only these travel: (gram hash, least and greatest text hash), combined before the shuffle. A gram
   found in one text only, however many documents are copies of it, needs no search: a copy is one path from the
   smallest doc_id with that text.
2. **Unitigs.** The consecutive windows that share one minimiser are one path of edges without a choice in it. Only
   paths of surviving minimisers travel: a Bloom filter of the minimisers, at most ``FILTER_BITS`` bits whatever
   the input, drops most others where they are made, and a join drops the rest (a full filter drops nothing, and
   the result is the same). An edge is identified by its minimiser's hash and 48 bits of an independent window
   hash; a path by its edges.
3. **Joins.** Equal paths are grouped first: the first occurrence (smallest doc_id, then position) is the source of
   all others, edge by edge. Where documents branch off, paths around one minimiser differ though they share edges;
   only for minimisers with several paths are the paths taken apart, and their edges joined one by one.
4. **Compaction.** Occurrences that follow each other in a document, while their sources follow each other in the
   same source document, are joined to one nonbranching path: one row (document, start, edges, source, source
   start), however long it is.
5. **Verification.** For each path a 128-bit digest of the words at the document's coordinates is compared with one
   of the words at the source coordinates. Texts travel once; each document digests the paths it holds and the
   paths it is the source of. A document with a path whose digests differ (a hash collision) is searched again word
   for word (see ``_recheck``).

Scale: the step that sees every word sends one row for each minimiser, pre-aggregated; later steps see repeated
passages only. A passage that a third of all documents share is a hot join key, which adaptive skew handling
splits; no group is collected. Text is shuffled once, by doc_id.

Edge cases: a null text has no words and kept_sha256 is the digest of the empty string. Rows that repeat a doc_id
are documents of that id (windows equal within one id remove nothing); a row with a null doc_id is neither a source
nor cleaned. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockmart.llm.common import gram_hashes, staged, word_hashes, word_spans

#: The filter's greatest size: 64 MB, and bits a minimiser below that.
FILTER_BITS, BITS_EACH = 1 << 29, 16
_FILTER_CHUNK = 1 << 20
#: Bytes of an edge's own hash.
EDGE = 6
#: Text that one step works on, so that memory does not follow the batch.
_PART_BYTES = 2 << 20


def _binary(docs: DataFrame) -> DataFrame:
    """(doc_id, th, text): th, a hash of the text, tells rows of one doc_id with different texts apart."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("text")
    )


def _payload(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(doc_id, th, texts) of a batch, a bounded number of bytes at a time."""
    ids, ths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    first, size, texts = 0, 0, []
    for i, value in enumerate(batch.column(2)):
        texts.append(_payload(value))
        size += len(texts[-1])
        if size >= _PART_BYTES or i + 1 == batch.num_rows:
            yield ids[first : i + 1], ths[first : i + 1], texts
            first, size, texts = i + 1, 0, []


def _paths(texts: list[bytes], k: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """The runs of windows that share a minimiser, over several texts at once.

    (text number, first window in its text, minimiser's hash, first window and end among the windows returned last).
    """
    joined = b"\n".join(texts)
    spans = word_spans(joined)
    if len(spans[0]) < k:
        return None
    ends = np.cumsum([len(t) + 1 for t in texts])
    text_of = np.searchsorted(ends, spans[0], side="right")
    first_word = np.searchsorted(spans[0], ends - np.array([len(t) + 1 for t in texts]))
    words = word_hashes(joined, spans)
    grams = gram_hashes(words, m, seed=11)
    width = k - m + 1
    low = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(1) + np.arange(len(grams) - width + 1)
    at = np.flatnonzero(text_of[: len(low)] == text_of[k - 1 :])  # windows within one text
    if not len(at):
        return None
    cuts = np.flatnonzero((np.diff(low[at]) != 0) | (np.diff(text_of[at]) != 0)) + 1
    begin, end = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(at)]))
    head = at[begin]
    owner = text_of[head]
    return owner, head - first_word[owner], grams[low[head]].view(np.int64), np.stack((begin, end)), gram_hashes(words, k, seed=12)[at]


def minimizer_rows(docs: DataFrame, k: int, m: int) -> DataFrame:
    """(th, mh): the minimisers of each text, each once in a batch of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, ths, texts in _parts(batch):
                found = _paths(texts, k, m)
                if found is not None:
                    rows = _unique(ths[found[0]], found[2])
                    yield pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1])], ["th", "mh"])

    return _binary(docs).filter("doc_id is not null").mapInArrow(run, "th long, mh long")


def _unique(owners: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs."""
    order = np.lexsort((hashes, owners))
    owners, hashes = owners[order], hashes[order]
    new = np.concatenate(([True], (np.diff(owners) != 0) | (np.diff(hashes) != 0)))
    return owners[new], hashes[new]


def _positions(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a hash in a filter of ``bits`` bits (a power of two)."""
    h = hashes.view(np.uint64)
    mask = np.uint64(bits - 1)
    return (h & mask).astype(np.int64), (h >> np.uint64(32) & mask).astype(np.int64)


def bloom_filter(hashes: DataFrame) -> np.ndarray:
    """A filter of the column ``mh`` as packed bits: built by chunks in the tasks, at most ``FILTER_BITS`` bits in all."""
    count = hashes.count()
    bits = 1 << 16
    while bits < min(FILTER_BITS, BITS_EACH * count):
        bits *= 2

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(_positions(batch.column(0).to_numpy(), bits)))
            yield pa.RecordBatch.from_arrays([pa.array(at // _FILTER_CHUNK), pa.array(at % _FILTER_CHUNK)], ["chunk", "at"])

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(_FILTER_CHUNK, bool)
        flags[rows["at"].to_numpy()] = True
        return pd.DataFrame({"chunk": rows["chunk"].iloc[:1].to_numpy(), "packed": [np.packbits(flags, bitorder="little").tobytes()]})

    placed = hashes.select("mh").mapInArrow(place, "chunk long, at long").distinct()
    out = np.zeros(max(bits, _FILTER_CHUNK) // 8, np.uint8)
    for row in placed.groupBy("chunk").applyInPandas(pack, "chunk long, packed binary").toLocalIterator():
        first = row["chunk"] * _FILTER_CHUNK // 8
        out[first : first + _FILTER_CHUNK // 8] = np.frombuffer(row["packed"], np.uint8)
    return out[: bits // 8]


def _may_hold(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    yes = np.ones(len(hashes), bool)
    for at in _positions(hashes, 8 * len(packed)):
        yes &= (packed[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return yes


_PATHS = "doc_id long, th long, mh long, start int, edges binary"


def path_rows(docs: DataFrame, k: int, m: int, known=None) -> DataFrame:
    """(doc_id, th, mh, start, edges): the runs of windows that share a minimiser, each edge in ``EDGE`` bytes.

    ``known`` (a broadcast filter) leaves out paths whose minimiser it does not hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed_filter = known.value if known is not None else None
        for batch in batches:
            for ids, ths, texts in _parts(batch):
                found = _paths(texts, k, m)
                if found is None:
                    continue
                owner, start, mh, (begin, end), windows = found
                packed = np.ascontiguousarray(windows.view(np.uint8).reshape(-1, 8)[:, :EDGE])
                if packed_filter is not None:
                    yes = _may_hold(packed_filter, mh)
                    packed = packed[np.repeat(yes, end - begin)]
                    size = (end - begin)[yes]
                    owner, start, mh = owner[yes], start[yes], mh[yes]
                else:
                    size = end - begin
                offsets = (np.concatenate(([0], np.cumsum(size))) * EDGE).astype(np.int32)
                edges = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[owner]), pa.array(ths[owner]), pa.array(mh), pa.array(start.astype(np.int32)), edges],
                    ["doc_id", "th", "mh", "start", "edges"],
                )

    return _binary(docs).filter("doc_id is not null").mapInArrow(run, _PATHS)


def copied_texts(docs: DataFrame) -> DataFrame:
    """(th, owner): the texts of several documents, with the smallest doc_id of each."""
    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th")).filter("doc_id is not null")
    return keys.groupBy("th").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).filter("owner < last").drop("last")


def shared_paths(docs: DataFrame, copies: DataFrame, k: int = 13, m: int = 5) -> DataFrame:
    """The rows of ``path_rows`` whose minimiser stands in several texts, in the first document of each text."""
    seen = minimizer_rows(docs, k, m).groupBy("mh").agg(F.min("th").alias("a"), F.max("th").alias("b"))
    shared = staged(seen.filter("a < b").select("mh"), "minimisers")
    known = docs.sparkSession.sparkContext.broadcast(bloom_filter(shared))
    rows = path_rows(docs, k, m, known).join(shared.hint("shuffle_hash"), "mh", "left_semi")
    return rows.join(copies, "th", "left").filter("owner is null or owner = doc_id").drop("owner")


def _with_source(rows: DataFrame, n) -> DataFrame:
    """(doc_id, th, start, n, source, source_th, shift) of rows with their ``first`` occurrence."""
    return rows.select(
        "doc_id",
        "th",
        "start",
        n.alias("n"),
        F.col("first.doc_id").alias("source"),
        F.col("first.th").alias("source_th"),
        (F.col("first.start") - F.col("start")).alias("shift"),
    )


def repeated_paths(docs: DataFrame, k: int = 13, m: int = 5) -> DataFrame:
    """(doc_id, th, start, edges, source, source_th, source_start): the compacted repeated paths of every document.

    Each edge of a path starts in document ``source``, whose id is smaller than doc_id. A copy of a whole text is one
    path with ``edges`` -1.
    """
    copies = staged(copied_texts(docs), "copies")
    paths = staged(shared_paths(docs, copies, k, m), "paths")
    count = (F.octet_length("edges") / EDGE).cast("int")
    place = F.min(F.struct("doc_id", "th", "start")).alias("first")
    whole = paths.groupBy("mh", "edges").agg(place, F.max("doc_id").alias("last"), F.count("*").alias("times"))
    # a path that stands once needs no join: it is its own first occurrence
    once = whole.filter("times = 1").select("mh", "edges", "first.doc_id", "first.th", "first.start")
    twice = whole.filter("times > 1").select("mh", "edges", "first")
    split = staged(
        paths.join(twice, ["mh", "edges"])
        .select("mh", "edges", "doc_id", "th", "start", "first")
        .unionByName(once.withColumn("first", F.struct("doc_id", "th", "start"))),
        "sourced",
    )
    later = F.col("first.doc_id") < F.col("doc_id")
    by_path = _with_source(split.filter(later), count)

    # where paths around one minimiser differ, their edges are joined one by one; a path that has a source as a whole
    # needs no more, and equal paths have equal edges, so their first occurrence stands for all as a source
    mark = F.xxhash64("edges")
    branching = split.groupBy("mh").agg(F.min(mark).alias("a"), F.max(mark).alias("b")).filter("a != b").select("mh")
    heads = split.filter(~later).join(branching, "mh", "left_semi").drop("first")
    piece = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(i.alias("i"), F.col("edges").substr(i * EDGE + 1, F.lit(EDGE)).alias("h")))
    edges = heads.withColumn("e", F.explode(piece)).select("mh", "e.h", "doc_id", "th", (F.col("start") + F.col("e.i")).alias("start"))
    first_edge = edges.groupBy("mh", "h").agg(place, F.max("doc_id").alias("last"))
    first_edge = first_edge.filter(F.col("first.doc_id") < F.col("last")).drop("last")
    by_edge = _with_source(edges.join(first_edge, ["mh", "h"]).filter(later), F.lit(1))

    # (a row that repeats another one, as of equal documents of one id, makes a path of its own with the same words)
    found = by_path.unionByName(by_edge)
    line = ["doc_id", "th", "source", "source_th", "shift"]
    order = Window.partitionBy(*line).orderBy("start")
    after = F.lag(F.col("start") + F.col("n")).over(order)
    joined = found.withColumn("new", F.when(after == F.col("start"), 0).otherwise(1))
    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"))
    whole_copies = (
        keys.join(copies, "th")
        .filter("doc_id > owner")
        .distinct()
        .select(
            "doc_id", "th", F.lit(0).alias("start"), F.lit(-1).alias("edges"), F.col("owner").alias("source"), F.col("th").alias("source_th"), F.lit(0).alias("source_start")
        )
    )
    chains = (
        joined.withColumn("run", F.sum("new").over(order))
        .groupBy(*line, "run")
        .agg(F.min("start").alias("start"), F.sum("n").cast("int").alias("edges"))
        .select("doc_id", "th", "start", "edges", "source", "source_th", (F.col("start") + F.col("shift")).alias("source_start"))
    )
    return chains.unionByName(whole_copies)


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _clean(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    gone = np.zeros(len(words) + 1, np.int32)
    for a, b in spans:
        gone[a] += 1
        gone[b] -= 1
    keep = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
    return [words[i] for i in keep.tolist()]


#: kind 0: a document's result. kind 1: the digest of a path it holds. kind 2: of words it is the source of.
_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("th", pa.int64()),
        ("kind", pa.int32()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept_sha256", pa.string()),
        ("kept", pa.string()),
        ("start", pa.int32()),
        ("edges", pa.int32()),
        ("path", pa.int64()),
        ("digest", pa.binary()),
    ]
)
_RESULT = (
    "doc_id long, th long, kind int, n_words long, n_removed long, kept_sha256 string, kept string, "
    "start int, edges int, path long, digest binary"
)


def _span(path: dict, words: list[bytes], k: int) -> tuple[int, int]:
    """First word and end of a path; a path of -1 edges is the whole text."""
    return (0, len(words)) if path["edges"] < 0 else (path["start"], path["start"] + path["edges"] + k - 1)


def _row(kind: int, doc_id: int, th: int, **values) -> dict:
    return {"kind": kind, "doc_id": doc_id, "th": th} | values


def remove_repeats(docs: DataFrame, k: int = 13, m: int = 5, texts: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 (and ``kept``, the words left, if ``texts``)."""
    name = F.xxhash64("doc_id", "th", "start", "source", "source_th", "source_start")
    paths = staged(repeated_paths(docs, k, m).withColumn("path", name), "paths")
    own = paths.groupBy("doc_id", "th").agg(F.collect_list(F.struct("path", "start", "edges")).alias("own"))
    # a passage that many copies name is digested once: equal (source, start, edges) are combined before the shuffle
    lent = (
        paths.select(F.col("source").alias("doc_id"), F.col("source_th").alias("th"), F.col("source_start").alias("start"), "edges")
        .distinct()
        .groupBy("doc_id", "th")
        .agg(F.collect_list(F.struct("start", "edges")).alias("lent"))
    )
    joined = (
        _binary(docs)
        .join(own.join(lent, ["doc_id", "th"], "full"), ["doc_id", "th"], "left")
        .select("doc_id", "th", "text", "own", "lent")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[dict] = []
            for i in range(batch.num_rows):
                doc_id, th, text, own_here, lent_here = (column[i] for column in batch.columns)
                key = (doc_id.as_py(), th.as_py())
                words = _payload(text).split()
                spans = []
                for r in own_here.as_py() or ():
                    a, b = _span(r, words, k)
                    if b - a >= k:
                        spans.append((a, b))
                    rows.append(_row(1, *key, path=r["path"], digest=_digest(words[a:b])))
                for r in lent_here.as_py() or ():
                    a, b = _span(r, words, k)
                    rows.append(_row(2, *key, start=a, edges=r["edges"], digest=_digest(words[a:b])))
                left = _clean(words, spans)
                out = b" ".join(left)
                rows.append(
                    _row(
                        0,
                        *key,
                        n_words=len(words),
                        n_removed=len(words) - len(left),
                        kept_sha256=hashlib.sha256(out).hexdigest(),
                        kept=out.decode("utf-8") if texts else None,
                    )
                )
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    table = staged(joined.mapInArrow(run, _RESULT), "cleaned")
    result = table.filter("kind = 0").select("doc_id", "th", "n_words", "n_removed", "kept_sha256", *(["kept"] if texts else []))
    bad = _unverified(paths, table)
    if not bad.isEmpty():
        result = _recheck(docs, result, staged(bad, "unverified"), k)
    return result.drop("th")


def _unverified(paths: DataFrame, table: DataFrame) -> DataFrame:
    """(doc_id, th) of documents holding a path whose words differ from those at its source coordinates."""
    own = table.filter("kind = 1").select("doc_id", "th", "path", "digest")
    lent = table.filter("kind = 2").select(
        F.col("doc_id").alias("source"),
        F.col("th").alias("source_th"),
        F.col("start").alias("source_start"),
        "edges",
        F.col("digest").alias("source_digest"),
    )
    named = paths.join(own, ["doc_id", "th", "path"]).join(lent, ["source", "source_th", "source_start", "edges"], "left")
    return named.filter(~F.col("digest").eqNullSafe(F.col("source_digest"))).select("doc_id", "th").distinct()


def _recheck(docs: DataFrame, result: DataFrame, bad: DataFrame, k: int) -> DataFrame:
    """Documents with an unverified path again, their windows compared as word sequences instead of hashes."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, th, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = (text or b"").split()
                for a in range(0, max(0, len(words) - k + 1), 4096):
                    at = range(a, min(len(words) - k + 1, a + 4096))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([doc_id] * len(at), pa.int64()),
                            pa.array([th] * len(at), pa.int64()),
                            pa.array(list(at), pa.int32()),
                            pa.array([b" ".join(words[p : p + k]) for p in at], pa.binary()),
                        ],
                        ["doc_id", "th", "pos", "w"],
                    )

    key = ["doc_id", "th"]
    plain = _binary(docs).filter("doc_id is not null").mapInArrow(windows, "doc_id long, th long, pos int, w binary")
    wanted = plain.join(bad, key, "left_semi")
    first = plain.join(wanted.select("w").distinct(), "w", "left_semi").groupBy("w").agg(F.min("doc_id").alias("source"))
    covered = wanted.join(first, "w").filter("doc_id > source").groupBy(*key).agg(F.collect_set("pos").alias("at"))
    again = _binary(docs).join(bad, key, "left_semi").join(covered, key, "left").select("doc_id", "th", "text", "at")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, th, text, at in batch.itertuples(index=False):
                words = bytes(text or b"").split()
                left = _clean(words, [(p, p + k) for p in (at if at is not None else ())])
                out = b" ".join(left)
                sha = hashlib.sha256(out).hexdigest()
                rows.append((doc_id, th, len(words), len(words) - len(left), sha, out.decode("utf-8")))
            yield pd.DataFrame(rows, columns=["doc_id", "th", "n_words", "n_removed", "kept_sha256", "kept"])

    schema = "doc_id long, th long, n_words long, n_removed long, kept_sha256 string, kept string"
    mended = again.mapInPandas(run, schema).select(*result.columns)
    return result.join(bad, key, "left_anti").unionByName(mended)
