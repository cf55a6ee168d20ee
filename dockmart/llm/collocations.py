"""Phrase collocations by prefix-free parsing.

1. **Pieces.** A text is lower-cased (A-Z), cut at ``[.,;:!?]`` and line ends into pieces, and those at blanks into words. It
   becomes one sequence of words with a boundary mark between pieces and ``max_words - 1`` marks at its end.
2. **Prefix-free parsing.** Wherever the hash of ``max_words - 1`` consecutive marks and words is a multiple of
   ``MODULUS``, a chunk ends behind this window and the next one begins with it, so neighbours overlap by the window. Where
   to cut depends on the content alone: equal passages give equal chunks in whatever document they stand. The chunks form
   a dictionary: (lang, chunk, how often the parse uses it).
3. **Counting.** Phrases are counted inside distinct chunks, weighted with their frequencies. A phrase belongs to the chunk
   where it begins before the last window, so each occurrence is counted once, and none crosses a chunk's end.
4. **Levels.** A phrase is at most as frequent as its parts. Phrases of n words are counted where both their parts of n-1
   words pass a Bloom filter of the frequent ones, at most 64 MB whatever the input. What passes wrongly is dropped by its
   exact count; a full filter drops nothing, and the result is the same. Hashes only find equal phrases within one
   buffer, 128 bits of them; counts are kept by the phrase itself.

Scale: the texts are read once; the dictionary is combined before its shuffle and written as a table, which each level
reads. Counts are combined within a buffer, within a task and then by phrase, so a very frequent word, phrase, line or
language is one row of each task. Joins of candidates with the counts of their parts can be hot on a frequent first word;
adaptive skew handling splits them. Languages are ranked by Spark's limited window: a task hands on ``top`` rows a language.

Edge cases: a null text is empty; a null lang counts as ``und``, together with texts whose lang is ``und``. Empty texts have
no words; a language without candidates gives no row. Very long texts, words and chunks are whole. Rows that repeat count
again; doc_id is not read. Ties are ordered by the phrase's bytes. Extra columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockmart.llm.common import mix64, staged
from dockmart.llm.substring_dedup import _may_hold, bloom_filter

#: One window in so many ends a chunk.
MODULUS = 32
#: Text that one step works on; memory does not follow the batch.
_PART_BYTES = 4 << 20
_MARK = b"\n"
_TO_MARKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")

_CHUNKS = "lang string, chunk string, n long, words long"
_COUNTS = "lang string, phrase string, f long"


@dataclass(frozen=True)
class Tokens:
    """The words and marks of several texts or chunks that were joined with blanks."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    owner: np.ndarray  # the text of each token
    mark: np.ndarray  # is it a boundary mark?


def normalise(text: bytes, window: int) -> bytes:
    """Lower-case words, one blank between them, ``\\n`` as a word of its own between pieces and ``window`` times at the end."""
    pieces = (b" ".join(p.split()) for p in text.lower().translate(_TO_MARKS).split(_MARK))
    return b" \n ".join([p for p in pieces if p] + [b" ".join([_MARK] * window)])


def tokenise(parts: list[bytes]) -> tuple[bytes, Tokens]:
    joined = b" ".join(parts)
    data = np.frombuffer(joined, np.uint8)
    blanks = np.flatnonzero(data == 32)
    start, end = np.concatenate(([0], blanks + 1)), np.concatenate((blanks, [len(data)]))
    first = np.searchsorted(start, np.cumsum([0] + [len(p) + 1 for p in parts]))
    owner = np.repeat(np.arange(len(parts)), np.diff(first))
    return joined, Tokens(data, start, end, owner, (end - start == 1) & (data[start] == 10))


#: An odd factor and its inverse modulo 2**64, and bytes that one step hashes.
_ODD = 0x9E3779B97F4A7C15
_STEP = 1 << 18


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def hash_words(t: Tokens, seed: int) -> np.ndarray:
    """A 64-bit hash of each token: a polynomial over its bytes, read off running sums, mixed with its length."""
    table = mix64(np.arange(1, 257, dtype=np.uint64) + np.uint64(seed << 32))
    out = np.empty(len(t.start), np.uint64)
    i = 0
    while i < len(out):
        low = int(t.start[i])
        j = max(i + 1, int(np.searchsorted(t.end, low + _STEP, side="right")))
        size = int(t.end[j - 1]) - low
        up, down = (_powers(x, max(_STEP, size) + 1) for x in (_ODD, pow(_ODD, -1, 1 << 64)))
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(table[t.data[low : low + size]] * up[:size], out=sums[1:])
        a, b = t.start[i:j] - low, t.end[i:j] - low
        out[i:j] = (sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)
        i = j
    return mix64(out)


def hash_grams(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` words, given the words' hashes."""
    count = max(0, len(words) - n + 1)
    out = words[:count].copy()
    for k in range(1, n):
        out *= np.uint64(_ODD)
        out += words[k : k + count]
    return mix64(out + np.uint64(n))


def parse(texts: list[bytes], window: int, modulus: int = MODULUS) -> Iterator[tuple[int, bytes, int]]:
    """(text number, chunk, words that begin in it) of normalised texts."""
    joined, t = tokenise(texts)
    words = hash_words(t, 1)
    first = np.flatnonzero(np.diff(t.owner, prepend=-1))
    final = np.append(first[1:], len(t.start)) - window  # the marks at the end of each text
    cut = np.zeros(len(t.start), bool)
    cut[: len(t.start) - window + 1] = hash_grams(words, window) % np.uint64(modulus) == 0
    for k in range(1, window):  # no window reaches beyond its text
        cut[final + k] = False
    cut[first] = cut[final] = True
    at = np.flatnonzero(cut)
    begins = ~np.isin(at, final)
    begin, stop = at[begins], at[np.flatnonzero(begins) + 1]
    before = np.concatenate(([0], np.cumsum(~t.mark)))
    rows = zip(t.owner[begin].tolist(), t.start[begin].tolist(), t.end[stop + window - 1].tolist(), (before[stop] - before[begin]).tolist())
    for owner, a, b, n in rows:
        yield owner, joined[a:b], n


def _buffers(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[list[pa.RecordBatch]]:
    """Slices of the batches with about ``_PART_BYTES`` of text together (a longer text is a buffer of its own)."""
    held, size = [], 0
    for batch in batches:
        a = 0
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
        for i, n in enumerate(lengths.tolist()):
            size += n
            if size >= _PART_BYTES:
                yield [*held, batch.slice(a, i + 1 - a)]
                held, size, a = [], 0, i + 1
        if a < batch.num_rows:
            held.append(batch.slice(a))
    if held:
        yield held


def dictionary(docs: DataFrame, window: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, chunk, n, words): the distinct chunks, how often the parse uses each, and the words that begin in it."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _buffers(batches, 1):
            langs = [x for b in held for x in b.column(0).to_pylist()]
            texts = [normalise(x.as_py(), window) for b in held for x in b.column(1)]
            counted = Counter((langs[i], chunk, n) for i, chunk, n in parse(texts, window))
            if counted:
                lang, chunk, n = zip(*counted)
                columns = [pa.array(lang, pa.string()), pa.array(chunk, pa.binary()).cast(pa.string()), pa.array(list(counted.values()), pa.int64()), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "chunk", "n", "words"])

    chunks = rows.filter(F.length("text") > 0).mapInArrow(run, _CHUNKS)
    return chunks.groupBy("lang", "chunk").agg(F.sum("n").alias("n"), F.max("words").alias("words")).filter("words > 0")


def _lang_seeds(langs: list[str]) -> np.ndarray:
    """A 64-bit value for each row's language."""
    names, at = np.unique(np.array(langs, object), return_inverse=True)
    raw = [np.frombuffer(x.encode() or b"\0", np.uint8) for x in names.tolist()]
    ends = np.cumsum([len(x) for x in raw])
    known = Tokens(np.concatenate(raw), ends - np.array([len(x) for x in raw]), ends, at, at)
    return hash_words(known, 3)[at]


def _phrases(words: np.ndarray, langs: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the phrases of ``n`` words that begin at each token, the language included."""
    grams = hash_grams(words, n)
    return grams ^ langs[: len(grams)]


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - start
    offsets = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    return pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[at])])


def _count_buffer(langs: list[str], chunks: list[bytes], used: np.ndarray, n: int, window: int, known: np.ndarray | None) -> pa.RecordBatch | None:
    _, t = tokenise(chunks)
    stop = np.append(np.flatnonzero(np.diff(t.owner)) + 1, len(t.start))
    # a phrase that begins in the last window is the next chunk's
    ok = np.arange(len(t.start)) < (stop - window)[t.owner]
    for k in range(n):
        ok[: len(t.start) - k] &= ~t.mark[k:]
    words, seeds = hash_words(t, 1), _lang_seeds(langs)[t.owner]
    if known is not None:
        part = _may_hold(known, _phrases(words, seeds, n - 1))
        ok[: len(part)] &= part
        ok[: len(part) - 1] &= part[1:]
    at = np.flatnonzero(ok)
    if not len(at):
        return None
    keys = _phrases(words, seeds, n)[at]
    order = np.argsort(keys)
    at, keys = at[order], keys[order]
    new = np.diff(keys, prepend=~keys[:1]) != 0
    if not new.all():  # an independent hash tells different phrases with one hash apart
        other = _phrases(hash_words(t, 2), seeds, n)[at]
        new |= np.diff(other, prepend=~other[:1]) != 0
    heads = np.flatnonzero(new)
    first = at[heads]
    found = [
        pa.array(langs, pa.string()).take(pa.array(t.owner[first])),
        _strings(t.data, t.start[first], t.end[first + n - 1]),
        pa.array(np.add.reduceat(used[t.owner[at]], heads)),
    ]
    return pa.RecordBatch.from_arrays(found, ["lang", "phrase", "f"])


def count_phrases(chunks: DataFrame, n: int, window: int, known=None) -> DataFrame:
    """(lang, phrase, f) of the phrases of ``n`` words; ``known``: a broadcast filter that both their parts must pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = known.value if known is not None else None
        for held in _buffers(batches, 1):
            langs = [x for b in held for x in b.column(0).to_pylist()]
            texts = [x.as_buffer().to_pybytes() for b in held for x in b.column(1)]
            out = _count_buffer(langs, texts, np.concatenate([b.column(2).to_numpy() for b in held]), n, window, packed)
            if out is not None:
                yield out

    counted = chunks.select("lang", F.col("chunk").cast("binary").alias("chunk"), "n").mapInArrow(run, _COUNTS)
    return counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _filter_of(phrases: DataFrame, n: int):
    """A broadcast Bloom filter of frequent phrases of ``n`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _buffers(batches, 1):
            langs = [x for b in held for x in b.column(0).to_pylist()]
            _, t = tokenise([x.as_buffer().to_pybytes() for b in held for x in b.column(1)])
            first = np.flatnonzero(np.diff(t.owner, prepend=-1))
            keys = _phrases(hash_words(t, 1), _lang_seeds(langs)[t.owner], n)[first]
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["mh"])

    keys = phrases.select("lang", F.col("phrase").cast("binary").alias("phrase")).mapInArrow(run, "mh long")
    return phrases.sparkSession.sparkContext.broadcast(bloom_filter(keys))


def frequent_phrases(chunks: DataFrame, max_words: int, least: int) -> DataFrame:
    """(lang, phrase, f, size) of all phrases of up to ``max_words`` words with f >= ``least``, counted level by level."""
    out, known = None, None
    for n in range(1, max_words + 1):
        level = staged(count_phrases(chunks, n, max_words - 1, known).filter(F.col("f") >= least), f"phrases-{n}")
        out = level.withColumn("size", F.lit(n)) if out is None else out.unionByName(level.withColumn("size", F.lit(n)))
        if n < max_words:
            known = _filter_of(level, n)
    return out


def weakest_cuts(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score): the lowest-scoring cut of each phrase of two or more words."""
    words = F.split("phrase", " ")
    cuts = phrases.filter("size > 1").select("lang", "phrase", F.col("f").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("tail"),
    )
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = phrases.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    score = F.expr("(cast(a as decimal(19,0)) * 2000000) div (cast(l as decimal(19,0)) + r)")
    scored = scored.withColumn("score", score.cast("long"))
    worst = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return worst.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def covered_phrases(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, cover): the most frequent longer phrase that holds a phrase of two or more words."""
    longer = phrases.filter("size > 2").select("lang", "f", "size", F.split("phrase", " ").alias("w"))
    parts = longer.select("lang", "f", "w", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
    parts = parts.select("lang", "f", "w", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("at"))
    parts = parts.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("m")), " ").alias("phrase"), "f")
    return parts.groupBy("lang", "phrase").agg(F.max("f").alias("cover"))


def collocations(docs: DataFrame, max_words: int = 4, least: int = 30, covered_percent: int = 80, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``max_words`` words.

    a = occurrences, at least ``least``; l and r = those of the two parts of the weakest cut, score = floor(2000000 a / (l + r));
    n = all words of the language. A phrase goes if a longer one that holds it has ``covered_percent`` of its occurrences.
    """
    if max_words < 2 or least < 1 or top < 1:
        raise ValueError("max_words must be at least 2, least and top at least 1")
    chunks = staged(dictionary(docs, max_words - 1), "parse")
    totals = chunks.groupBy("lang").agg(F.sum(F.col("n") * F.col("words")).alias("n"))
    phrases = frequent_phrases(chunks, max_words, least)
    kept = weakest_cuts(phrases).join(covered_phrases(phrases), ["lang", "phrase"], "left")
    kept = kept.filter(F.coalesce(F.expr(f"cast(cover as decimal(20,0)) * 100 < cast(a as decimal(20,0)) * {int(covered_percent)}"), F.lit(True)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = kept.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
