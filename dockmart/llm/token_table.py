"""Token ids of whole texts as a Parquet table for selective reads.

**File format.** One row per document in ascending doc_id order, in files that follow each other in doc_id order:
``doc_id``, ``n_tokens``, ``part`` (number of the file's range), ``part_start`` (ids of the range's earlier
documents) and ``ids``, a list column. ``ids`` is dictionary encoded (a vocabulary of 49k needs 16 bits an id,
bit-packed) where a row group's dictionary stays within its page, plain otherwise; the number columns are delta
encoded (DELTA_BINARY_PACKED), as they ascend or vary little. Row groups and pages have set sizes; Parquet's column
and offset indexes are written, so a filter on doc_id opens the pages it needs, and a metadata read (doc_id, n_tokens)
leaves the id pages alone.

**Plan.** Borders between ranges of (doc_id, text hash) come from a bounded sample of these two columns. One Arrow pass
encodes each text where it is read; what travels to its range is two bytes an id (four where the vocabulary needs them), and
equal rows that follow each other travel once with their number. There the rows are sorted, and a second pass numbers them;
Spark's own Parquet writer commits the files (a lost executor's task is redone, its half file never seen). Where a
range starts is the sum of the ranges before it: one row per range, read from the metadata columns only.

**Encoding.** The vocabulary lower-cases, drops white space and never joins across it, nor across the border between a
letter and the punctuation after it; so a text's ids are the ids of its words, and a word's those of its letters and of
the punctuation at its end, one after another (checked against whole-text encoding in the tests). Each worker keeps the ids
of the parts it has met, up to ``CACHE_PARTS``, then starts over; new parts go through the tokenizers library, plain
Latin letters straight to its model, all others through its whole encoding. Words are cut at blank, tab, line feed, vertical tab,
form feed and carriage return only; a longer stretch is one "word", whatever it holds.

Edge cases: a null text is empty: only the end id. Repeated doc_ids are ordered by a hash of their texts; null doc_ids
come first. Extra columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import bisect
import itertools
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from dockmart.llm.common import new_path, word_spans

END_ID = 1
#: Parts of words whose ids a worker remembers (about 200 bytes each).
CACHE_PARTS = 400_000
#: Bytes of text that are encoded together.
TOGETHER = 6 << 20
#: Ids that one Arrow batch may hold before it is handed on.
BATCH_IDS = 1 << 20

FORMAT = "doc_id long, n_tokens long, part int, part_start long, ids array<int>"

_CACHE: dict[str, dict[bytes, bytes]] = {}
_TOKENIZERS: dict[str, object] = {}


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public vocabulary lies on this machine (each worker asks for itself)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _encoder(path: str | None):
    key = path or ""
    if key not in _TOKENIZERS:
        from tokenizers import Tokenizer

        _TOKENIZERS[key] = Tokenizer.from_file(path or vocabulary_path())
        _CACHE[key] = {}
    return _TOKENIZERS[key], _CACHE[key]


_PUNCTUATION = np.isin(np.arange(256), np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8))


def _part_bounds(raw: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Where the parts of words begin, and the end of the last one.

    ``raw`` holds the bytes of lower-case words without the white space between them, ``words`` where each begins and the
    end of the last. A word that ends in a Latin letter and then ASCII punctuation is cut between the two.
    """
    begins, ends = words[:-1], words[1:]
    punctuation = _PUNCTUATION[raw]
    letters = np.maximum.accumulate(np.where(punctuation, -1, np.arange(len(raw), dtype=np.int64)))
    some = np.flatnonzero(punctuation[ends - 1])
    begins, last = begins[some], letters[ends[some] - 1]  # the last byte before the punctuation at the end
    held = last >= begins
    begins, last = begins[held], last[held]
    byte = raw[last]
    cut = (byte >= ord("a")) & (byte <= ord("z"))
    # two bytes make a letter from U+00DF to U+024F; not the division sign, nor U+0130, which lower-cases to a letter and a mark
    code = ((raw[last - 1].astype(np.int64) & 0x1F) << 6) | (byte & 0x3F)
    pair = (last > begins) & (byte & 0xC0 == 0x80) & (raw[last - 1] >= 0xC3) & (raw[last - 1] <= 0xC9)
    cut |= pair & (code >= 0xDF) & (code <= 0x24F) & (code != 0xF7) & (code != 0x130)
    return np.sort(np.concatenate((words, last[cut] + 1)))


def _letters() -> dict[int, str]:
    """How the library writes the bytes of each Latin letter, as it asks its model."""
    level = ByteLevel(add_prefix_space=False, use_regex=False)
    return {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x250) if c not in (0xF7, 0x130)}


_LETTERS = _letters()
_LATIN_WORD = re.compile("[a-z\u00df-\u00f6\u00f8-\u012f\u0131-\u024f]+")


def _learn(parts: list[bytes], tokenizer, cache: dict[bytes, bytes]) -> None:
    """Put the ids of ``parts`` into the cache."""
    others = []
    tokenize = tokenizer.model.tokenize
    for part in parts:
        if part.isalpha():  # for bytes: plain letters
            cache[part] = array("I", [t.id for t in tokenize(part.decode())]).tobytes()
            continue
        text = part.decode("utf-8").lower()
        if _LATIN_WORD.fullmatch(text):
            cache[part] = array("I", [t.id for t in tokenize(text.translate(_LETTERS))]).tobytes()
        else:
            others.append(part)
    for a in range(0, len(others), 20_000):
        some = others[a : a + 20_000]
        found = tokenizer.encode_batch_fast([w.decode("utf-8") for w in some], add_special_tokens=False)
        cache.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(some, found, strict=True))


def _with_special(text: bytes, special: list[bytes], tokenizer, path: str | None, cache_parts: int | None) -> bytes:
    out = []
    for holds, words in itertools.groupby(text.split(), lambda w: any(s in w.lower() for s in special)):
        if holds:
            out += [np.array(tokenizer.encode(w.decode("utf-8"), add_special_tokens=False).ids, "<u4").tobytes() for w in words]
        else:
            out += encode_texts([b" ".join(words)], path, cache_parts)
    return b"".join(out)


def encode_texts(texts: list[bytes], path: str | None = None, cache_parts: int | None = None) -> list[bytes]:
    """The ids of each whole UTF-8 text as little-endian unsigned 32-bit integers.

    A word that holds the string of a special token is matched as it is written, so it goes to the library whole.
    """
    tokenizer, cache = _encoder(path)
    special = [t.content.lower().encode() for t in tokenizer.get_added_tokens_decoder().values()]
    lowered = [t.lower() for t in texts]
    if any(s in t for s in special for t in lowered):
        holds = [any(s in t for s in special) for t in lowered]
        rest = iter(encode_texts([t for t, h in zip(texts, holds, strict=True) if not h], path, cache_parts))
        return [
            _with_special(t, special, tokenizer, path, cache_parts) if h else next(rest)
            for t, h in zip(texts, holds, strict=True)
        ]
    if len(texts) == 1 and len(texts[0]) > 4 * TOGETHER and (cut := texts[0].rfind(b" ", 0, 2 * TOGETHER)) > 0:
        pieces = (texts[0][:cut], texts[0][cut:])
        return [b"".join(encode_texts([p], path, cache_parts)[0] for p in pieces)]
    if len(texts) > 1 and max(map(len, texts)) > 4 * TOGETHER:
        return [encode_texts([t], path, cache_parts)[0] for t in texts]
    joined = b"\n".join(lowered)
    starts, ends = word_spans(joined)
    if not len(starts):
        return [b""] * len(texts)
    # the words without the white space, cut into parts; equal parts get one number
    packed = joined.translate(None, b" \t\n\v\f\r")
    words = np.concatenate(([0], np.cumsum(ends - starts)))
    bounds = _part_bounds(np.frombuffer(packed, np.uint8), words)
    numbered = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(packed)]).dictionary_encode()
    parts = numbered.dictionary.to_pylist()
    new = [p for p in parts if p not in cache]
    if len(cache) + len(new) > (cache_parts or CACHE_PARTS):
        cache.clear()
        new = parts
    _learn(new, tokenizer, cache)
    ids = list(map(cache.__getitem__, parts))
    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    begins = np.cumsum(lengths) - lengths
    numbers = numbered.indices.to_numpy()
    size = lengths[numbers]
    after = np.cumsum(size)
    at = np.arange(after[-1]) + np.repeat(begins[numbers] - (after - size), size)
    flat = np.frombuffer(b"".join(ids), "<u4")[at]
    text_ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)
    parts_before = np.searchsorted(bounds, words[np.searchsorted(starts, text_ends)])
    edges = np.concatenate(([0], after))[np.concatenate(([0], parts_before))].tolist()
    return [flat[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]


def _together(batches: Iterator[pa.RecordBatch], together: int | None = None) -> Iterator[tuple[list, list[bytes], list[int]]]:
    """Keys (doc_id, text hash), texts and copies in groups of about ``TOGETHER`` bytes of text; equal rows that follow
    each other, as a mix repeats them, are one with their number."""
    keys, texts, copies, size = [], [], [], 0
    for batch in batches:
        for key, text in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), batch.column(2), strict=True):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            if keys and key == keys[-1] and data == texts[-1]:
                copies[-1] += 1
                continue
            if size >= (together or TOGETHER):
                yield keys, texts, copies
                keys, texts, copies, size = [], [], [], 0
            keys.append(key)
            texts.append(data)
            copies.append(1)
            size += len(data)
    if keys:
        yield keys, texts, copies


#: Rows that place each border between ranges.
_SAMPLE = 64

_ENCODED = "part int, doc_id long, th long, copies long, wide boolean, packed binary"


def range_borders(keys: DataFrame, parts: int) -> list[tuple]:
    """At most ``parts - 1`` keys (doc_id, th) that cut ``keys`` into ranges of about as many rows: from a sample of about
    ``_SAMPLE`` rows a range, whatever the table holds."""
    share = _SAMPLE * parts / max(1, keys.count())
    rows = keys.where(F.rand(9) < share).collect()
    ordered = sorted(_place(r["doc_id"], r["th"]) for r in rows)
    return sorted({ordered[len(ordered) * i // parts] for i in range(1, parts)}) if ordered else []


def _place(doc_id: int | None, th: int) -> tuple:
    """The order of keys: null ids first."""
    return (doc_id is not None, doc_id or 0, th)


def encode_rows(rows: DataFrame, borders: list[tuple], tokenizer: str | None, cache_parts: int | None, together: int | None) -> DataFrame:
    """(part, doc_id, th, copies, wide, packed) of (doc_id, th, text): the ids, in two bytes each where all fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts, copies in _together(batches, together):
            encoded = [np.frombuffer(x, "<u4") for x in encode_texts(texts, tokenizer, cache_parts)]
            wide = [bool(len(x)) and int(x.max()) >= 1 << 16 for x in encoded]
            packed = [(x if w else x.astype("<u2")).tobytes() for x, w in zip(encoded, wide)]
            part = [bisect.bisect_right(borders, _place(*k)) for k in keys]
            columns = [
                pa.array(part, pa.int32()),
                pa.array([k[0] for k in keys], pa.int64()),
                pa.array([k[1] for k in keys], pa.int64()),
                pa.array(copies, pa.int64()),
                pa.array(wide, pa.bool_()),
                pa.array(packed, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "th", "copies", "wide", "packed"])

    return rows.mapInArrow(run, _ENCODED)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    row_group_bytes: int = 16 << 20,
    page_bytes: int = 256 << 10,
    cache_parts: int | None = None,
    together: int | None = None,
) -> None:
    """Write the token table of ``docs`` (doc_id, text) to the folder ``path``.

    ``cache_parts`` and ``together`` trade a worker's memory for time (see ``CACHE_PARTS`` and ``TOGETHER``).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    encoded = encode_rows(rows, range_borders(rows.select("doc_id", "th"), parts), tokenizer, cache_parts, together)
    ordered = encoded.repartitionById(parts, "part").sortWithinPartitions("part", "doc_id", "th")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = None, 0
        ids: list[int | None] = []
        parts: list[int] = []
        starts: list[int] = []
        encoded: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(counts),
                    pa.array(parts, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(encoded))),
                ],
                ["doc_id", "n_tokens", "part", "part_start", "ids"],
            )

        for batch in batches:
            for i, (row_part, doc_id, _, copies, wide) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(5)))):
                if row_part != part:
                    part, done = row_part, 0
                tokens = np.frombuffer(batch.column(5)[i].as_buffer(), "<u4" if wide else "<u2").astype("<i4")
                tokens = np.append(tokens, np.int32(END_ID))
                for _ in range(copies):
                    ids.append(doc_id)
                    parts.append(part)
                    starts.append(done)
                    encoded.append(tokens)
                    done += len(tokens)
                    size += len(tokens)
                    if size >= BATCH_IDS:
                        yield flush()
                        ids, parts, starts, encoded, size = [], [], [], [], 0
        if ids:
            yield flush()

    (
        ordered.mapInArrow(run, FORMAT)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(page_bytes))
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#ids.list.element", "true")
        .option("parquet.dictionary.page.size", str(1 << 20))
        .parquet(path)
    )


def read_tokens(spark, path: str) -> DataFrame:
    """The rows of a token table with ``start``: how many ids all documents before this one have."""
    table = spark.read.schema(FORMAT).parquet(path)
    totals = table.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # one row a range, and so at most as many as the write had partitions: small whatever the ranges hold
    return table.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("part_start")).drop("part", "part_start", "base")


def digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows as ``read_tokens`` returns them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            counts, sums = [], []
            for i in range(batch.num_rows):
                raw = np.ascontiguousarray(lists[i].values.to_numpy(zero_copy_only=False), "<u4")
                counts.append(len(raw))
                sums.append(zlib.crc32(raw.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(
    docs: DataFrame, tokenizer: str | None = None, cache_parts: int | None = None, together: int | None = None
) -> DataFrame:
    """Write ``docs`` as a token table into the shared folder and return it as read back, with ``start``."""
    spark = docs.sparkSession
    path = new_path(spark, "tokens")
    write_tokens(docs, path, tokenizer, cache_parts=cache_parts, together=together)
    return read_tokens(spark, path)
