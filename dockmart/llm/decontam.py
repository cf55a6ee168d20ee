"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact verification.

Texts are lower-cased (A-Z) and ASCII punctuation becomes blanks; words are runs of anything but white space. An item
of L words is compared with every window of L words (a shorter document is one window). The shingles of both are their
runs of five words (all words, for shorter items), with their counts as weights.

1. **Windows.** A window that shares no shingle with any item has similarity 0, so only windows that hold an item's
   shingle are looked at; every start of such a window is. This loses nothing that the last check could accept.
2. **SimHash.** The fingerprint bit b of a window is set where the count-weighted majority of its shingle hashes has
   bit b. Windows that overlap share prefix sums of bit counts.
3. **Multi-index.** The 64 bits are cut into radius + 1 blocks, each with a table of the items' values. A fingerprint
   within ``radius`` of an item's agrees with it in at least one block (pigeonhole), so looking up all blocks finds all
   items of the window's size within the radius; the Hamming distance is then checked in full. Where few shingles carry an
   item's weight (two words in turn, one word many times), one changed shingle can decide a large part of the bits. Whether
   the radius allows for that is reckoned from the item's own bag (``miss_chance``); if not, the item is looked up by its
   shingles instead, and every window that shares one with it is verified.
4. **Verification.** Weighted Jaccard similarity of the two shingle bags, sum of least over sum of greatest counts, at
   least ``similarity``.

Scale: one pass over the documents for each block of at most ``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` bytes of item
text (a longer item is a block of its own); items are sorted by Spark and read one block at a time, and only such a block is
ever sent to the workers, so what is broadcast has a fixed bound however large the benchmark is. No shuffle, no state between documents: a lost executor repeats its own splits.

Edge cases: null or empty texts hold nothing; an item without words matches nothing; items that share an id count as
one, with their best match. Repeated documents each get their own matches. Extra columns are ignored. Empty tables give
an empty result.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmart.llm.common import gram_hashes, staged, word_hashes, word_spans

SHINGLE = 5
SIMILARITY = 0.8
#: Bits. Where many shingles of like weight make up a bag, one of similarity 0.8 has a cosine of about 0.89, which flips 9.7
#: of 64 bits on average with a standard deviation of 2.9; 18 is nearly three deviations above (see ``miss_chance``).
RADIUS = 18
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 16 << 20

_NORMAL = bytes(
    32 if 33 <= c < 48 or 58 <= c < 65 or 91 <= c < 97 or 123 <= c < 127 else c + 32 if 65 <= c <= 90 else c
    for c in range(256)
)
_FILTER_BITS = 20


def _words(data: bytes) -> np.ndarray:
    clean = data.translate(_NORMAL)
    return word_hashes(clean, word_spans(clean))


def _bits(hashes: np.ndarray) -> np.ndarray:
    """(n, 64) of 0 and 1."""
    raw = np.ascontiguousarray(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little")


def _pack(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def simhash(hashes: np.ndarray) -> int:
    """The majority fingerprint of a bag of shingle hashes (repeats count)."""
    return int(_pack((2 * _bits(hashes).sum(0, dtype=np.int64) > len(hashes))[None, :].astype(np.uint8))[0])


#: Random shingle values from which the share of changed bits is reckoned, and the chance of a miss that is allowed.
_DRAWS = 4096
MISS = 0.005


def miss_chance(weights: list[int], similarity: float, radius: int) -> float:
    """The chance that a bag at ``similarity`` to one with these weights differs in more than ``radius`` bits.

    The bag gives up the weight that the similarity allows, its lightest shingles or its heaviest ones first, for new
    shingles of the same weights; the worse of both counts.
    """
    w = np.sort(np.asarray(weights, np.int64))
    spare = int(w.sum() * (1 - similarity) / (1 + similarity) + 1e-9)
    if not spare:
        return 0.0
    rng = np.random.default_rng([len(w), int(w.sum()), spare])
    old, new = (rng.integers(0, 2, (_DRAWS, len(w)), np.int8).astype(float) * 2 - 1 for _ in range(2))
    share = 0.0
    for order in (w, w[::-1]):
        lost = np.minimum(order, np.maximum(0, spare - (np.cumsum(order) - order)))
        share = max(share, float(((old @ order > 0) != (old @ (order - lost) + new @ lost > 0)).mean()))
    return sum(math.comb(64, k) * share**k * (1 - share) ** (64 - k) for k in range(radius + 1, 65))


def _groups(texts: Iterator[bytes], most: int = 2 << 20) -> Iterator[list[bytes]]:
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


class ItemIndex:
    """A block of benchmark items, ready to search documents with."""

    def __init__(self, items: list[tuple[int, bytes]], shingle: int, radius: int, similarity: float):
        self.shingle, self.radius, self.similarity = shingle, radius, similarity
        edges = [64 * k // (radius + 1) for k in range(radius + 2)]
        self.blocks = [(a, (1 << (b - a)) - 1) for a, b in zip(edges, edges[1:], strict=False)]
        self.items: list[tuple[int, int, Counter]] = []  # id, fingerprint, bag
        # words in the window -> block -> value -> items
        self.tables: dict[int, list[dict[int, list[int]]]] = {}
        # words in the window -> shingle's hash -> items that few shingles carry
        self.carried: dict[int, dict[int, list[int]]] = {}
        allowed: dict[tuple[int, ...], bool] = {}
        grams: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))  # shingle -> hash -> sizes
        for item_id, text in items:
            words = _words(text)
            size = len(words)
            if not size:
                continue
            n = min(shingle, size)
            hashes = gram_hashes(words, n, seed=n)
            fp, bag = simhash(hashes), Counter(hashes.tolist())
            weights = tuple(sorted(bag.values()))
            if weights not in allowed:
                allowed[weights] = miss_chance(weights, similarity, radius) <= MISS
            table = self.tables.setdefault(size, [defaultdict(list) for _ in self.blocks])
            for (at, mask), values in zip(self.blocks, table, strict=True):
                values[fp >> at & mask].append(len(self.items))
            if not allowed[weights]:
                by_gram = self.carried.setdefault(size, defaultdict(list))
                for h in bag:
                    by_gram[h].append(len(self.items))
            self.items.append((item_id, fp, bag))
            for h in hashes.tolist():
                grams[n][h].add(size)
        self.grams = {n: (np.array(sorted(found), np.uint64), {h: sorted(s) for h, s in found.items()}) for n, found in grams.items()}
        self.filters = {}
        for n, (known, _) in self.grams.items():
            seen = np.zeros(1 << _FILTER_BITS, bool)
            seen[known & np.uint64((1 << _FILTER_BITS) - 1)] = True
            self.filters[n] = seen

    def _hits(self, grams: np.ndarray, n: int) -> dict[int, list[int]]:
        """Window size -> positions of shingles that an item of this size holds."""
        maybe = np.flatnonzero(self.filters[n][grams & np.uint64((1 << _FILTER_BITS) - 1)])
        known, sizes = self.grams[n]
        out: dict[int, list[int]] = defaultdict(list)
        for p in maybe[np.isin(grams[maybe], known)].tolist():
            for size in sizes[int(grams[p])]:
                out[size].append(p)
        return out

    def candidates(self, texts: list[bytes]) -> list[bool]:
        """Which of several texts hold a shingle of an item; the others cannot match."""
        joined = b"\n".join(texts).translate(_NORMAL)
        spans = word_spans(joined)
        words = word_hashes(joined, spans)
        text_of = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), spans[0], side="right")
        out = np.zeros(len(texts), bool)
        for n in self.grams:
            grams = gram_hashes(words, n, seed=n)
            maybe = np.flatnonzero(self.filters[n][grams & np.uint64((1 << _FILTER_BITS) - 1)])
            maybe = maybe[text_of[maybe] == text_of[maybe + n - 1]]
            out[text_of[maybe[np.isin(grams[maybe], self.grams[n][0])]]] = True
        return out.tolist()

    def search(self, texts: Iterator[bytes]) -> Iterator[list[tuple[int, float, int, int, int]]]:
        """The matches of each text, a bounded number of bytes looked at together."""
        for group in _groups(texts):
            for text, hit in zip(group, self.candidates(group), strict=True):
                yield self.matches(text) if hit else []

    def matches(self, data: bytes) -> list[tuple[int, float, int, int, int]]:
        """(item_id, similarity, first word, words, Hamming distance) of the best window for each item found."""
        words = _words(data)
        best: dict[int, tuple[float, int, int, int]] = {}
        for n in self.grams:
            if len(words) < n:
                continue
            grams = gram_hashes(words, n, seed=n)
            for size, places in self._hits(grams, n).items():
                self._windows(grams, n, size, places, best)
        return [(item, *found) for item, found in sorted(best.items())]

    def _windows(self, grams: np.ndarray, n: int, size: int, places: list[int], best: dict) -> None:
        count = min(size - n + 1, len(grams))  # shingles in a window
        at = np.asarray(places)
        carried = self.carried.get(size)
        starts = np.unique(np.concatenate([np.clip(at - d, 0, len(grams) - count) for d in range(count)]))
        for a in range(0, len(starts), 4096):
            part = starts[a : a + 4096]
            low = part[0]
            rows = np.unique((part[:, None] + np.arange(count)[None, :]).ravel())
            place = np.zeros(rows[-1] - low + 2, np.int64)  # of a shingle among the rows looked at
            place[rows - low + 1] = 1
            place = np.cumsum(place)
            sums = np.concatenate((np.zeros((1, 64), np.int64), np.cumsum(_bits(grams[rows]), axis=0, dtype=np.int64)))
            ones = sums[place[part - low + count]] - sums[place[part - low]]
            fps = _pack((2 * ones > count).astype(np.uint8)).tolist()
            for start, fp in zip(part.tolist(), fps, strict=True):
                near = {i for (bit, mask), t in zip(self.blocks, self.tables[size], strict=True) for i in t.get(fp >> bit & mask, ())}
                near = {i for i in near if (self.items[i][1] ^ fp).bit_count() <= self.radius}
                if carried:
                    near.update(i for h in set(grams[start : start + count].tolist()) for i in carried.get(h, ()))
                if not near:
                    continue
                bag = Counter(grams[start : start + count].tolist())
                for i in near:
                    item_id, item_fp, other = self.items[i]
                    least = sum(min(c, other[h]) for h, c in bag.items() if h in other)
                    score = least / (sum(bag.values()) + sum(other.values()) - least)
                    found = (score, -start, size, (item_fp ^ fp).bit_count())
                    if score >= self.similarity and (item_id not in best or found > _key(best[item_id])):
                        best[item_id] = (score, start, count + n - 1, found[3])


def _key(found: tuple[float, int, int, int]) -> tuple[float, int]:
    return found[0], -found[1]


def item_blocks(benchmark: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, similarity: float = SIMILARITY) -> Iterator[ItemIndex]:
    """The benchmark (item_id, text), one block of bounded size at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    items = items.filter("item_id is not null and text is not null")
    block, size = [], 0
    for row in staged(items, "items").orderBy("item_id", "text").toLocalIterator():
        text = bytes(row["text"])
        if block and (len(block) >= BLOCK_ITEMS or size + len(text) > BLOCK_BYTES):
            yield ItemIndex(block, shingle, radius, similarity)
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    if block:
        yield ItemIndex(block, shingle, radius, similarity)


_MATCH = "doc_id long, item_id long, similarity double, first_word long, n_words long, hamming int"


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, similarity: float = SIMILARITY
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words, hamming): the best window of each document for each item in it."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    out = docs.sparkSession.createDataFrame([], _MATCH)
    for index in item_blocks(benchmark, shingle, radius, similarity):
        out = out.unionByName(narrow.mapInArrow(_matcher(docs.sparkSession.sparkContext.broadcast(index)), _MATCH))
    return out


def _matcher(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            texts = (t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(1))
            rows = [(doc_id, *m) for doc_id, found in zip(batch.column(0).to_pylist(), index.search(texts), strict=True) for m in found]
            names = [c.split()[0] for c in _MATCH.split(", ")]
            frame = pd.DataFrame(rows, columns=names).astype({"hamming": "int32", "similarity": "float64"})
            yield pa.RecordBatch.from_pandas(frame, schema=_MATCH_SCHEMA, preserve_index=False)

    return run


_MATCH_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("similarity", pa.float64()),
        ("first_word", pa.int64()),
        ("n_words", pa.int64()),
        ("hamming", pa.int32()),
    ]
)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, similarity: float = SIMILARITY
) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns kept."""
    for index in item_blocks(benchmark, shingle, radius, similarity):
        docs = docs.filter(_cleanness(docs.sparkSession.sparkContext.broadcast(index))(F.col("text").cast("binary")))
    return docs


def _cleanness(shared):
    @F.pandas_udf("boolean")
    def clean(text: pd.Series) -> pd.Series:
        index = shared.value
        return pd.Series([not found for found in index.search(b"" if x is None else bytes(x) for x in text)], dtype=bool)

    return clean
