"""SimHash near-duplicate groups, candidates pruned by the pigeonring principle.

A document's fingerprint has bit b set where more than half of its shingle hashes have bit b set. Two
fingerprints link if they differ in at most ``max_bits`` bits.

**Pigeonring.** Cut the 64 bits into m = max_bits + 1 segments standing on a ring. If the m segment distances
sum to at most max_bits, some starting segment i has, for every chain length l = 1..m, a sum over the l segments
from i of at most l * max_bits / m, that is l - 1 after rounding down. So a linked pair agrees *exactly* on
segment i, differs by at most one bit in the two segments from i on, by at most two in three, and so on. The
first two conditions become an equi-join: one side carries (i, segment i, segment i+1), the other also carries
every one-bit change of segment i+1. The longer chains are conditions of that join; the full Hamming distance
is the last of them, so nothing but true links leaves the join. No bucket is capped.

Scale: fingerprints are computed once and written to the shared folder; links are searched between *distinct*
fingerprints only, so a group of a billion equal copies is one fingerprint. The per-fingerprint minimum is
combined before the shuffle. Rows get their component by a shuffle join, except those of fingerprints that hold more than a
thousandth of all rows each: there are fewer than a thousand of these, so their components are broadcast and no task
takes a whole group of copies. A bucket that many distinct fingerprints share is split by adaptive skew handling.
Components come from alternating large-star and small-star rounds on links alone, each round written down.

Edge cases: a null or empty text, or one of white space only, has no words and fingerprint zero, which links like
any other; a text of fewer words than a shingle is one shingle. Repeated rows stay rows. A null doc_id never names
a component; a component of null ids only has a null component_id. Extra columns are ignored. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmart.llm.common import staged

SEED = 42
_FINGERPRINT_CHUNK = 1 << 15  # shingle hashes unpacked to bits at a time
#: A fingerprint is hot if it holds more than one row in so many; so fewer fingerprints than this are hot.
HOT = 1000


def _fingerprint(data: bytes, shingle: int) -> int:
    words = data.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
        stops = ends[shingle - 1 :].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)]
    values = np.array(hashes, dtype="<u8")
    counts = np.zeros(64, np.int64)
    for k in range(0, len(values), _FINGERPRINT_CHUNK):
        part = values[k : k + _FINGERPRINT_CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(values)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, hashed: bool = False) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed 64-bit integer. ``hashed`` adds th, the text's hash.

    Only A-Z are lower-cased: ``bytes.lower`` on UTF-8 leaves all other characters alone.
    """
    if shingle < 1:
        raise ValueError("shingle must be at least 1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [_fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle) for x in batch.column(1)]
            columns = [batch.column(0), pa.array(fps, pa.int64()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", "th"][: len(columns)])

    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")]
    if hashed:
        columns.append(F.xxhash64("text").alias("th"))
    return docs.select(columns).mapInArrow(run, "doc_id long, fp long" + ", th long" * hashed)


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(offset, width) of the max_bits + 1 segments of the ring."""
    m = max_bits + 1
    edges = [64 * k // m for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _mask(segments: list[tuple[int, int]], start: int, length: int) -> int:
    """The bits of ``length`` consecutive segments from ``start``, as a signed 64-bit number."""
    bits = 0
    for k in range(length):
        at, width = segments[(start + k) % len(segments)]
        bits |= ((1 << width) - 1) << at
    return bits - (1 << 64) if bits >> 63 else bits


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """(u, v), u < v: the pairs of distinct fingerprints in column ``fp`` at most ``max_bits`` bits apart."""
    if not 0 <= max_bits <= 15:
        raise ValueError("max_bits must be between 0 and 15")
    # a set number of partitions: each row becomes dozens below, so few small partitions must not be merged before that
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = fps.select("fp").repartition(parts, "fp").distinct()
    if max_bits == 0:
        return distinct.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    segments = _segments(max_bits)
    m = len(segments)
    fp = F.col("fp")

    def key(i: int) -> Column:
        return fp.bitwiseAND(F.lit(_mask(segments, i, min(2, m))))

    exact = distinct.select(
        "fp", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), key(i).alias("k")) for i in range(m)])).alias("e")
    ).select("e.i", "e.k", F.col("fp").alias("v"))

    flips = []
    for i in range(m):
        at, width = segments[(i + 1) % m]
        changes = [0] + [_signed(1 << (at + b)) for b in range(width)]
        flips += [F.struct(F.lit(i).alias("i"), key(i).bitwiseXOR(F.lit(c)).alias("k")) for c in changes]
    probes = distinct.select("fp", F.explode(F.array(*flips)).alias("e")).select("e.i", "e.k", F.col("fp").alias("u"))

    differ = F.col("u").bitwiseXOR(F.col("v"))
    chain = F.lit(True)
    for length in range(3, m):
        masks = F.element_at(F.array(*[F.lit(_mask(segments, i, length)) for i in range(m)]), F.col("p.i") + 1)
        chain = chain & (F.bit_count(differ.bitwiseAND(masks)) <= length - 1)
    found = probes.alias("p").join(
        exact.alias("x"),
        (F.col("p.i") == F.col("x.i"))
        & (F.col("p.k") == F.col("x.k"))
        & (F.col("u") < F.col("v"))
        & chain
        & (F.bit_count(differ) <= max_bits),
    )
    return found.select("u", "v").distinct()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of the edge list (u, v).

    Alternates large-star and small-star until the edge set no longer changes; the count and the sum of hashes
    of the edges (one row) decide that. Each round is one table in the shared folder.
    """
    now = staged(edges.select("u", "v").filter(F.col("u") != F.col("v")), "edges")
    state = _edge_state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.filter(F.col("a") != F.col("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("a")), F.struct(F.col("u").alias("a")))).alias("s"), "m")
            .select(F.col("s.a").alias("u"), F.col("m").alias("v"))
            .filter(F.col("u") != F.col("v"))
            .distinct()
        )
        now = staged(small, "edges")
        after = _edge_state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _edge_state(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.bit_xor(hashed), F.sum(F.pmod(hashed, F.lit(1 << 31)))).first()
    return tuple(row)


def near_duplicate_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per input row: doc_id, fp, component_id (the smallest doc_id reachable, itself included)."""
    table = staged(fingerprints(docs, shingle), "fingerprints")
    owners = staged(table.groupBy("fp").agg(F.min("doc_id").alias("owner"), F.count("*").alias("rows")), "owners")
    if max_bits == 0:
        return _with_component(table, owners.select("fp", "rows", F.col("owner").alias("component_id")))
    member = _members(owners, max_bits)
    owned = member.join(owners, member["node"] == owners["fp"]).select("node", "root", "owner")
    smallest = owned.groupBy("root").agg(F.min("owner").alias("component_id"))
    linked = owned.join(smallest, "root").select(F.col("node").alias("fp"), "component_id")
    roots = owners.join(linked, "fp", "left").select("fp", "rows", F.coalesce("component_id", "owner").alias("component_id"))
    return _with_component(table, staged(roots, "roots"))


def _members(fps: DataFrame, max_bits: int) -> DataFrame:
    """(node, root): every linked fingerprint of column ``fp`` with its root; the root itself is a member too."""
    tree = staged(components(links(fps, max_bits)), "components")
    return tree.unionByName(tree.select(F.col("root").alias("node"), "root")).distinct()


def _with_component(table: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of ``table`` with the component of their fingerprint; ``rows`` says how many rows a fingerprint holds."""
    total = roots.agg(F.sum("rows")).first()[0] or 0
    is_hot = F.col("rows") * HOT > total
    hot = roots.filter(is_hot).select("fp", "component_id")  # fewer than HOT rows
    rest = table.join(F.broadcast(hot.select("fp")), "fp", "left_anti").join(roots.filter(~is_hot), "fp")
    columns = ["doc_id", "fp", "component_id"]
    return table.join(F.broadcast(hot), "fp").select(columns).unionByName(rest.select(columns))


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one_per_group(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """One row of each group of linked fingerprints, all columns kept: the one with the smallest doc_id.

    Groups are told apart by their root fingerprint and rows by (doc_id, hash of the text), so rows of one doc_id with
    unlike texts stay in groups of their own. Where the smallest doc_id repeats in its group, the row with the smallest
    hash of its text stays. A row with a null doc_id comes after all others: it stays where its group has no row with an id,
    and of several such rows the one with the smallest hash.
    """
    table = fingerprints(docs, shingle, hashed=True)
    copies = staged(table.groupBy("doc_id", "th", "fp").agg(F.count("*").alias("rows")), "copies")
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th", "rows")
    best = staged(copies.groupBy("fp").agg(F.min(row).alias("best"), F.sum("rows").alias("rows")), "best")
    rooted = best.select("fp", "best", F.col("fp").alias("root"))
    if max_bits > 0:
        member = _members(best, max_bits)
        rooted = best.join(member, best["fp"] == member["node"], "left").select("best", F.coalesce("root", "fp").alias("root"))
    chosen = rooted.groupBy("root").agg(F.min("best").alias("best"))
    chosen = staged(chosen.select(F.col("best.doc_id").alias("kept_id"), F.col("best.th").alias("kept_hash"), "best.rows"), "chosen")

    def same(rows: DataFrame) -> Column:
        return docs["doc_id"].cast("long").eqNullSafe(rows["kept_id"]) & (F.xxhash64(docs["text"]) == rows["kept_hash"])

    # equal rows that are more than a thousandth of all: fewer than HOT, broadcast, so no task takes them all
    total = best.agg(F.sum("rows")).first()[0] or 0
    is_hot = F.col("rows") * HOT > total
    hot = copies.filter(is_hot).select(F.col("doc_id").alias("kept_id"), F.col("th").alias("kept_hash"))
    often = chosen.filter(is_hot)
    rest = docs.join(F.broadcast(hot), same(hot), "left_anti").join(chosen, same(chosen), "left_semi")
    kept = rest.unionByName(docs.join(F.broadcast(often), same(often), "left_semi"))
    if not chosen.filter("rows > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept
