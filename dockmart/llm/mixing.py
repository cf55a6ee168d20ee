"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is to be taken at the same expected rate (target over source size, at most 2). The rate's
whole part is certain; the fraction is what rounding decides. Pivotal rounding takes two undecided documents and
moves mass, *measured in words*, from one to the other until one of the fractions is 0 or 1. The direction is random
with odds that keep each document's expectation. Words are what moves, so a source's expected total never changes
except by the very last undecided document, which is rounded to the nearer side: the source ends within half that
document's size of its target.

**Distributed reduction tree.** Each source is dealt into blocks of about ``block_rows`` documents by a hash of the
doc_id and of the row's number among its equals (so rows without an id, or of one id, are spread too); a block is reduced in one task to decided documents and at most one undecided one. The undecided documents of
``block_rows`` blocks meet at the next level, until each source has one. A source with a third of all rows has a
third of all blocks; no task sees more than a block. Only (doc_id, source, size) travels, never text.

Randomness is a generator seeded by (seed, source, level, block), used in the order (size descending, doc_id), so
reruns and any partitioning agree.

Edge cases: a null text has size 0; a document of size 0 takes 0 words. A null source is a source of its own, last in
order. Rows that repeat a doc_id are separate documents (equal rows may swap their copies). Null doc_ids order first.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockmart.llm.common import WORD, staged

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Share of all sizes that the mix takes.
SHARE = 1.5
#: No document, and so no source, is taken more often than this.
MOST = 2.0
EPS = 1e-9
#: Numbers of equal rows that are made at a time.
NUMBERS = 1 << 12
#: Places at most in which rows find their copies (a bit for each number of copies: 25 MB in all), and places a row.
PLACES = 1 << 26
PLACES_PER_ROW = 64
_BITMAP = 1 << 15  # places in one of Spark's bitmaps


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(source, source_size, n_docs, target) from rows (source, size).

    Water filling: with sources ordered by cap over weight, the level that source k would see if all before it were
    capped is (total - caps before) / (weights from k on). The final level is the greatest of these, and a target is
    min(cap, weight * level): what repeated resharing of the excess converges to. The windows run over one row a
    source, after the sums.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(order)
    per = per.withColumn("turn", turn)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("turn") - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("cap", F.lit(MOST) * F.col("source_size"))
    before = Window.orderBy(F.col("cap") / F.col("w"), "turn").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    per = per.withColumn("level", left / weight_left)
    level = F.max("level").over(every)
    return per.select(
        "source", "source_size", "n_docs", F.least(F.col("cap"), F.col("w") * level).cast("double").alias("target")
    )


def pivotal_round(size: np.ndarray, fraction: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """``fraction`` with all but at most one entry moved to 0 or 1; the sum of size * fraction is kept.

    Documents come largest first, so that a large one is settled while there is mass to trade with.
    """
    p = fraction.astype(float).tolist()
    s = size.tolist()
    draws = rng.random(len(p)).tolist()
    open_one = -1
    for j in range(len(p)):
        if not EPS < p[j] < 1 - EPS:
            p[j] = float(round(p[j]))
            continue
        if open_one < 0:
            open_one = j
            continue
        i = open_one
        up = min((1 - p[i]) * s[i], p[j] * s[j])  # words that may move from j to i
        down = min(p[i] * s[i], (1 - p[j]) * s[j])  # and from i to j
        move = up if draws[j] < down / (up + down) else -down
        p[i] += move / s[i]
        p[j] -= move / s[j]
        i_open, j_open = (EPS < p[x] < 1 - EPS for x in (i, j))
        for x, is_open in ((i, i_open), (j, j_open)):
            if not is_open:
                p[x] = float(round(p[x]))
        open_one = i if i_open else j if j_open else -1
    return np.asarray(p)


_ROWS = "doc_id long, source string, size long, fraction double, extra long, block long, nr long"


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, block_rows: int = 1024, seed: int = 42) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies, taken."""
    if block_rows < 2:
        raise ValueError("block_rows must be at least 2")
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")
    )
    table = staged(sized, "sizes")
    targets = staged(source_targets(table, weights, share), "targets")
    rates = targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    rates = rates.select(
        F.col("source").alias("s"),
        F.floor("rate").cast("long").alias("whole"),
        (F.col("rate") - F.floor("rate")).alias("fraction"),
        F.ceil(F.col("n_docs") / block_rows).cast("long").alias("blocks"),
    )
    # equal (doc_id, source, size) rows are alike: they are counted, and told apart by numbers
    numbered = (
        table.groupBy("doc_id", "source", "size")
        .agg(F.count("*").alias("n"))
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / NUMBERS))))
        .withColumn("nr", F.explode(F.sequence(F.col("k") * NUMBERS + 1, F.least("n", (F.col("k") + 1) * NUMBERS))))
    )
    rows = (
        numbered.join(rates, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "nr"), F.col("blocks")))
        .select("doc_id", "source", "size", "whole", "fraction", "block", "nr")
    )
    settled = rows.filter((F.col("size") == 0) | (F.col("fraction") <= EPS) | (F.col("fraction") >= 1 - EPS)).select(
        "doc_id", "source", "size", F.when(F.col("size") > 0, F.round("fraction")).otherwise(0).cast("long").alias("extra")
    )
    undecided = rows.filter((F.col("size") > 0) & (F.col("fraction") > EPS) & (F.col("fraction") < 1 - EPS))
    undecided = undecided.select("doc_id", "source", "size", "fraction", F.lit(0).cast("long").alias("extra"), "block", "nr")

    most = rates.agg(F.max("blocks")).first()[0] or 1  # one number: how deep the tree is
    decided = [settled]
    level = 0
    while True:
        last = most <= 1
        done = staged(undecided.groupBy("source", "block").applyInPandas(_reducer(level, seed, last), _ROWS), "rounded")
        decided.append(done.filter("fraction is null").select("doc_id", "source", "size", "extra"))
        if last:
            break
        undecided = done.filter("fraction is not null").withColumn("block", F.floor(F.col("block") / block_rows).cast("long"))
        most = math.ceil(most / block_rows)
        level += 1
    everything = decided[0]
    for part in decided[1:]:
        everything = everything.unionByName(part)
    info = targets.join(rates.select("s", "whole"), F.col("source").eqNullSafe(F.col("s"))).select(
        "s", "whole", "source_size", "target"
    )
    copies = (F.col("whole") + F.col("extra")).cast("long")
    return everything.join(info, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, copies).otherwise(0).cast("long").alias("copies"),
        (F.when(F.col("size") > 0, copies).otherwise(0) * F.col("size")).cast("long").alias("taken"),
    )


def _reducer(level: int, seed: int, last: bool):
    """Rounds one block; fraction null marks a decided document. At the root the last one goes to the nearer side."""

    def reduce(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["size", "doc_id", "nr"], ascending=[False, True, True], na_position="first", kind="stable")
        source = block["source"].iloc[0]
        name = zlib.crc32(source.encode()) + 1 if isinstance(source, str) else 0
        rng = np.random.default_rng([seed, name, level, int(block["block"].iloc[0])])
        p = pivotal_round(block["size"].to_numpy(), block["fraction"].to_numpy(), rng)
        if last:
            p = np.floor(p + 0.5)
        is_open = (p > EPS) & (p < 1 - EPS)
        return block.assign(
            extra=np.where(is_open, 0, np.rint(p)).astype("int64"), fraction=pd.Series(p, index=block.index).where(is_open)
        )

    return reduce


def repeat_by_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, block_rows: int = 1024, seed: int = 42) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, all columns kept.

    Most rows find their copies where they are read (:func:`copies_by_place`). For the rest, copies are found by (doc_id, source, size). Rows that agree in all three (without an id, or of a repeated one) share
    their copies in the order of a hash of their texts, the extra ones first; they are numbered by narrow rows, one for
    each text, and only rows that agree in the text too are numbered one by one. Documents of size 0 hold no words and are
    left out.
    """
    mixed = mix(docs, weights, share, block_rows, seed)
    counted = mixed.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows"), F.sum("copies").alias("copies"))
    decided = staged(counted, "copies")
    sure, docs = copies_by_place(docs, decided)
    plan = decided.filter("size > 0 and copies > 0").select(
        *[F.col(c).alias(f"_mix_{c}") for c in ("doc_id", "source", "size", "rows", "copies")]
    )
    names = docs.columns
    key = ["_mix_doc_id", "_mix_source", "_mix_size"]
    sized = docs.withColumn("_mix_words", word_count(F.col("text")))
    same = (
        F.col("doc_id").cast("long").eqNullSafe(F.col("_mix_doc_id"))
        & F.col("source").cast("string").eqNullSafe(F.col("_mix_source"))
        & (F.col("_mix_words") == F.col("_mix_size"))
    )
    rows = sized.join(plan.filter("_mix_rows = 1"), same).withColumn("_mix_times", F.col("_mix_copies").cast("int"))
    shared = plan.filter("_mix_rows > 1")
    if not shared.isEmpty():
        alike = sized.join(shared, same).withColumn("_mix_text", F.xxhash64("text"))
        per_text = alike.groupBy(*key, "_mix_text").agg(F.count("*").alias("_mix_n"))
        before = Window.partitionBy(*key).orderBy("_mix_text").rowsBetween(Window.unboundedPreceding, -1)
        per_text = per_text.withColumn("_mix_before", F.coalesce(F.sum("_mix_n").over(before), F.lit(0))).drop("_mix_n")
        places = per_text.select(*[F.col(c).alias(f"{c}_p") for c in [*key, "_mix_text"]], "_mix_before")
        matched = F.col("_mix_text") == F.col("_mix_text_p")
        for c in key:
            matched = matched & F.col(c).eqNullSafe(F.col(f"{c}_p"))
        within = Window.partitionBy(*key, "_mix_text").orderBy(F.lit(0))
        nr = F.col("_mix_before") + F.row_number().over(within)
        times = F.floor((F.col("_mix_copies") + F.col("_mix_rows") - nr) / F.col("_mix_rows")).cast("int")
        alike = alike.join(places, matched).withColumn("_mix_times", times).filter("_mix_times > 0")
        rows = rows.select(*names, "_mix_times").unionByName(alike.select(*names, "_mix_times"))
    rows = rows.select(*names, "_mix_times").unionByName(sure.filter("_mix_times > 0"))
    return rows.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_times")))).select(*names)


def copies_by_place(docs: DataFrame, decided: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` with their copies (``_mix_times``), and the rest, which must be joined to ``decided``.

    ``decided`` has (doc_id, source, size, rows, copies) of every row of ``docs``. A hash of (doc_id, source) gives a row
    its place; for each number of copies a bitmap says in which places there are rows that the mix takes so often. The
    bitmaps are of bounded size and broadcast, so texts stay where they are read. In a place with one bit set all rows have
    that number of copies; rows in places with several are the rest.
    """
    wanted = PLACES_PER_ROW * max(1, decided.count())
    places = max(_BITMAP, min(PLACES, 1 << (wanted - 1).bit_length()))

    def place(rows: DataFrame) -> Column:
        return F.pmod(F.xxhash64(rows["doc_id"].cast("long"), rows["source"].cast("string")), F.lit(places))

    share = F.col("copies") / F.col("rows")
    at = place(decided)
    marked = decided.select(
        F.shiftright(at, 15).alias("_mix_number"), at.bitwiseAND(F.lit(_BITMAP - 1)).alias("bit"), F.floor(share).alias("low"), F.ceil(share).alias("high")
    )
    numbers = range(math.ceil(MOST) + 1)
    bitmaps = marked.groupBy("_mix_number").agg(
        *[F.bitmap_construct_agg(F.when((F.col("low") == n) | (F.col("high") == n), F.col("bit"))).alias(f"_mix_marks{n}") for n in numbers]
    )
    at = place(docs)
    bit = at.bitwiseAND(F.lit(_BITMAP - 1))

    def is_set(n: int) -> Column:
        byte = F.substring(F.col(f"_mix_marks{n}"), F.floor(bit / 8).cast("int") + 1, F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (bit % 8).cast("int")).cast("int")

    found = docs.join(F.broadcast(bitmaps), F.shiftright(at, 15) == F.col("_mix_number"))
    found = found.withColumn("_mix_set", F.array(*[is_set(n) for n in numbers])).withColumn(
        "_mix_kinds", F.aggregate("_mix_set", F.lit(0), lambda a, b: a + b)
    )
    sure = found.filter("_mix_kinds = 1").withColumn("_mix_times", (F.array_position("_mix_set", 1) - 1).cast("int"))
    return sure.select(*docs.columns, "_mix_times"), found.filter("_mix_kinds > 1").select(*docs.columns)
