from __future__ import annotations

import hashlib

import numpy as np
import pytest
from helpers import components, docs_frame, fingerprint, prose, removed, vocabulary, words_of
from pyspark.sql import functions as F

from dockmart.llm import simhash_dedup, substring_dedup


def _copies(seed: int, n: int = 60):
    rng = np.random.default_rng(seed)
    vocab = vocabulary(rng)
    rows = [(i, prose(rng, int(rng.integers(1, 120)), vocab)) for i in range(n)]
    for i in range(0, n, 3):  # near and exact copies, one long chain of small edits
        words = rows[i][1].split()
        if i % 2:
            words[len(words) // 2] = "changed"
        rows.append((1000 + i, " ".join(words)))
    passage = prose(rng, 30, vocab)
    rows += [(2000 + i, prose(rng, 20, vocab) + "\n" + passage + "\t" + prose(rng, 20, vocab)) for i in range(15)]
    rows += [(3000, None), (3001, ""), (3002, " \n\t"), (3003, "Ä É one"), (3003, "Ä É one"), (None, rows[0][1]), (None, "alone here")]
    rows += [(3004, "x " * 3000), (3005, "x " * 3000 + "y"), (3006, passage), (3007, "a b c\x0bd\x0ce")]
    return rows


def test_fingerprints_and_components_equal_brute_force(spark):
    rows = _copies(1)
    docs = docs_frame(spark, rows, extra=("fp", "component_id", "owner"))
    got = simhash_dedup.near_duplicate_groups(docs).collect()
    assert len(got) == len(rows)
    fps = [fingerprint(t) for _, t in rows]
    expect = components(fps, [i for i, _ in rows], 3)
    key = lambda r: tuple((x is None, x) for x in r)
    want = sorted(((i, fp - (1 << 64) if fp >> 63 else fp, c) for (i, _), fp, c in zip(rows, fps, expect, strict=True)), key=key)
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in got), key=key) == want


@pytest.mark.parametrize("max_bits", [1, 2, 3, 5])
def test_links_lose_no_pair(spark, max_bits):
    """Random fingerprints with planted neighbours at every distance, against all pairs."""
    rng = np.random.default_rng(max_bits)
    base = [int(x) for x in rng.integers(0, 1 << 63, 40)]
    fps = set(base)
    for b in base:
        for _ in range(6):
            x = b
            for bit in rng.choice(64, rng.integers(1, max_bits + 3), replace=False):
                x ^= 1 << int(bit)
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = {tuple(sorted((r.u, r.v))) for r in simhash_dedup.links(spark.createDataFrame([(x,) for x in signed], "fp long"), max_bits).collect()}
    mask = (1 << 64) - 1
    want = {
        tuple(sorted((a, b)))
        for i, a in enumerate(signed)
        for b in signed[:i]
        if ((a ^ b) & mask).bit_count() <= max_bits
    }
    assert got == want


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.root for r in simhash_dedup.components(df).collect()}
    assert all(got[i] == 0 for i in range(1, 51)) and all(got[100 + i] == 100 for i in range(1, 40))


def test_keep_one_per_group(spark):
    rows = [(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (9, "quite another text of words"), (None, "a b c d")]
    docs = docs_frame(spark, rows, extra=("fp", "kept_id"))
    got = simhash_dedup.keep_one_per_group(docs, 3, 3)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [3, 9]


@pytest.mark.parametrize("hot", [1, 1000])
def test_rows_without_ids_are_grouped_too(spark, monkeypatch, hot):
    """Copies without an id go where a row with an id has their text; a group of such rows alone keeps one."""
    monkeypatch.setattr(simhash_dedup, "HOT", hot)
    near = "x " * 50
    rows = [(None, "one two three four")] * 5 + [(1, "one two three four")] + [(None, "only here and now")] * 4 + [(None, near), (None, near + "end")]
    got = simhash_dedup.keep_one_per_group(docs_frame(spark, rows), 3, 3).collect()
    texts = sorted((r.doc_id is None, r.text) for r in got)
    assert texts[:2] == [(False, "one two three four"), (True, "only here and now")] and len(texts) == 3 and texts[2][1] in (near, near + "end")


@pytest.mark.parametrize("hot", [1, 4, 1000])
def test_one_id_in_several_groups(spark, monkeypatch, hot):
    """Rows of one id with unlike texts: every group keeps one row, whichever of them is a copy of a smaller id."""
    monkeypatch.setattr(simhash_dedup, "HOT", hot)
    texts = [f"a{i} b{i} c{i} d{i}" for i in range(12)]
    rows = [(1, texts[0])] + [(7, t) for t in texts[:10]] + [(8, texts[3]), (9, texts[10]), (7, texts[11]), (6, texts[11])]
    rows += [(7, texts[5])] * 6 + [(7, None), (7, ""), (2, " ")]
    got = simhash_dedup.keep_one_per_group(docs_frame(spark, rows, extra=("rows", "root", "kept_hash")), 3, 0).collect()
    want = [(1, texts[0])] + [(7, t) for t in texts[1:10]] + [(9, texts[10]), (6, texts[11]), (2, " ")]
    assert sorted((r.doc_id, r.text) for r in got) == sorted(want)
    near = [(3, "x " * 50 + "end"), (4, "x " * 50), (4, "quite another text of words"), (5, "quite another text of words")]
    got = simhash_dedup.keep_one_per_group(docs_frame(spark, near), 3, 3).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [near[0], near[2]]


def test_empty_tables(spark):
    docs = docs_frame(spark, [])
    assert simhash_dedup.near_duplicate_groups(docs).count() == 0
    assert simhash_dedup.keep_one_per_group(docs, 3, 3).count() == 0
    assert substring_dedup.remove_repeats(docs).count() == 0


@pytest.mark.parametrize(("seed", "k", "m"), [(2, 13, 5), (3, 5, 3), (4, 4, 4)])
def test_substring_removal_equals_brute_force(spark, seed, k, m):
    rows = _copies(seed)
    docs = docs_frame(spark, rows, extra=("pos", "source", "start", "mh"))
    got = substring_dedup.remove_repeats(docs, k, m, texts=True).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    want = [
        (i, n, gone, hashlib.sha256(" ".join(kept).encode()).hexdigest(), " ".join(kept))
        for (i, _), (n, gone, kept) in zip(rows, removed(rows, k), strict=True)
    ]
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_rows_of_one_id_with_different_texts(spark):
    a = " ".join(f"w{i}" for i in range(40))
    rows = [(1, a), (7, "zero " + a), (7, a[: len(a) // 2] + " end"), (8, "nothing of this")]
    got = substring_dedup.remove_repeats(docs_frame(spark, rows), 13, 5).collect()
    want = sorted((i, n, gone) for (i, _), (n, gone, _) in zip(rows, removed(rows, 13), strict=True))
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == want


def test_paths_are_compacted_and_verified(spark):
    """A long repeat is one path; a false source is found by the digests and searched again word for word."""
    a = " ".join(f"w{i}" for i in range(300))
    docs = docs_frame(spark, [(1, a), (2, "start " + a + " end")])
    paths = substring_dedup.repeated_paths(docs).collect()
    assert [(p.doc_id, p.start, p.edges, p.source, p.source_start) for p in paths] == [(2, 1, 288, 1, 0)]
    rows = [(1, a), (2, "start " + a + " end"), (3, "other " + a)]
    docs = docs_frame(spark, rows)
    result = substring_dedup._binary(docs).select(
        "doc_id", "th", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.lit("").alias("kept_sha256")
    )
    bad = result.filter("doc_id = 2").select("doc_id", "th")
    again = {r.doc_id: r for r in substring_dedup._recheck(docs, result, bad, 13).collect()}
    assert again[2].n_removed == 300 and again[2].n_words == 302 and again[3].n_removed == 0


def test_words_split_at_six_characters_only():
    assert len(words_of("a b c\x0bd\x0ce\x1cf")) == 4 == len("a b c\x0bd\x0ce\x1cf".encode().split())


@pytest.mark.parametrize("hot", [1, 4, 1000])
def test_hot_fingerprints_change_nothing(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash_dedup, "HOT", hot)
    texts = ["one two three four"] * 30 + [None, ""] * 8 + [f"a{i} b{i} c{i} d{i}" for i in range(20)]
    rows = [(100 - i, t) for i, t in enumerate(texts)] + [(None, "one two three four"), (None, "only here and now")]
    got = simhash_dedup.near_duplicate_groups(docs_frame(spark, rows)).collect()
    want = components([fingerprint(t) for _, t in rows], [i for i, _ in rows], 3)
    key = lambda p: (p[0] is None, p[0] or 0, p[1] is None, p[1] or 0)
    assert sorted(((r.doc_id, r.component_id) for r in got), key=key) == sorted(((i, c) for (i, _), c in zip(rows, want, strict=True)), key=key)
