from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from helpers import docs_frame, prose, vocabulary
from pyspark.sql import functions as F

from dockmart.llm import ann, decontam, mixing

VECTORS = "vec_id long, embedding array<float>, label int"


# Nearest neighbours


def _brute(vectors, queries, k):
    out = {}
    for q in queries:
        found = []
        for i, v in vectors:
            if i != q and len(v) == len(vectors_of(vectors, q)):
                d = np.sqrt(((np.float64(v) - np.float64(vectors_of(vectors, q))) ** 2).sum())
                found.append((d, i))
        out[q] = sorted(found)[:k]
    return out


def vectors_of(vectors, q):
    return next(v for i, v in vectors if i == q)


def test_recall_and_exact_scores(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = ann.vectors(table)
    got = ann.nearest(rows, rows.filter("vec_id % 25 = 0"), 10).collect()
    vectors = [(r.vec_id, np.array(r.embedding, np.float32)) for r in table.collect()]
    want = _brute(vectors, [i for i, _ in vectors if i % 25 == 0], 10)
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in got}
    assert len(got) == 10 * len(want)
    hits = sum(found[q, n + 1][0] == i for q, best in want.items() for n, (_, i) in enumerate(best))
    assert hits / len(got) >= 0.98
    for q, best in want.items():
        for n, (d, i) in enumerate(best):
            if found[q, n + 1][0] == i:
                assert found[q, n + 1][1] == pytest.approx(d, abs=1e-12)


def test_blocks_give_the_same_as_one(spark, sf_dir, monkeypatch):
    rows = ann.vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    queries = rows.filter("vec_id % 10 = 0")
    one = sorted(map(tuple, ann.nearest(rows, queries, 5).collect()))
    monkeypatch.setattr(ann, "BLOCK", 60)
    monkeypatch.setattr(ann, "QUERIES", 7)
    many = sorted(map(tuple, ann.nearest(rows, queries, 5).collect()))
    same = sum(a == b for a, b in zip(one, many, strict=True))
    assert same / len(one) > 0.98


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (3, [1.0, 3.0], 0), (4, None, 0), (5, [0.0, 0.0], 0), (6, [nan, 1.0], 0)]
    rows += [(7, [inf, 1.0], 0), (8, [None, 1.0], 0), (9, [], 0), (10, [1.0, 2.0, 3.0], 0), (None, [1.0, 1.0], 0), (3, [1.0, 3.0], 0)]
    table = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS norm", "2 AS code", "3 AS dim")
    usable = ann.vectors(table)
    got = sorted(map(tuple, ann.nearest(usable, usable.filter("vec_id = 0"), 10).collect()))
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 3, 1.0), (0, 4, 3, 1.0)]
    assert ann.nearest(usable, usable.filter("vec_id = 10"), 3).count() == 0
    assert ann.nearest(usable.limit(0), usable.limit(0), 3).count() == 0


@pytest.mark.parametrize("queries", [1024, 2])
def test_repeated_query_rows_and_ids(spark, monkeypatch, queries):
    """A query row three times, one id with two vectors, and a candidate row twice."""
    monkeypatch.setattr(ann, "QUERIES", queries)
    rng = np.random.default_rng(5)
    points = [(i, [float(x) for x in rng.standard_normal(3)], 0) for i in range(1, 40)]
    asking = [(100, [0.0, 0.1, 0.2], 0)] * 3 + [(200, [1.0, 1.0, 1.0], 0), (200, [-1.0, -1.0, -1.0], 0), (300, [1.0, 2.0], 0)]
    table = points + [points[0]] + asking
    rows = ann.vectors(spark.createDataFrame(table, VECTORS))
    got = sorted(map(tuple, ann.nearest(rows, rows.filter("vec_id in (100, 200)"), 10).collect()))
    want = []
    for q in (100, 200):
        mine = {tuple(v) for i, v, _ in asking if i == q}
        others = [(min(float(np.linalg.norm(np.array(v) - m)) for m in mine), i) for i, v, _ in table if i != q and len(v) == 3]
        want += [(q, n + 1, i, d) for n, (d, i) in enumerate(sorted(others)[:10])]
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])


# Decontamination


def _brute_leaks(docs, items, similarity=decontam.SIMILARITY):
    """Every window of every document against every item, no fingerprints."""
    out = {}
    clean = lambda t: (t or "").encode().translate(decontam._NORMAL).split()
    for doc_id, text in docs:
        w = clean(text)
        for item_id, item in items:
            i = clean(item)
            n = min(decontam.SHINGLE, len(i))
            if not n or len(w) < n:
                continue
            bag = Counter(tuple(i[a : a + n]) for a in range(len(i) - n + 1))
            best = 0.0
            for a in range(max(1, len(w) - len(i) + 1)):
                x = w[a : a + len(i)]
                other = Counter(tuple(x[b : b + n]) for b in range(len(x) - n + 1))
                least = sum((bag & other).values())
                best = max(best, least / (sum(bag.values()) + sum(other.values()) - least))
            if best >= similarity:
                out[doc_id, item_id] = max(best, out.get((doc_id, item_id), 0))
    return out


def test_leaks_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    vocab = vocabulary(rng, 150)
    items = [(i, prose(rng, int(rng.integers(3, 60)), vocab)) for i in range(25)] + [(90, ""), (91, None), (92, "one"), (3, prose(rng, 30, vocab))]
    docs = []
    for i in range(60):
        body = prose(rng, int(rng.integers(20, 200)), vocab)
        if i % 2:
            words = items[i % 25][1].split()
            for _ in range(i % 3):  # edits at the ends and in the middle
                words[int(rng.choice([0, len(words) - 1, len(words) // 2]))] = "edit"
            body = body + ". " + " ".join(words).upper() + "! " + prose(rng, 30, vocab)
        docs.append((i, body))
    docs += [(100, None), (101, ""), (102, items[0][1]), (102, items[0][1]), (None, items[1][1]), (103, (items[2][1] + " ") * 400), (104, "one")]
    frame = docs_frame(spark, docs, extra=("item_id", "similarity"))
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS block")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.find_contamination(frame, bench).collect()}
    want = _brute_leaks(docs, items)
    assert got == pytest.approx(want)
    kept = decontam.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    leaky = {d for d, _ in want}
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == sorted(i for i, _ in docs if i is not None and i not in leaky)


def test_blocks_of_items(spark, monkeypatch):
    items = [(i, f"item number {i} has words that no other item has such as w{i} x{i} y{i} z{i}") for i in range(12)]
    docs = docs_frame(spark, [(i, "before " + items[i][1] + " after") for i in range(12)] + [(50, "clean text")])
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 5)
    got = {(r.doc_id, r.item_id) for r in decontam.find_contamination(docs, bench).collect()}
    assert got == {(i, i) for i in range(12)}
    assert [r.doc_id for r in decontam.drop_contaminated(docs, bench).collect()] == [50]


def test_items_that_few_shingles_carry():
    """Two words in turn, one word many times, runs of a phrase: each similar window is found, whatever its bits."""
    rng = np.random.default_rng(21)
    vocab = vocabulary(rng, 300)
    items, docs = [], []
    for i in range(400):
        a, b, c = rng.choice(vocab, 3, replace=False)
        size = int(rng.integers(13, 40))
        words = [[a, b][k % 2] for k in range(size)] if i % 3 else [a] * size if i % 2 else [[a, b, c][k % 3] for k in range(size)]
        items.append((i, " ".join(words)))
        words[0 if i % 4 else -1] = "edit"  # changes one shingle
        docs.append((i, " ".join(["before", *words, "after"])))
    index = decontam.ItemIndex([(i, t.encode()) for i, t in items], decontam.SHINGLE, decontam.RADIUS, decontam.SIMILARITY)
    want = {(d, i) for pair in zip(docs, items) for (d, i) in _brute_leaks([pair[0]], [pair[1]])}
    got = {(d, m[0]) for d, text in docs for m in index.matches(text.encode()) if m[0] == d}
    assert len(want) > 390 and got == want


def test_radius_follows_the_bag():
    for n in (9, 20, 50, 300):
        assert decontam.miss_chance([1] * n, 0.8, decontam.RADIUS) <= decontam.MISS
    assert decontam.miss_chance([5, 4], 0.8, decontam.RADIUS) > 0.1 and decontam.miss_chance([1, 1, 1], 0.8, decontam.RADIUS) == 0


def test_blocks_are_bounded_by_items_and_bytes(spark, monkeypatch):
    """Many small items first, then long ones: no block passes either bound, but for one item that is longer."""
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 10)
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 500)
    items = [(i, "tiny item") for i in range(95)] + [(100 + i, "word " * 60) for i in range(5)] + [(200, "long " * 300)]
    blocks = [[len(bag) for _, _, bag in b.items] and b.items for b in decontam.item_blocks(spark.createDataFrame(items, "item_id long, text string"))]
    assert [i for b in blocks for i, _, _ in b] == [i for i, _ in items]
    sizes = dict(items)
    assert all(len(b) <= 10 and (len(b) == 1 or sum(len(sizes[i]) for i, _, _ in b) <= 500) for b in blocks)


def test_no_items_and_no_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = docs_frame(spark, [(1, "a b c")])
    assert decontam.find_contamination(docs, none).count() == 0 and decontam.drop_contaminated(docs, none).count() == 1
    items = spark.createDataFrame([(1, "a b c")], none.schema)
    assert decontam.find_contamination(docs_frame(spark, []), items).count() == 0


# Mixing


def _targets(sizes: dict, weights=mixing.WEIGHTS, share=mixing.SHARE):
    """Resharing round after round, as the contract words it."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    left, open_ones = share * sum(sizes.values()), set(order)
    while open_ones and left > 1e-9:
        total = sum(w[s] for s in open_ones)
        give = {s: left * w[s] / total for s in open_ones}
        left = 0.0
        for s, g in give.items():
            target[s] += g
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2 * sizes[s]
                open_ones.discard(s)
    return target


def _mix_rows(seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(1500):
        source = "hot" if i % 3 == 0 else ["a", "Z", "é", None, "b" * 5][int(rng.integers(5))]
        rows.append((i, " w" * int(rng.integers(0, 80)), source))
    return rows + [(2000, None, "a"), (2001, "", "empty"), (2002, " ", "empty"), (5, "w w w", "a"), (5, "w w w", "a"), (None, "x y", None), (None, "x", "a"), (2003, "w " * 30_000, "a")]


@pytest.mark.parametrize("block_rows", [4, 50, 1024])
def test_mix_meets_its_targets(spark, block_rows):
    rows = _mix_rows()
    docs = docs_frame(spark, rows, extra=("size", "target", "block", "rate", "s"))
    got = mixing.mix(docs, block_rows=block_rows).collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    target = _targets(sizes)
    taken: dict = {}
    largest: dict = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        rate = target[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert r.taken == r.copies * r.size <= 2 * r.size and (r.size == 0 or r.copies in (int(rate), -int(-rate // 1)))
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6


def test_reruns_and_partitionings_agree(spark):
    docs = docs_frame(spark, _mix_rows())
    key = lambda r: tuple((x is None, x) for x in r)
    one = sorted(map(tuple, mixing.mix(docs, block_rows=40).collect()), key=key)
    two = sorted(map(tuple, mixing.mix(docs.repartition(7), block_rows=40).collect()), key=key)
    assert one == two


def test_rounding_keeps_words_and_expectations():
    rng = np.random.default_rng(0)
    size = np.array([900, 300, 40, 30, 20, 10, 5])
    p = np.full(len(size), 0.3)
    total = np.zeros(len(size))
    for _ in range(4000):
        out = mixing.pivotal_round(size, p, rng)
        assert (out * size).sum() == pytest.approx((p * size).sum())
        assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 1
        total += out
    assert total / 4000 == pytest.approx(p, abs=0.04)


def test_repeat_by_mix(spark):
    rows = _mix_rows()
    docs = docs_frame(spark, rows, extra=("size", "copies", "_mix"))
    mixed = mixing.mix(docs).collect()
    got = mixing.repeat_by_mix(docs)
    assert got.columns == docs.columns
    rows_out = got.collect()
    assert len(rows_out) == sum(r.copies for r in mixed)
    assert sum(len((r.text or "").split()) for r in rows_out) == sum(r.taken for r in mixed)
    assert mixing.repeat_by_mix(docs_frame(spark, [])).count() == 0 and mixing.mix(docs_frame(spark, [])).count() == 0


def test_rows_without_an_id_are_spread_and_repeated(spark):
    texts = [f"{'a ' * (1 + i % 5)}w{i % 90}" for i in range(600)] + ["same text here"] * 300
    docs = docs_frame(spark, [(None, t, "hot") for t in texts] + [(7, "x y z", "hot")] * 40 + [(i, "p q r s", "small") for i in range(50)])
    rows = mixing.mix(docs, block_rows=32).collect()
    assert len(rows) == docs.count()
    for source in ("hot", "small"):
        part = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in part) - part[0].target) <= max(r.size for r in part) / 2
    copies = Counter()
    for r in rows:
        copies[r.doc_id, r.source, r.size] += r.copies
    again = mixing.repeat_by_mix(docs, block_rows=32).collect()
    assert Counter((r.doc_id, r.source, len(r.text.split())) for r in again) == +copies
    of_one = Counter(r.text for r in again if r.source == "hot")
    there = Counter(texts + ["x y z"] * 40)
    assert all(n <= 2 * there[t] for t, n in of_one.items())


@pytest.mark.parametrize("places", [1 << 15, 1 << 26])
def test_texts_stay_where_they_are_read(spark, monkeypatch, places):
    """pipeline: rows find their copies in broadcast bitmaps; only rows whose place several numbers of copies share are joined."""
    monkeypatch.setattr(mixing, "PLACES", places)
    rows = [(i, f"w{i} " * (1 + i % 7), "en", ("a", "b", None)[i % 3]) for i in range(3000)]
    rows += [(5000, "x y", "en", "a"), (5000, "x y z", "en", "a"), (5000, "x y z", "en", "a"), (None, "p q", "en", "b"), (None, "q p", "en", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    mixed = mixing.mix(docs)
    decided = mixed.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows"), F.sum("copies").alias("copies")).cache()
    sure, rest = mixing.copies_by_place(docs, decided)
    sure, rest = sure.collect(), rest.collect()
    assert len(sure) + len(rest) == len(rows) and len(rest) < (200 if places > 1 << 15 else 600)
    want = {(r.doc_id, r.source, r.size): r.copies / r.rows for r in decided.collect()}
    assert all(r._mix_times == want[r.doc_id, r.source, len(r.text.split())] for r in sure)
    got = Counter((r.doc_id, r.source, len(r.text.split())) for r in mixing.repeat_by_mix(docs).collect())
    assert got == {(r.doc_id, r.source, r.size): r.copies for r in decided.collect() if r.copies}
    decided.unpersist()
