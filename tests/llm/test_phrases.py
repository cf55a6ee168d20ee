"""Phrase collocations against a count of every phrase as it stands."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import DOCS, docs_frame, vocabulary

from dockmart.llm import collocations
from dockmart.llm.common import prepare


def pieces(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def brute(rows, max_words=4, least=30, percent=80, top=2000):
    """rows: (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for size in range(1, max_words + 1):
                f[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        cover = Counter()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    cover[p[i : i + m]] = max(cover[p[i : i + m]], a)
        rows = []
        for p, a in found.items():
            if 100 * cover[p] < percent * a:
                score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for i, r in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, r[2].decode(), -r[1], r[3], r[4], n[lang], -r[0]))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, text, lang, "s", 0) for i, (lang, text) in enumerate(rows)], DOCS)


def corpus(seed, n=300, words=25):
    rng = np.random.default_rng(seed)
    vocab = vocabulary(rng, words)
    texts = []
    for _ in range(n):
        w = rng.choice(vocab, rng.integers(0, 60)).tolist()
        marks = rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!? ", "\r\n"], len(w)).tolist()
        texts.append("".join(a + b for a, b in zip(w, marks)))
    return [(["en", "de", None, "und"][i % 4], t.title() if i % 7 == 0 else t) for i, t in enumerate(texts + texts[:60])]


@pytest.mark.parametrize("seed,least,percent,top", [(1, 3, 80, 2000), (2, 5, 50, 11), (3, 30, 80, 2000)])
def test_equals_brute_force(spark, seed, least, percent, top):
    prepare(spark)
    rows = corpus(seed)
    got = collocations.collocations(frame(spark, rows), 4, least, percent, top).collect()
    assert sorted(map(tuple, got)) == brute(rows, 4, least, percent, top)


def test_phrases_of_two_and_five_words(spark):
    prepare(spark)
    rows = corpus(4, n=120, words=6)
    for size in (2, 5):
        got = collocations.collocations(frame(spark, rows), size, 4).collect()
        assert sorted(map(tuple, got)) == brute(rows, size, 4)


def test_awkward_texts(spark):
    """Nulls, empty texts, marks only, one word thousands of times, words with odd blanks, ties and repeated rows."""
    prepare(spark)
    odd = "a\x1cb c d 　 e\x85f"
    rows = [("en", None), ("en", ""), ("en", " \t "), ("en", ".,;:!?\n\r"), ("en", "x " * 30_000), (None, odd)] + [(None, odd)] * 40
    rows += [("und", "p q"), ("und", "q p")] * 40 + [("", "lone pair")] * 30 + [("fr", "ÀÉ ÀÉ à É")] * 31
    got = sorted(map(tuple, collocations.collocations(frame(spark, rows)).collect()))
    assert got == brute(rows)
    assert ("und", "p q") in {(r[0], r[2]) for r in got} and {r[0] for r in got} == {"en", "und", "", "fr"}


def test_empty_table_and_clashing_columns(spark):
    prepare(spark)
    assert collocations.collocations(docs_frame(spark, [])).count() == 0
    table = frame(spark, corpus(5, n=40)).selectExpr("*", "1 AS phrase", "2 AS f", "3 AS chunk", "4 AS n", "'z' AS size")
    assert collocations.collocations(table, 4, 3).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert collocations.collocations(table, 4, 3).count() == len(brute([(r.lang, r.text) for r in table.collect()], 4, 3))


def test_large_counts_are_exact(spark):
    """2,000,000 a passes 64 bits."""
    a, l, r = 9_100_000_000_000_003, 9_200_000_000_000_001, 9_300_000_000_000_007
    table = spark.createDataFrame([("en", "p q", a, 2), ("en", "p", l, 1), ("en", "q", r, 1)], "lang string, phrase string, f long, size int")
    assert collocations.weakest_cuts(table).first().score == 2_000_000 * a // (l + r)


@pytest.mark.parametrize("modulus", [1, 2, 7, 1 << 40])
def test_parse_covers_each_phrase_once(modulus):
    """Whatever the cuts: chunks overlap by the window, and each phrase begins in exactly one of them."""
    for window in (1, 3):
        texts = [collocations.normalise(t.encode(), window) for _, t in corpus(7, n=12)]
        want, got = Counter(), Counter()
        for t in texts:
            tokens = t.decode().split(" ")
            want.update(tuple(tokens[i : i + window + 1]) for i in range(len(tokens) - window))
        chunks = list(collocations.parse(texts, window, modulus))
        for _, chunk, n in chunks:
            tokens = chunk.decode().split(" ")
            begins = len(tokens) - window
            assert n == sum(t != "\n" for t in tokens[:begins])
            got.update(tuple(tokens[i : i + window + 1]) for i in range(begins))
        assert got == want
        if modulus == 2:
            assert len(chunks) > 3 * len(texts)


def test_equal_passages_give_equal_chunks():
    """Where to cut depends on the content: a long passage shared by two texts is mostly the same chunks."""
    rng = np.random.default_rng(8)
    vocab = vocabulary(rng, 300)
    shared = " ".join(rng.choice(vocab, 2000))
    texts = [collocations.normalise(f"{' '.join(rng.choice(vocab, k))} {shared}".encode(), 3) for k in (50, 83)]
    chunks = [{c for i, c, _ in collocations.parse(texts, 3, 16) if i == j} for j in (0, 1)]
    assert len(chunks[0] & chunks[1]) > 0.9 * min(map(len, chunks))


def test_full_filter_changes_nothing(spark, monkeypatch):
    prepare(spark)
    rows = corpus(9, n=80)

    class Full:
        value = np.full(8, 255, np.uint8)

    want = sorted(map(tuple, collocations.collocations(frame(spark, rows), 4, 3).collect()))
    monkeypatch.setattr(collocations, "_filter_of", lambda phrases, n: Full)
    assert sorted(map(tuple, collocations.collocations(frame(spark, rows), 4, 3).collect())) == want == brute(rows, 4, 3)


def test_one_hash_for_different_phrases(monkeypatch):
    """Phrases that share a hash are kept apart by the independent one."""
    real = collocations._phrases
    monkeypatch.setattr(collocations, "_phrases", lambda words, langs, n: real(words, langs, n) if words[0] == other else np.full(len(words) - n + 1, 7, np.uint64))
    chunks = [b"a b \n \n \n", b"b a \n \n \n"]
    other = collocations.hash_words(collocations.tokenise(chunks)[1], 2)[0]
    batch = collocations._count_buffer(["en", "en"], chunks, np.array([2, 3]), 1, 3, None)
    found = Counter()
    for phrase, f in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
        found[phrase] += f
    assert found == {"a": 5, "b": 5} and isinstance(batch, pa.RecordBatch)
