from __future__ import annotations

import numpy as np
import pytest
from helpers import docs_frame, prose, vocabulary
from pyspark.sql import functions as F

from dockmart.llm import quality, toxicity
from dockmart.llm.common import id_remainder


def _accuracy(scores, labels, held_out):
    y = {r.doc_id: r[1] for r in labels.collect()}
    rows = [(r.score >= 0.5) == bool(y[r.doc_id]) for r in scores.filter(held_out).collect() if r.doc_id in y]
    return np.mean(rows)


@pytest.fixture(scope="module")
def tables(spark):
    base = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")


def test_quality_held_out_accuracy(spark, tables):
    docs, labels = tables
    model = quality.fit(docs, labels, id_remainder(F.col("doc_id"), 3) != 1)
    scores = quality.score(docs, model)
    assert scores.count() == docs.count()
    assert _accuracy(scores, labels.select("doc_id", "quality"), id_remainder(F.col("doc_id"), 3) == 1) > 0.95


def test_toxicity_held_out_accuracy(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels, id_remainder(F.col("doc_id"), 5) != 0)
    scores = toxicity.score(docs, model)
    assert scores.count() == docs.count()
    assert _accuracy(scores, labels.select("doc_id", "toxic"), id_remainder(F.col("doc_id"), 5) == 0) > 0.95


def test_toxicity_recall_from_few_labels(spark):
    """352 toxic rows in four languages to learn from: nine in ten of the held-out ones are found, one clean in a hundred at most."""
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, labels, ~held_out)
    got = toxicity.score(docs, model).filter(held_out).join(labels.filter("toxic is not null").select("doc_id", "toxic"), "doc_id").collect()
    toxic, clean = [r.score >= 0.5 for r in got if r.toxic], [r.score >= 0.5 for r in got if not r.toxic]
    assert len(toxic) > 80 and np.mean(toxic) >= 0.9 and np.mean(clean) <= 0.01


def _labelled(spark, seed=5, n=200):
    rng = np.random.default_rng(seed)
    vocab = vocabulary(rng)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = prose(rng, 60, vocab)
        rows.append((i, " ".join(w.upper() + "!!" for w in text.split()) if bad else text))
        labels.append((i, 0 if bad else 1, 1 if bad else 0))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_labels_outside_the_fold_are_not_read(spark):
    rows, labels = _labelled(spark)
    docs = docs_frame(spark, rows)
    eligible = id_remainder(F.col("doc_id"), 3) != 1
    flipped = labels.withColumn("quality", F.when(eligible, F.col("quality")).otherwise(1 - F.col("quality")))
    one = quality.score(docs, quality.fit(docs, labels, eligible)).orderBy("doc_id").collect()
    two = quality.score(docs, quality.fit(docs, flipped, eligible)).orderBy("doc_id").collect()
    assert one == two


def test_awkward_rows(spark):
    rows, labels = _labelled(spark)
    rows += [(900, None), (901, ""), (901, ""), (None, "some words"), (902, "long " * 60_000)]
    docs = docs_frame(spark, rows, extra=("score", "label", "block"))
    labels = labels.unionByName(spark.createDataFrame([(None, 1, 0), (0, None, None), (1, 1, 1)], labels.schema))
    for module in (quality, toxicity):
        model = module.fit(docs, labels, F.lit(True))
        got = module.score(docs, model).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    kept = quality.keep_good(docs, quality.fit(docs, labels, F.lit(True)))
    assert kept.columns == docs.columns and 100 < kept.count() < len(rows)


def test_one_class_or_nothing(spark):
    docs = docs_frame(spark, [(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    ones = spark.createDataFrame([(1, 1, 1)], none.schema)
    assert {r.score for r in quality.score(docs, quality.fit(docs, none, F.lit(True))).collect()} == {0.5}
    assert {r.score for r in quality.score(docs, quality.fit(docs, ones, F.lit(True))).collect()} == {1.0}
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none, F.lit(True))).collect()} == {0.0}
    empty = docs_frame(spark, [])
    assert toxicity.score(empty, toxicity.fit(empty, none, F.lit(True))).count() == 0


def _clause(text):
    return sum(toxicity.ToxicityModel(toxicity.seed_lexicon()).clauses(text)[0])


def test_grammar_weighs_negation_reports_and_targets():
    assert _clause("you are an idiot") > _clause("an idiot walked by") > 0
    assert _clause("you are not an idiot") < _clause("you are an idiot") / 2
    assert _clause('they said "you idiot" yesterday') < _clause("they met you idiot yesterday")
    assert _clause("i will kill you") > 3 * _clause("i will kill time")
    assert _clause("we met you. the idiot") < _clause("we met you the idiot")  # a clause ends a scope
    assert _clause("the cat sat by you") == 0
    assert len(toxicity.ToxicityModel(toxicity.seed_lexicon()).clauses("idiot. moron! fine; scum")[0]) == 3


def test_composed_automaton_equals_its_parts():
    parts = (toxicity._target(), toxicity._negation(), toxicity._reported())
    rng = np.random.default_rng(0)
    for _ in range(200):
        states, whole = [0, 0, 0], 0
        for c in rng.integers(0, 7, 12).tolist():
            factors = []
            for k, part in enumerate(parts):
                states[k], f = part.step[states[k]][c]
                factors.append(f)
            whole, factor = toxicity.GRAMMAR.step[whole][c]
            assert factor == pytest.approx(np.prod(factors))
