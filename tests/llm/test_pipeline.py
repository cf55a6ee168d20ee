"""The stages and the registered queries: their columns, their rows, and what the stages keep."""

from __future__ import annotations

import pytest
from helpers import components, docs_frame, fingerprint

import __spark_entry__
import corpus_pipeline
from dockmart.llm import decontam
from dockmart.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, sf_dir, name):
    from harness import duck

    con = duck(sf_dir)
    got = QUERIES[name](spark, sf_dir)
    want = con.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    rows = sorted(tuple(r[c] for c in columns) for r in got.collect())
    others = sorted(want.select(", ".join(columns)).fetchall())
    assert len(rows) == len(others)
    # all but doubles are equal; those are sums whose order, and so their last digit, the engines are free to choose
    assert rows == [tuple(pytest.approx(v, rel=1e-13, abs=0) if isinstance(v, float) else v for v in r) for r in others]


def test_entry_lists_all(spark):
    names = __spark_entry__.queries()
    assert set(QUERIES) <= set(names) and {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in names}


def test_stages_one_by_one(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 == len(set(names))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, kept, sf_dir).collect(), docs.schema)
        assert after.columns == docs.columns
        before_ids, ids = [r.doc_id for r in kept.collect()], [r.doc_id for r in after.collect()]
        if name == "near_dedup":
            rows = [(r.doc_id, r.text) for r in kept.collect()]
            roots = components([fingerprint(t) for _, t in rows], [i for i, _ in rows], 3)
            assert sorted(ids) == sorted(set(roots))
        elif name == "decontamination":
            leaks = decontam.find_contamination(kept, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
            assert sorted(ids) == sorted(set(before_ids) - {r.doc_id for r in leaks.collect()})
        elif name == "quality":
            assert 0.6 * len(before_ids) < len(ids) < len(before_ids)
        else:
            assert max(ids.count(i) for i in set(ids)) <= 2
        kept = after
    tokens = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir).collect()
    assert sorted(r.doc_id for r in tokens) == sorted(r.doc_id for r in kept.collect())
    at = 0
    for r in sorted(tokens, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids[-1] == 1
        at += r.n_tokens


def test_stages_take_awkward_tables(spark, sf_dir):
    rows = [(1, None), (2, ""), (None, "some words here"), (3, "a b c d e f"), (3, "a b c d e f"), (4, "x " * 30_000)]
    for table in (docs_frame(spark, rows, extra=("score", "size", "item_id")), docs_frame(spark, [])):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, sf_dir)
            assert out.columns == table.columns
            out.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, table, sf_dir).count() == table.count()
