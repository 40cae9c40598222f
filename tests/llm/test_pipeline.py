"""The corpus pipeline: stage contracts on the smallest tables, edges, and cases put in by hand."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from stowage.llm import similar, toxicity
from stowage.llm.common import table

from .test_native import brute, brute_lines
from .test_similar import brute_components


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    """Rows after each stage, each stage reading what the one before wrote."""
    out, docs = [], table(spark, small, "documents")
    for name, f in corpus_pipeline.STAGES:
        before = docs
        path = str(tmp_path_factory.mktemp("stage") / "t")
        f(spark, docs, small).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, before, docs))
    return out


def test_columns_and_progress(stages):
    names = [n for n, *_ in stages]
    assert names == ["toxicity", "line dedup", "SimHash near-dedup", "benchmark decontamination", "packing"]
    for _, before, after in stages[:-1]:
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"] and 0 < after.count() <= before.count()
    assert stages[0][2].count() < stages[0][1].count() and stages[2][2].count() < stages[2][1].count()


def test_toxicity_stage_keeps_the_clean(stages, spark, small):
    _, before, after = stages[0]
    known = {r.doc_id: r.toxic for r in table(spark, small, "labels").collect()}
    kept = {r.doc_id for r in after.collect()}
    clean = [d for d, t in known.items() if not t]
    assert sum(d in kept for d in clean) >= 0.97 * len(clean)
    assert sum(d in kept for d, t in known.items() if t) <= 0.2 * sum(known.values())  # 11 toxic ones, learned from half of 120 labels
    scores = {r.doc_id: r.predicted for r in toxicity.score(before, toxicity.train(before, table(spark, small, "labels"))).collect()}
    assert kept == {d for d, p in scores.items() if not p}


def test_line_stage(stages):
    _, before, after = stages[1]
    want = brute_lines([(r.doc_id, r.text) for r in before.collect()])
    old = {r.doc_id: r.text for r in before.collect()}
    got = {r.doc_id: r.text for r in after.collect()}
    assert got == {d: t for d, t in want.items() if t == old[d] or (t or "").strip(" ")}
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_duplicate_stage(stages):
    _, before, after = stages[2]
    groups = brute_components([(r.doc_id, r.text) for r in before.collect()])
    assert {r.doc_id for r in after.collect()} == set(groups)
    assert similar.near_duplicates(after).where("doc_id != component_id").count() == 0


def test_decontamination_stage(stages, spark, small):
    _, before, after = stages[3]
    items = [(r.item_id, r.text) for r in table(spark, small, "benchmark").collect()]
    texts = [(r.doc_id, r.text) for r in before.collect()]
    hit = {d for d, _ in brute(texts, items)}
    assert hit and {r.doc_id for r in after.collect()} == {d for d, _ in texts} - hit


def test_packing_stage(stages):
    _, before, after = stages[4]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}


def test_run_is_the_stages(stages, spark, small):
    from __spark_entry__ import queries

    # Where pieces are cut depends on the rows of each task, which texts are packed and how long they are does not.
    told = lambda df: sorted(map(tuple, df.groupBy("doc_id", "doc_tokens").agg({"length": "sum"}).collect()))
    assert told(queries()["pipeline"](spark, small)) == told(stages[4][2])


def test_edges(spark, small):
    rng = random.Random(8)
    own = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(60))
    rows = [(1, None), (2, ""), (3, own()), (3, own()), (None, own()), (5, own()), (6, "long " * 30_000)]
    df = spark.createDataFrame([(d, t, "en", "s", None, "x") for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, extra string")
    for _, f in corpus_pipeline.STAGES:
        empty = f(spark, df.limit(0), small)
        assert empty.count() == 0
        assert f(spark, df, small).count() > 0
