"""The Jaccard join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from stowage.llm import ngram_join, queries
from stowage.llm.similar import shingle_sets

from .fixtures import docs


def brute_set(text, k=3):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, percent=90):
    """(n_shingles, component_id) by row of rows(doc_id, text), by all pairs."""
    sets, parent = [brute_set(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 10 * min(len(a), len(b)) >= 7 * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(len(s), least.get(find(i))) for i, s in enumerate(sets)]


def corpus(rng):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, "one"), (7, "one two three"), (8, "ONE two\x0bthree"), (9, "Ünique ünique"), (10, "z " * 5000)]
    for _ in range(40):
        w = [word() for _ in range(rng.choice([5, 11, 12, 13, 21, 30, 120, 400, 900]))]
        rows.append((len(rows) + 1, " ".join(w)))
        for _ in range(rng.randrange(5)):
            v = list(w)
            for _ in range(rng.choice([0, 1, 1, 2, len(w) // 60, len(w) // 45])):
                v[rng.randrange(len(v))] = word()
            v = v[rng.randrange(2) :] + [word()] * rng.randrange(2)
            if rng.random() < 0.3:
                v = v[: len(v) - len(v) // rng.choice([9, 10, 11, 20])]
            rows.append((len(rows) + 1, "\n".join(v).upper() if rng.random() < 0.2 else " ".join(v)))
    base = [word() for _ in range(100)]
    for _ in range(60):  # a large group of near copies, all of one text, many of which don't link with each other
        v = list(base)
        v[rng.randrange(100)] = word()
        if rng.random() < 0.5:
            v[rng.randrange(100)] = word()
        rows.append((len(rows) + 1, " ".join(v)))
    chain = [word() for _ in range(60)]
    for _ in range(25):  # each links with the one before only
        rows.append((len(rows) + 1, " ".join(chain)))
        chain = [*chain[2:], word(), word()]
    return rows


@pytest.mark.parametrize("seed, budget", [(1, 1 << 18), (2, 500)])
def test_components_against_all_pairs(spark, seed, budget):
    rows = corpus(random.Random(seed))
    rows += [(None, "one two three"), (None, None), (None, "nobody else has this"), (rows[20][0], rows[20][1])]
    frame = docs(spark, extra=rows).repartition(3)
    got = ngram_join.join(frame, budget=budget).collect()
    want = [(str(d), *x) for (d, _), x in zip(rows, brute(rows))]
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == sorted(w for w in want if w[0] != "None")
    nameless = sorted((r.n_shingles, str(r.component_id)) for r in got if r.doc_id is None)
    assert nameless == sorted((n, str(c)) for d, n, c in want if d == "None")


def test_empty_table_and_bounds(spark):
    assert ngram_join.join(docs(spark, "a").limit(0)).collect() == []
    with pytest.raises(ValueError):
        ngram_join.join(docs(spark, "a"), percent=60)


def test_sets_that_link_share_a_segment():
    """Random sets of all small sizes, as far apart as links allow, with many empty segments."""
    rng = np.random.default_rng(7)
    for percent in (80, 90, 95):
        for n in [*range(1, 60), 200, 1000]:
            for _ in range(12):
                a = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64) >> np.uint64(rng.integers(0, 4)))
                lose = rng.integers(0, n // 5 + 1)
                b = np.unique(np.concatenate([rng.permutation(a)[: len(a) - lose], rng.integers(0, 1 << 64, rng.integers(0, n // 5 + 1), dtype=np.uint64)]))
                both = len(np.intersect1d(a, b))
                if 100 * both >= percent * (len(a) + len(b) - both) and both < max(len(a), len(b)):
                    assert len(np.intersect1d(ngram_join.segment_keys(a, percent), ngram_join.segment_keys(b, percent))), (percent, n)


@pytest.mark.parametrize("rows, cells", [(2048, 1 << 22), (3, 40)])
def test_chunk_links_against_all_pairs(rows, cells):
    rng = random.Random(rows)
    for _ in range(8):
        base = [rng.randrange(10**9) for _ in range(60)]
        texts = [" ".join(str(x if rng.random() > 0.01 else rng.randrange(99)) for x in base[rng.randrange(3) :]) for _ in range(20)]
        sets = [h.view(np.int64) for h in shingle_sets(texts, 3)]
        chunk = lambda ids: ngram_join.Chunk(pa.array([{"kind": i, "grams": sets[i]} for i in ids], pa.struct([("kind", pa.int64()), ("grams", pa.list_(pa.int64()))])))
        def groups(pairs):
            label = list(range(20))
            for u, v in pairs:
                label = [label[v] if x == label[u] else x for x in label]
            return [label.index(x) for x in label]

        links = [(i, j) for i in range(20) for j in range(i) if 190 * len(np.intersect1d(sets[i], sets[j])) >= 90 * (len(sets[i]) + len(sets[j]))]
        assert groups(zip(*ngram_join.chunk_links(chunk(range(20)), None, 90, rows, cells))) == groups(links)
        across = [(i, j) for i, j in links if (i < 9) != (j < 9)]
        assert groups(zip(*ngram_join.chunk_links(chunk(range(9)), chunk(range(9, 20)), 90, rows, cells))) == groups(across)


def test_query(spark, small):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op11_ngram_join(spark, small).collect()}
    assert got == {d: x for (d, _), x in zip(given, brute(given))}


def test_query_equals_sql(spark, small):
    import duckdb

    got = queries.op11_ngram_join(spark, small)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
        want = db.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES['op11_ngram_join']})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())
