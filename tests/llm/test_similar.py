"""Near-duplicate documents by similarity, against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from stowage.llm import similar

from .fixtures import docs


def brute_sets(text, k=5):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(rows, similarity=0.8):
    """Smallest id by row of rows(doc_id, text), by all pairs."""
    sets, parent = [brute_sets(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or (a and b and len(a & b) >= similarity * len(a | b) - 1e-9):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(rows))]


def corpus(rng):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, "a b c d e"), (7, "a b c d e f"), (8, "Ünique"), (9, "z " * 5000)]
    for _ in range(30):
        w = [word() for _ in range(rng.choice([5, 9, 30, 120, 400, 900]))]
        rows.append((len(rows) + 1, " ".join(w)))
        for _ in range(rng.randrange(5)):
            v = list(w)
            for _ in range(rng.choice([1, 1, 2, len(w) // 60, len(w) // 45, len(w) // 30])):
                v[rng.randrange(len(v))] = word()
            if rng.random() < 0.3:
                v = v[: len(v) - len(v) // 12]
            rows.append((len(rows) + 1, "\n".join(v).upper() if rng.random() < 0.2 else " ".join(v)))
    base = [word() for _ in range(100)]
    for _ in range(60):  # a large group of near copies, all of one text
        v = list(base)
        v[rng.randrange(100)] = word()
        rows.append((len(rows) + 1, " ".join(v)))
    return rows


@pytest.mark.parametrize("dealt", [{}, {"tile": 16, "budget": 600}])
def test_components_against_all_pairs(spark, dealt):
    rows = corpus(random.Random(21))
    rows += [(rows[20][0], rows[20][1]), (rows[20][0], "another text of the same id, with words of its own"), (None, rows[30][1]), (None, "alone and without an id at all"), (2**60 + 1, rows[40][1])]
    want = brute_components(rows)
    df = docs(spark, extra=rows).repartition(3)
    got = similar.near_duplicates(df, **dealt).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == sorted(((d, c) for (d, _), c in zip(rows, want)), key=repr)
    assert len(set(want)) < len(rows) - 60
    kept = similar.one_of_each(df, **dealt)
    stay = [(d, t) for (d, t), c in zip(rows, want) if c is None or c == d]
    assert kept.columns == df.columns and sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(stay, key=repr)


def test_lists_may_be_shuffled(spark, monkeypatch):
    monkeypatch.setattr(similar, "BROADCAST_ROWS", 0)
    rows = corpus(random.Random(22))[:60]
    want = {d for (d, _), c in zip(rows, brute_components(rows)) if c == d}
    assert {r.doc_id for r in similar.one_of_each(docs(spark, extra=rows)).collect()} == want


def test_empty_table(spark):
    assert similar.near_duplicates(docs(spark)).count() == 0 and similar.one_of_each(docs(spark)).count() == 0


def test_the_radius_covers_the_similarity():
    """Recall of the radius at similarities of 0.8 and little more: at least 0.99 from ten shingles on."""
    rng, near = np.random.default_rng(23), []
    for _ in range(600):
        common = int(rng.choice([8, 16, 80, 400]))
        h = rng.integers(0, 2**63, common + common // 4, dtype=np.uint64)
        a, b = np.unique(h[: common + common // 8]), np.unique(np.concatenate([h[:common], h[common + common // 8 :]]))
        assert len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b))
        near.append(sum((x ^ y).bit_count() if (x ^ y) >= 0 else ((x ^ y) + (1 << 64)).bit_count() for x, y in zip(similar.fingerprint(a), similar.fingerprint(b))) <= similar.RADIUS)
    assert np.mean(near) >= 0.99
