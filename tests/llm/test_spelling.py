"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from stowage.llm import queries, spelling

from .fixtures import docs


def brute_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, ratio=10):
    forms, out = {}, {}
    for w, n in counts.items():
        near = [x for x in counts if abs(len(x) - len(w)) < 2 and brute_near(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * n else None
        out[w] = len(near)
    rows = {}
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows[w] = (forms[w], root, n, out[w], counts[forms[w]] if forms[w] else None)
    return rows


def brute_words(rows):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc_id, text in rows:
        for m in re.finditer("[A-Za-zÀ-ÿ]+", text or ""):
            w = m[0].translate(upper)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{w}".encode())
                if h % 31 == 0:
                    w = w[: h % len(w)] + w[h % len(w) + 1 :]
            yield w


def told(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


def random_counts(rng, letters, size):
    out = {}
    for _ in range(size):
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 9)))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w = rng.choice([w[:at] + rng.choice(letters) + w[at:], w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at + 1 :]])
        if w:
            out[w] = rng.choice([2, 3, 20, 30, 200, 2000, 20_000, 3 * 10**6])
    return out


@pytest.mark.parametrize("letters, size, tile", [("abc", 250, 4096), ("etaoinshrdlu", 300, 20), ("aé😀zÿ", 250, 7)])
def test_variants_against_all_pairs(spark, letters, size, tile):
    counts = random_counts(random.Random(size + tile), letters, size) | {"x" * 40_000: 2, "x" * 20_000 + "y" + "x" * 19_999: 30, "": 5}
    frame = spark.createDataFrame([(w, n, "x") for w, n in counts.items()] + [(None, 3, "x"), ("only", None, "x")], "word string, n bigint, form string")
    assert told(spelling.variants(frame, tile=tile)) == brute(counts)


def test_chains_of_forms(spark):
    words = ["aaaaaaa" + "b" * k for k in range(18)]
    frame = spark.createDataFrame([(w, 2 * 10**k) for k, w in enumerate(words)], "word string, n bigint")
    assert {r.root for r in spelling.variants(frame).collect()} == {words[-1]}


def test_repeated_and_no_words(spark):
    frame = spark.createDataFrame([("abcdefg", 2), ("abcdefg", 3), ("abcdefgh", 50)], "word string, n bigint")
    assert told(spelling.variants(frame)) == {"abcdefg": ("abcdefgh", "abcdefgh", 5, 1, 50), "abcdefgh": (None, "abcdefgh", 50, 1, None)}
    assert spelling.variants(frame.limit(0)).collect() == []


def test_trie_reaches_all_pairs_within_the_budget():
    rng = np.random.default_rng(3)
    for leaf, block in ((1, 7), (4, 1000), (1000, 1 << 18)):
        q, w = (rng.integers(0, 3, (size, 6)).astype(np.int32) for size in (60, 80))
        q[:, 0], w[:, 0] = q[:, 1:].sum(1), w[:, 1:].sum(1)
        got = [(int(i), int(j)) for a, b in spelling.Trie(w).reached(q, leaf, block) for i, j in zip(a, b)]
        d = (w[None] - q[:, None])[:, :, 1:]
        want = set(zip(*map(np.ndarray.tolist, np.nonzero((np.maximum(d, 0).sum(2) <= 1) & (np.maximum(-d, 0).sum(2) <= 1)))))
        assert set(got) == want and len(got) == len(want)


def test_words_of_texts(spark):
    texts = [None, "", "Hello, WÖRLD's Ærø×÷x 12a3 ıi Āb", "x" * 100_000]
    got = Counter((r.doc_id, r.word) for r in spelling.words_of(docs(spark, *texts)).collect())
    assert got == Counter([(2, "hello"), (2, "wÖrld"), (2, "s"), (2, "Ærø×÷x"), (2, "a"), (2, "i"), (2, "b"), (3, "x" * 100_000)])


def test_query(spark, small):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    counts = {w: n for w, n in Counter(brute_words(given)).items() if len(w) >= 7 and n >= 2}
    assert told(queries.op12_spelling_variants(spark, small)) == brute(counts)


def test_misspelt_words(spark):
    rows = [(k, "Wörter und andere Buchstaben in Texten a b c") for k in range(40)] + [(None, "Wörter")]
    got = Counter(r.word for r in queries.misspelt(spelling.words_of(docs(spark, extra=rows))).collect())
    assert got == Counter(brute_words(rows))


def test_query_equals_sql(spark, small):
    import duckdb

    got = queries.op12_spelling_variants(spark, small)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
        want = db.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES['op12_spelling_variants']})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())
