"""Periodic runs against all lags of all stretches."""

from __future__ import annotations

import hashlib
import random
import time
import zlib

import pytest

from stowage.llm import periodic, queries

from .fixtures import docs


def brute_runs(w, times=4, least=6):
    out, n = [], len(w)
    for q in range(1, n // times + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            start = i - q
            while i < n and w[i] == w[i - q]:
                i += 1
            length = i - start
            smaller = any(all(w[k] == w[k - d] for k in range(start + d, i)) for d in range(1, q))
            if length >= max(least, times * q) and not smaller:
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def brute_looped(doc_id, text):
    w = (text or "").encode().split()
    h, n = (zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def texts():
    rng = random.Random(5)
    out = [None, "", " \t\n\x0b\f\r ", "one", "a a a a a", "a a a a a a", "a b a b a b a b", "x a b a b a b a b y", "a b c " * 4 + "d", "a b a b a b a b " * 5, "é é é É é é é é é é", "a a " * 9, "z " * 5000]
    for _ in range(150):
        few = "abcdefgh"[: rng.choice([1, 2, 2, 3, 8])]
        w = [rng.choice(few) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            at, q = rng.randrange(len(w) + 1), rng.randrange(1, 12)
            some = [rng.choice("abcdefgh") for _ in range(q)]
            w[at:at] = (some * 8)[: q * rng.randrange(2, 7) + rng.randrange(q)]
        out.append(rng.choice([" ", "\n", "  \t"]).join(w))
    return out


@pytest.mark.parametrize("times, least", [(4, 6), (5, 2), (3, 5)])
def test_runs_against_all_lags(times, least):
    for t in texts():
        w = (t or "").encode().split()[:200]
        assert periodic.runs(periodic.numbered(w), times, least) == brute_runs(w, times, least), t


def test_find(spark):
    rows = texts()
    frame = docs(spark, *rows, extra=[(None, "b " * 7), (None, None), (3, "c c c c c c c"), (3, "c c c c c c c")])
    got = periodic.find(frame).collect()
    want = []
    for doc_id, t in [*enumerate(rows), (None, "b " * 7), (None, None), (3, "c c c c c c c"), (3, "c c c c c c c")]:
        w = (t or "").encode().split()
        runs = brute_runs(w) if len(w) < 1000 else [(0, len(w), 1)]
        want.append((str(doc_id), runs, brute_collapsed(w, runs).decode()))
    assert sorted((str(r.doc_id), [(x.start, x.length, x.period) for x in r.runs], r.collapsed) for r in got) == sorted(want)
    assert periodic.find(frame.limit(0)).collect() == []


def test_long_repetitive_texts_take_near_linear_time():
    def seconds(n):
        t = time.perf_counter()
        assert periodic.runs(periodic.numbered([b"z"] * n)) == [(0, n, 1)]
        assert [q for _, _, q in periodic.runs(periodic.numbered([b"a", b"b", b"c"] * (n // 3)))] == [3]
        return time.perf_counter() - t

    seconds(1000)
    assert seconds(400_000) < 8 * max(0.05, seconds(100_000))


def test_query(spark, small):
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, small).collect()}
    given = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(given)
    for d in given:
        w = brute_looped(d.doc_id, d.text)
        if len(w) > 800:
            continue
        runs, r = brute_runs(w), got[d.doc_id]
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(w, runs)).hexdigest()
    assert any(r.n_runs for r in got.values())


def test_looped_texts(spark):
    rows = ["a b  c d e f g\th i j k l m n o p"] * 60 + ["", None, "x"]
    got = {r.doc_id: r.text for r in queries.looped(docs(spark, *rows, extra=[(None, "a b")]).select("doc_id", "text")).collect()}
    for k, t in [*enumerate(rows), (None, "a b")]:
        assert (got[k] or "").encode().split() == brute_looped(k, t)
    assert len(set(got.values())) > 5
