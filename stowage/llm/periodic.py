"""Periodic runs of words, by sparse diagonals.

A run is a stretch of words with smallest period q that no neighbouring word extends and that holds q at least `TIMES` times. For
each word, its earlier occurrence adds to the match length of a lag's diagonal; where the diagonal ends with sufficient length, a run is
emitted. What keeps this sparse is which occurrences count: for window lengths K of 1, 2, 4, ... each word meets only the nearest
earlier place where the same K words begin, and only if that lies more than K/2 and at most K words back. That loses nothing: inside
a run of period q (K/2 < q <= K) the nearest such place is exactly q words back for each word whose window and lag lie in the run, as a nearer one would
give the run a smaller period; and a diagonal that is long enough for lag q has no smaller period, for the same reason. So each run
is found once, with its exact ends, and a text of one repeated word costs n log n steps, not the n * n of all earlier occurrences.

Windows are numbered by the numbers of their halves, so equal numbers are equal words; of each length only windows that stand twice go on.

Scale: one pass over the texts without a shuffle; a task holds one group of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batch

TIMES, LEAST = 4, 6
#: Texts that are held in parts at once.
GROUP = 256

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def diagonals(at: np.ndarray, lag: np.ndarray, window: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, lag) of the stretches of neighbouring places `at` with one lag that fits the window's length."""
    fits = np.flatnonzero((2 * lag > window) & (lag <= window))
    if not len(fits):
        return
    i, q = at[fits], lag[fits]
    ends = np.flatnonzero((np.diff(i) != 1) | (np.diff(q) != 0))
    for a, b in zip([0, *(ends + 1).tolist()], [*ends.tolist(), len(i) - 1]):
        yield int(i[a]), int(i[b]), int(q[a])


def runs(codes: np.ndarray, times: int = TIMES, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the numbered words, by start, then period."""
    if times < 3:
        raise ValueError("times must be 3 or more, so that a run is longer than a window and a lag")
    n, out = len(codes), []
    at, ids, window = np.arange(n), codes, 1
    while len(at) > 1 and times * (window // 2 + 1) <= n:
        order = np.argsort(ids, kind="stable")
        sorted_ids = ids[order]
        again = sorted_ids[1:] == sorted_ids[:-1]
        lag = np.zeros(len(at), dtype=np.int64)
        lag[order[1:][again]] = (at[order[1:]] - at[order[:-1]])[again]
        for first, last, q in diagonals(at, lag, window):
            start, length = first - q, last + window - first + q
            if length >= max(least, times * q):
                out.append((start, length, q))
        twice = np.zeros(len(at), dtype=bool)
        twice[order[1:][again]] = True
        twice[order[:-1][again]] = True
        number = np.empty(len(at), dtype=np.int64)
        number[order] = np.concatenate([[0], np.cumsum(~again)])
        # A window of twice the length is the pair of its halves.
        here = np.full(n + window, -1, dtype=np.int64)
        here[at[twice]] = number[twice]
        at = at[twice]
        at = at[here[at + window] >= 0]
        ids = here[at] * len(number) + here[at + window]
        window *= 2
    return sorted(out, key=lambda r: (r[0], r[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words but for those that a run holds after its first period, joined by one space."""
    if not found:
        return b" ".join(words)
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in found:
        keep[start + period : start + length] = False
    return b" ".join(words[i] for i in np.flatnonzero(keep).tolist())


def find(docs: DataFrame, times: int = TIMES, least: int = LEAST) -> DataFrame:
    """(doc_id, runs, collapsed) for every row of docs(doc_id, text; other columns are ignored).

    Words stand between ASCII white space. runs: array of (start, length, period) by start, then period; a run has at least `times` periods
    and `least` words. collapsed: the text without the words that any run holds after its first period, joined by one space. A null, empty or
    blank text has no runs and an empty collapsed text. Repeated rows and null ids give rows like others; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, len(whole), GROUP):
                b = whole.slice(s, GROUP)
                found, texts = [], []
                for text in b.column("text").cast(pa.binary()).to_pylist():
                    words = (text or b"").split()
                    found.append(runs(numbered(words), times, least))
                    texts.append(collapsed(words, found[-1]))
                lists = pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in found], pa.list_(RUN))
                yield batch(doc_id=b.column("doc_id"), runs=lists, collapsed=pa.array(texts, pa.binary()).cast(pa.string()))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
