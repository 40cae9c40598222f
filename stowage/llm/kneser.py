"""What both forms of the Kneser-Ney counts share: words, sequences by hash, ratios as whole numbers, features and the curve.

A word's ratio is a sum of whole multiples of 1 / `UNIT`, one for each place, so it does not depend on the order of summation; a
text's features come from whole sums of these. Counts that are broadcast and counts that are joined thus give the same score, bit for bit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

ORDER = 5
#: Characters that a text could have, for smoothing.
CHARACTERS = 1 << 19
DISCOUNT = 0.75
#: The most toxic words whose mean ratio is a feature.
TOP = 3
UNIT = 1 << 24

WORD = re.compile(r"[^\W_]+")
BASE = np.uint64(1_000_003)
FEATURES = ("mean", "scaled", "top", "worst")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)


def spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words with their bounds, the words' starts among them, and how many come before each in its word."""
    codes = codes_of("".join(f"^{w}$" for w in words))
    lengths = np.array([len(w) + 2 for w in words])
    starts = np.cumsum(lengths) - lengths
    return codes, starts, np.arange(len(codes)) - np.repeat(starts, lengths)


def sequences(codes: np.ndarray, depth: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For n from 2: (n, places where n characters of a word end, polynomial hashes of these, and of them without the last)."""
    rolled = codes
    for n in range(2, ORDER + 1):
        at = np.flatnonzero(depth >= n - 1)
        before = rolled[at - 1]
        rolled = rolled.copy()
        rolled[n - 1 :] += codes[: len(codes) - n + 1] * BASE ** np.uint64(n - 1)
        yield n, at, rolled[at], before


def units(ordinary: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """log toxic - log ordinary of probabilities, in whole units."""
    return np.rint((np.log(toxic) - np.log(ordinary)) * UNIT).astype(np.int64)


def features(r: np.ndarray) -> tuple[float, float, float, float]:
    """`FEATURES` of the units of a text's words, of which there is one at least."""
    total, n = float(r.sum()), float(len(r))
    top = np.partition(r, -TOP)[-TOP:] if len(r) > TOP else r
    return total / n / UNIT, total / np.sqrt(n) / UNIT, float(top.sum()) / TOP / UNIT, float(r.max()) / UNIT


def curve(weights: np.ndarray, x: np.ndarray) -> np.ndarray:
    z = np.full(len(x), weights[0])
    for w, column in zip(weights[1:], x.T):  # one by one, so that a row's sum does not depend on the others
        z = z + w * column
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
