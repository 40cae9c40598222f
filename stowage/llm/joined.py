"""Kneser-Ney counts that are too many to broadcast: words are joined with them.

The documents' distinct words are cut into character sequences, whose distinct ones are joined with the counts by their hashes; the
factors go back to the words, the words' ratios to the documents. Sequences and words that stand in a large share of all rows are salted in both
joins; a group holds at most the sequences that end at one place of a word, or the distinct words of one document.
Probabilities are the same chain of double operations as with broadcast counts, and ratios are whole numbers, so scores are equal bit for bit.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, materialise
from .kneser import CHARACTERS, DISCOUNT, FEATURES, TOP, UNIT, curve, sequences, spelled, units, words_of

SALT = 16
#: Characters, or a document's distinct words, that go into one batch; a longer word or document is a batch of its own.
BATCH = 100_000


def _salted(few: DataFrame) -> DataFrame:
    return few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, i, n, here, context) of (key, word): the n characters that end at place i, and those of them before the last, by hash."""
    for b in batches:
        keys, words = b.column("key").to_numpy(zero_copy_only=False), b.column("word").to_pylist()
        ends = np.cumsum([len(w) + 2 for w in words]) // BATCH
        for some in np.split(np.arange(len(words)), np.flatnonzero(np.diff(ends)) + 1):
            if not len(some):
                continue
            codes, starts, depth = spelled([words[k] for k in some])
            of = np.repeat(keys[some], np.diff([*starts, len(codes)]))
            single = np.flatnonzero(depth > 0)
            for n, at, here, context in ((1, single, codes[single], np.zeros(len(single), dtype=np.uint64)), *sequences(codes, depth)):
                columns = {"key": of[at], "i": depth[at], "n": np.full(len(at), n, dtype=np.int32), "here": here.view(np.int64), "context": context.view(np.int64)}
                yield batch(**{c: pa.array(v) for c, v in columns.items()})


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield batch(key=b.column("key"), ratio=pa.array(units(b.column("ordinary").to_numpy(), b.column("toxic").to_numpy())))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(at, word, times) of (at, text)."""
    for b in batches:
        at, word, times = [], [], []
        for number, text in zip(b.column("at").to_pylist(), b.column("text")):
            seen = Counter(words_of(text.as_py()))
            at += [number] * len(seen)
            word += seen.keys()
            times += seen.values()
            if len(at) >= BATCH:
                yield batch(at=pa.array(at, pa.int64()), word=pa.array(word, pa.string()), times=pa.array(times, pa.int64()))
                at, word, times = [], [], []
        yield batch(at=pa.array(at, pa.int64()), word=pa.array(word, pa.string()), times=pa.array(times, pa.int64()))


@dataclass
class Stored:
    """grams(n, here, ordinary, toxic) of n characters, contexts(n, context, o, t, ko, kt), and the sum of the single characters' counts."""

    grams: DataFrame
    contexts: DataFrame
    total: float
    weights: np.ndarray | None = None  # of the curve: constant and features

    def _factors(self, grams: DataFrame) -> DataFrame:
        """grams(n, here, context) with a and b by class: the probability at an order is a + b times that of the order below."""
        found = grams.join(self.grams, ["n", "here"], "left").join(self.contexts, ["n", "context"], "left")
        zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
        single = F.col("n") == 1
        base = (zero("ordinary") + zero("toxic") + 0.5) / (self.total + 0.5 * CHARACTERS)
        out = []
        for name, tokens, kinds in (("ordinary", "o", "ko"), ("toxic", "t", "kt")):
            some = F.greatest(zero(tokens), F.lit(1.0))
            a = F.greatest(zero(name) - DISCOUNT, F.lit(0.0)) / some
            b = F.when(zero(tokens) > 0, F.least(F.lit(1.0), DISCOUNT * zero(kinds) / some)).otherwise(1.0)
            out += [F.when(single, base).otherwise(a).alias(f"a_{name}"), F.when(single, 0.0).otherwise(b).alias(f"b_{name}")]
        return found.select("n", "here", "context", *out)

    def ratios(self, words: DataFrame) -> DataFrame:
        """(key, ratio) of words(key, word), whose keys are distinct: log P(word | toxic) - log P(word | ordinary) in units, the end included."""
        cut = materialise(words.select("key", "word").mapInArrow(_cut, "key bigint, i bigint, n int, here bigint, context bigint"))
        factors = _salted(self._factors(cut.select("n", "here", "context").distinct()))
        steps = cut.withColumn("salt", F.pmod("key", F.lit(SALT)).cast("int")).join(factors, ["n", "here", "context", "salt"])
        step = lambda p, x, c: (x[f"a_{c}"] + x[f"b_{c}"] * p[c]).alias(c)
        p = F.aggregate(
            F.array_sort(F.collect_list(F.struct("n", "a_ordinary", "b_ordinary", "a_toxic", "b_toxic"))),
            F.struct(F.lit(0.0).alias("ordinary"), F.lit(0.0).alias("toxic")),
            lambda p, x: F.struct(step(p, x, "ordinary"), step(p, x, "toxic")),
        )
        places = steps.groupBy("key", "i").agg(p.alias("p")).select("key", "p.ordinary", "p.toxic")
        return places.mapInArrow(_units, "key bigint, ratio bigint").groupBy("key").agg(F.sum("ratio").alias("ratio"))

    def _told(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """rows(text and others) as (row, at), row a struct of all columns, and (at, features) of those with a word."""
        # Stored, so that a row keeps its number, as a word does.
        rows = materialise(rows.select(F.struct(*[f"`{c}`" for c in rows.columns]).alias("row"), F.monotonically_increasing_id().alias("at")))
        split = materialise(rows.select("at", F.col("row.text").alias("text")).mapInArrow(_counted, "at bigint, word string, times bigint"))
        words = materialise(split.select("word").distinct().withColumn("key", F.monotonically_increasing_id()))
        ratios = _salted(materialise(self.ratios(words).join(words, "key").select("word", "ratio")))
        told = split.withColumn("salt", F.pmod("at", F.lit(SALT)).cast("int")).join(ratios, ["word", "salt"])
        most = F.slice(F.sort_array(F.collect_list(F.struct("ratio", F.least("times", F.lit(TOP)).cast("int").alias("times"))), asc=False), 1, TOP)
        most = F.slice(F.flatten(F.transform(most, lambda x: F.array_repeat(x["ratio"], x["times"]))), 1, TOP)
        n, total = F.sum("times").cast("double"), F.sum(F.col("ratio") * F.col("times")).cast("double")
        found = told.groupBy("at").agg(
            (total / n / UNIT).alias("mean"),
            (total / F.sqrt(n) / UNIT).alias("scaled"),
            (F.aggregate(most, F.lit(0).cast("long"), lambda a, x: a + x).cast("double") / TOP / UNIT).alias("top"),
            (F.max("ratio").cast("double") / UNIT).alias("worst"),
        )
        return rows, found

    def described(self, rows: DataFrame) -> DataFrame:
        """(row, mean, scaled, top, worst) for every row of rows(text and others): row is a struct of its columns."""
        rows, found = self._told(rows)
        return rows.join(found, "at", "left").select("row", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in FEATURES])

    def scored(self, rows: DataFrame) -> DataFrame:
        """(row, score) for every row of rows(text and others), by the curve."""
        weights = self.weights

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = np.column_stack([b.column(c).to_numpy() for c in FEATURES])
                yield batch(at=b.column("at"), score=pa.array(curve(weights, x)))

        rows, found = self._told(rows)
        scores = found.mapInArrow(run, "at bigint, score double")
        empty = float(curve(weights, np.zeros((1, len(FEATURES))))[0])
        return rows.join(scores, "at", "left").select("row", F.coalesce("score", F.lit(empty)).alias("score"))
