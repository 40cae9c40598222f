"""Toxicity by class-conditional Kneser-Ney models.

Two character models of order 5 inside words, one of toxic and one of ordinary labelled texts, are compared by their
length-normalised log-likelihoods, so that inflected and compound forms of a toxic stem count as much as the stem.
Each class has absolute discounting and continuation counts of its own; both back off to one distribution of shared
continuation counts, so an expression that either class has hardly seen tells little. A logistic curve, fitted on labelled
rows that took no part in the counts, turns the comparison over the whole text and over its most toxic words into a score.

Scale: word counts are made for all labelled training rows, in tasks first and then by one shuffle of (word, counts).
The counts of all distinct character sequences of the training rows, by 64-bit hash, are broadcast if they take `MODEL_BYTES` at most: 16
bytes a sequence and 24 a context. Scoring is then one pass over the documents without a shuffle; each task keeps the ratios of
words it has met in a bounded cache. Larger counts stay tables, with which the documents' distinct words are joined (`joined.py`); scores are the
same bit for bit (`kneser.py`). The curve is fitted on at most `calibration_rows` rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, discard, materialise
from .joined import Stored
from .kneser import BASE, CHARACTERS, DISCOUNT, FEATURES, ORDER, codes_of, curve, features, sequences, spelled, units, words_of

CALIBRATION_ROWS = 20_000
#: Bytes up to which the counts are collected and broadcast; beyond, words are joined with them.
MODEL_BYTES = 128 << 20
#: Bytes of labelled ids up to which the labels are broadcast to the documents; beyond, both are shuffled.
LABEL_BYTES = 64 << 20


def fold(doc_id: str) -> Column:
    """crc32 of doc_id as text, mod 4. Rows of fold 2 are held out: their labels are never read. Null ids: null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


@dataclass
class Table:
    """Counts of character sequences by the sequences' polynomial hashes, which are sorted: values[column, key]."""

    keys: np.ndarray
    values: np.ndarray

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """[column, key] for any keys; zeros for those that are absent."""
        if not len(self.keys):
            return np.zeros((len(self.values), len(keys)))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return (self.values[:, at] * (self.keys[at] == keys)).astype(float)


@dataclass
class Model:
    """By order n from 2: grams[n - 2] with (ordinary, toxic) counts, contexts[n - 2] with their tokens and their kinds.

    shared: continuation counts of single characters, of both classes together.
    """

    grams: list[Table]
    contexts: list[Table]
    shared: Table
    weights: np.ndarray | None = None  # of the curve: constant and features
    handle: Broadcast | None = None

    def on_executors(self, spark: SparkSession) -> Broadcast:
        """The counts on the executors, sent once for the curve, for scores and for filters."""
        if self.handle is None:
            self.handle = spark.sparkContext.broadcast(replace(self, weights=None))
        return self.handle

    def ratios(self, words: list[str]) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) for each word in units, its end included."""
        codes, starts, depth = spelled(words)
        total = self.shared.values.sum(dtype=float)
        base = (self.shared(codes)[0] + 0.5) / (total + 0.5 * CHARACTERS)
        p = np.stack([base, base])
        for n, at, here, before in sequences(codes, depth):
            context = self.contexts[n - 2](before)
            tokens, kinds = context[:2], context[2:]
            some = np.maximum(tokens, 1)
            back = np.where(tokens > 0, np.minimum(1, DISCOUNT * kinds / some), 1)
            p[:, at] = np.maximum(self.grams[n - 2](here) - DISCOUNT, 0) / some + back * p[:, at]
        found = units(*p)
        found[depth == 0] = 0
        return np.add.reduceat(found, starts)


class Reader:
    """Features of texts under a model, with a bounded cache of word ratios."""

    def __init__(self, model: Model, limit: int = 150_000):
        self.model, self.limit = model, limit
        self.known: dict[str, int] = {}

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), len(FEATURES)))
        for s in range(0, len(texts), 500):
            split = [words_of(t) for t in texts[s : s + 500]]
            seen = {w for words in split for w in words}
            if len(self.known) + len(seen) > self.limit:
                self.known.clear()
            new = [w for w in seen if w not in self.known]
            for k in range(0, len(new), 20_000):
                self.known.update(zip(new[k : k + 20_000], self.model.ratios(new[k : k + 20_000]).tolist()))
            get = self.known.__getitem__
            for k, words in enumerate(split, s):
                if words:
                    out[k] = features(np.fromiter(map(get, words), dtype=np.int64, count=len(words)))
        return out


def _word_counts(rows: DataFrame) -> DataFrame:
    """(word, ordinary, toxic) of rows(text, toxic)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for s in range(0, len(b), 2000):
                by: tuple[Counter, Counter] = Counter(), Counter()
                for t, kind in zip(b["text"].iloc[s : s + 2000], b["toxic"].iloc[s : s + 2000].tolist()):
                    by[kind].update(words_of(t))
                for kind, name, other in ((0, "ordinary", "toxic"), (1, "toxic", "ordinary")):
                    if by[kind]:
                        yield pd.DataFrame({"word": list(by[kind].keys()), name: list(by[kind].values()), other: 0})[["word", "ordinary", "toxic"]]

    parts = rows.select("text", "toxic").mapInPandas(run, "word string, ordinary bigint, toxic bigint")
    return parts.groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def _sum(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def _placed(grams: DataFrame, n: int) -> DataFrame:
    """(here, context, ordinary, toxic) of grams(gram, ordinary, toxic) of n characters: hashes as signed numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            codes = codes_of("".join(b["gram"])).reshape(-1, n)
            rolled = np.zeros(len(b), dtype=np.uint64)
            for k in range(n - 1):
                rolled = rolled * BASE + codes[:, k]
            whole = rolled * BASE + codes[:, n - 1]
            yield pd.DataFrame({"here": whole.view(np.int64), "context": rolled.view(np.int64), "ordinary": b["ordinary"], "toxic": b["toxic"]})

    return grams.mapInPandas(run, "here bigint, context bigint, ordinary bigint, toxic bigint")


def _table(df: DataFrame, key: str, *names: str) -> Table:
    """From df, which has one row for each key and counts under 2^32."""
    got = df.select(key, *names).toPandas()
    keys = got[key].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Table(keys[order], np.stack([got[c].to_numpy(dtype=np.uint32)[order] for c in names]))


def count_tables(rows: DataFrame) -> list[DataFrame]:
    """By order from 1: (gram, ordinary, toxic) of rows(text, toxic 0 or 1), counts of the highest order and continuation counts of the others.

    Each is a part of a stored table.
    """
    p = "concat('^', word, '$')"
    grams = f"explode(transform(sequence(2, length(word) + 2), i -> substring({p}, greatest(1, i - {ORDER - 1}), least(i, {ORDER})))) as gram"
    top = materialise(_sum(_word_counts(rows).selectExpr(grams, "ordinary", "toxic"), "gram"))
    orders = [top.where(F.length("gram") == ORDER)]
    for n in range(ORDER, 1, -1):
        # Of the lower order: how many characters come before it; at a word's start, where none does, the counts stay.
        shorter = orders[-1].selectExpr("substring(gram, 2) as gram", "cast(ordinary > 0 as bigint) as ordinary", "cast(toxic > 0 as bigint) as toxic")
        top = materialise(_sum(top.where(F.length("gram") < n).union(shorter), "gram"))
        orders.append(top.where(F.length("gram") == n - 1))
    return orders[::-1]


def _contexts(grams: DataFrame, context: str) -> DataFrame:
    """(context, o, t, ko, kt): tokens and kinds of each class after each context."""
    some = lambda c: F.sum((F.col(c) > 0).cast("long"))
    return grams.groupBy(context).agg(F.sum("ordinary").alias("o"), F.sum("toxic").alias("t"), some("ordinary").alias("ko"), some("toxic").alias("kt"))


def count_model(rows: DataFrame) -> Model | Stored:
    """The counts of rows(text, toxic 0 or 1), collected or, beyond `MODEL_BYTES` or 32 bits a count, as tables."""
    orders = count_tables(rows)
    sizes = [g.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("ordinary") + F.col("toxic")), F.lit(0)).alias("tokens")).first() for g in orders]
    # There are at most as many contexts as sequences.
    if 40 * sum(x.n for x in sizes[1:]) > MODEL_BYTES or max(x.tokens for x in sizes) >= 1 << 32:
        return _stored(orders, sizes[0].tokens)
    counts, contexts = [], []
    for n, grams in enumerate(orders[1:], 2):
        table = materialise(_placed(grams, n))
        counts.append(_table(_sum(table, "here"), "here", "ordinary", "toxic"))
        contexts.append(_table(_contexts(table, "context"), "context", "o", "t", "ko", "kt"))
        discard(table)
    shared = _table(_sum(_placed(orders[0], 1), "here"), "here", "ordinary", "toxic")
    for grams in orders:  # all of them have been read into the model
        discard(grams)
    return Model(counts, contexts, Table(shared.keys, shared.values.sum(axis=0, keepdims=True)))


def _stored(orders: list[DataFrame], total: int) -> Stored:
    """By the same hashes as the collected counts."""
    grams, contexts = None, None
    for n, some in enumerate(orders, 1):
        table = materialise(_placed(some, n))
        here = _sum(table, "here").select(F.lit(n).alias("n"), "here", "ordinary", "toxic")
        grams = here if grams is None else grams.union(here)
        if n > 1:
            of = _contexts(table, "context").withColumn("n", F.lit(n))
            contexts = of if contexts is None else contexts.union(of)
    return Stored(materialise(grams), materialise(contexts), float(total))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression by Newton steps on scaled features, with a small ridge: constant first."""
    if not len(y):
        return np.array([-2.0, 1.0, *[0.0] * (x.shape[1] - 1)])
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    w, keep = np.zeros(a.shape[1]), np.diag([1e-6, *[ridge] * x.shape[1]])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) / len(y) + keep @ w
        h = (a * (p * (1 - p) + 1e-6)[:, None]).T @ a / len(y) + keep
        step = np.linalg.solve(h, g)
        w -= step * min(1, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return np.array([w[0] - (w[1:] * mean / spread).sum(), *w[1:] / spread])


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic, part): the rows of docs that may be learned from. A doc_id with several labels has the largest."""
    known = labels.where(F.col("toxic").isin(0, 1) & (fold("doc_id") != 2)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    size = known.agg(F.sum(F.coalesce(F.octet_length(F.col("doc_id").cast("string")), F.lit(0)) + 32)).first()[0]
    if (size or 0) <= LABEL_BYTES:
        known = F.broadcast(known)
    return docs.select("doc_id", "text").where(fold("doc_id") != 2).join(known, "doc_id").withColumn("part", fold("doc_id"))


def train(docs: DataFrame, labels: DataFrame, calibration_rows: int = CALIBRATION_ROWS) -> Model | Stored:
    """Counts of the labelled rows of folds 0 and 1; the curve from at most `calibration_rows` rows of fold 3, by hash."""
    rows = labelled(docs, labels)
    model = count_model(rows.where("part < 2"))
    some = rows.where("part = 3").select(F.xxhash64("doc_id").alias("key"), "toxic", "text")
    if isinstance(model, Stored):
        described = model.described(some).select("row.key", "row.toxic", *FEATURES)
    else:
        described = _described(some, model)
    x = described.orderBy("key", *FEATURES, "toxic").limit(calibration_rows).toPandas()
    model.weights = fit_curve(x[list(FEATURES)].to_numpy(dtype=float), x["toxic"].to_numpy(dtype=float))
    return model


def _described(rows: DataFrame, model: Model) -> DataFrame:
    """rows(key, toxic, text) with the features in place of the texts."""
    shared = model.on_executors(rows.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(shared.value)
        for b in batches:
            yield pd.DataFrame(reader(b["text"].tolist()), columns=list(FEATURES)).assign(toxic=b["toxic"], key=b["key"])

    schema = ", ".join(f"{f} double" for f in FEATURES) + ", toxic int, key bigint"
    return rows.mapInPandas(run, schema)


def score(docs: DataFrame, model: Model | Stored, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs(doc_id, text; other columns are ignored).

    Null and empty texts get the score of a text that tells nothing. Repeated rows each get a row; a null doc_id has
    held_out false. The score depends on the text alone.
    """
    held = F.coalesce(fold("doc_id") == 2, F.lit(False))
    told = lambda rows: rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
    if isinstance(model, Stored):
        return told(model.scored(docs.select("doc_id", "text")).select("row.doc_id", "score"))
    shared, weights = model.on_executors(docs.sparkSession), model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for b in batches:
            yield batch(doc_id=b.column("doc_id"), score=pa.array(curve(weights, reader(b.column("text").to_pylist()))))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return told(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double"))


def drop_toxic(docs: DataFrame, model: Model | Stored, threshold: float = 0.3) -> DataFrame:
    """The rows of `docs` whose score is under `threshold`, with all their columns; without a join if the counts are broadcast."""
    if isinstance(model, Stored):
        return model.scored(docs).where(F.col("score") < threshold).select("row.*")
    shared, weights = model.on_executors(docs.sparkSession), model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for b in batches:
            stays = curve(weights, reader(b.column("text").to_pylist())) < threshold
            yield b.filter(pa.array(stays))

    return docs.mapInArrow(run, docs.schema)
