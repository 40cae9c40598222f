"""Quality selection by importance resampling.

Two generative models over hashed n-grams, one of target texts (labelled good) and one of all texts, give each document
the log ratio of its likelihoods. With Gumbel noise added, the k largest are a sample without replacement in proportion
to the ratio. The n-grams are words and word pairs, and runs of up to three token shapes (case, length, signs, repeats).

Scale: counts of all documents are added up in tasks and then over `BUCKETS` numbers, so what meets in the driver has a fixed size;
besides the ratios, the good labels' ids are broadcast if they take `LABEL_BYTES` at most. The k-th key is found by counting keys by their leading bits, 16 more in each of four rounds, so no sort and
no list of keys is needed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, materialise

BUCKETS = 1 << 14
SEED = 42
#: Bytes of good ids up to which they are broadcast to the documents; beyond, both are shuffled.
LABEL_BYTES = 64 << 20

TOKEN = re.compile(r"\w+|[^\w\s]+")


def _shape(token: str) -> int:
    """A number from 1 to 63 for case, length and kind of a token."""
    if token[0].isalnum() or token[0] == "_":
        kind = 1 if token.islower() else 2 if token.istitle() else 3 if token.isupper() and len(token) > 1 else 4
        if token.isdigit():
            kind = 5
        return 8 * kind + min(7, len(token).bit_length())
    return 48 + xxhash.xxh32_intdigest(token.encode()) % 16


class Reader:
    """Bucket numbers of the n-grams of texts; a bounded cache holds each token's hash and shape."""

    def __init__(self, limit: int = 500_000):
        self.limit = limit
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = TOKEN.findall(text or "")
        if not tokens:
            return np.zeros(0, dtype=np.int64)
        known = self.known
        seen = set(tokens)
        if new := [t for t in seen if t not in known]:
            if len(known) + len(new) > self.limit:
                known.clear()
                new = seen
            for t in new:
                known[t] = (xxhash.xxh64_intdigest(t.lower().encode(), SEED) >> 8 & 0xFFFFFFFFFF) << 6 | _shape(t)
        x = np.fromiter(map(known.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        words, shape = x >> 6, x & 63
        shape = shape + 64 * np.concatenate([[False], words[1:] == words[:-1]])
        two, three = shape[1:] + 128 * shape[:-1], shape[2:] + 128 * shape[1:-1] + 16384 * shape[:-2]
        grams = [words << 3, (words[1:] * 31 + words[:-1] * 17) << 3 | 1, shape << 3 | 2, two << 3 | 3, three << 3 | 4]
        mixed = np.concatenate(grams).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(50)).astype(np.int64) % BUCKETS


@lru_cache(1)
def worker_reader() -> Reader:
    """One for each Python worker, so that its next task finds the tokens of the last."""
    return Reader()


def _counts(rows: DataFrame) -> DataFrame:
    """(bucket, target, raw) of rows(text, target boolean); bucket -1 counts the documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = worker_reader()
        for b in batches:
            raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
            for t, good in zip(b["text"], b["target"].tolist()):
                c = np.bincount(reader(t), minlength=BUCKETS)
                raw += c
                if good:
                    target += c
            yield pd.DataFrame({"bucket": np.arange(-1, BUCKETS), "target": [0, *target], "raw": [len(b), *raw]})

    parts = rows.select("text", "target").mapInPandas(run, "bucket bigint, target bigint, raw bigint")
    return parts.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float, int]:
    """Log ratios by bucket, the good share of the labelled rows, and the number of documents.

    A doc_id with several labels counts as good if one is. Without good labels the ratios are 0 and the share is 1.
    """
    known = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    good = known.where("quality = 1").select("doc_id", F.lit(True).alias("good"))
    size = F.when(F.col("quality") == 1, F.coalesce(F.octet_length(F.col("doc_id").cast("string")), F.lit(0)) + 32)
    share = known.agg(F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("good"), F.sum(size).alias("bytes")).first()
    if (share.bytes or 0) <= LABEL_BYTES:
        good = F.broadcast(good)
    rows = docs.select("doc_id", "text").join(good, "doc_id", "left").withColumn("target", F.coalesce("good", F.lit(False)))
    got = _counts(rows).toPandas()
    tables = np.zeros((2, BUCKETS + 1))
    tables[0, got["bucket"] + 1], tables[1, got["bucket"] + 1] = got["target"], got["raw"]
    total, (target, raw) = int(tables[1, 0]), tables[:, 1:]
    if not target.sum():
        return np.zeros(BUCKETS), 1.0, total
    p, q = ((x + 1) / (x.sum() + BUCKETS) for x in (target, raw))
    return np.log(p / q), share.good / share.n, total


def keyed(docs: DataFrame, ratios: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, log_ratio, key): key is the log ratio with Gumbel noise from a hash of doc_id and seed, where that is null of the text and seed."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = worker_reader()
        for b in batches:
            yield batch(doc_id=b.column("doc_id"), noise=b.column("noise"), log_ratio=pa.array([float(shared.value[reader(t.as_py())].sum()) for t in b.column("text")], pa.float64()))

    kind = docs.schema["doc_id"].dataType.simpleString()
    noise = F.when(F.col("doc_id").isNull(), F.xxhash64("text", F.lit(seed))).otherwise(F.xxhash64("doc_id", F.lit(seed)))
    out = docs.select("doc_id", "text", noise.alias("noise")).mapInArrow(run, f"doc_id {kind}, noise bigint, log_ratio double")
    uniform = (F.shiftrightunsigned("noise", 11) + 0.5) / float(1 << 53)
    return out.select("doc_id", "log_ratio", (F.col("log_ratio") - F.log(-F.log(uniform))).alias("key"))


def top_keys(rows: DataFrame, k: int) -> DataFrame:
    """The rows with the k largest keys; rows that tie with the k-th all stay. rows should be stored."""
    if k <= 0:
        return rows.limit(0)
    ranked = rows.withColumn("place", _ordered("key"))
    low, wanted = None, k
    for shift in (48, 32, 16, 0):
        some = ranked if low is None else ranked.where(F.shiftright("place", shift + 16) == low)
        counts = some.groupBy(F.shiftright("place", shift).alias("lead")).count().toPandas().sort_values("lead", ascending=False)
        reached = counts["count"].cumsum()
        if reached.empty or reached.iloc[-1] < wanted:
            return rows
        at = int((reached >= wanted).to_numpy().argmax())
        wanted -= int(reached.iloc[at] - counts["count"].iloc[at])
        low = int(counts["lead"].iloc[at])
    return ranked.where(F.col("place") >= low).drop("place")


def _ordered(key: str):
    """A 64-bit integer that orders as the double does, in steps of 2^-20; beyond 2^43 keys tie."""
    scaled = F.greatest(F.lit(-float(1 << 43)), F.least(F.lit(float(1 << 43)), F.col(key))) * float(1 << 20)
    return F.floor(scaled).cast("long")


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, log_ratio, key): a sample of `k` rows of docs(doc_id, text; other columns are ignored).

    k defaults to the good share of labels(doc_id, quality) times the number of documents. Null and empty texts have a
    log ratio of 0. Rows with equal doc_id and text have equal keys, as those without an id have if their texts are equal; ties
    with the k-th key all stay.
    """
    ratios, share, total = fit(docs, labels)
    return top_keys(materialise(keyed(docs, ratios, seed)), round(share * total) if k is None else k)
