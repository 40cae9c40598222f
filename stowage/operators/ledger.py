"""Deletion runs that may end at any time and be taken up again: a write-ahead log of keys.

Under one folder a run keeps four tables: `plan`, the keys to delete, dealt to batches, written once; `claims` (attempt, batch, key), written before
a batch is deleted; `outcomes` (attempt, batch, key, code, message, claimed_before, repeated), written after it; `work`, what each attempt found left to do. An
attempt that ends between a batch's claims and its outcomes leaves keys of which nothing is known. The next attempt asks for these again, and
a key that the store does not have any more is then `gone`, by our own deletion as far as can be told, and not `not_found`. So it is
with keys of a task that Spark ran again. Nothing that has an outcome is asked for again but failures.

Scale: keys are matched by joins of (key) tables; each attempt makes one pass over what is left and then reads its own batches only. Small batches are
claimed and deleted several at once, so that the jobs of a run grow with its keys over a round of all tasks and not with its batches. The
driver holds the numbers of the batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .gc import DELETE_BATCH, Deleter, UnknownOutcomes, dedup_keys, expand_targets

KEYS_A_BATCH = 1_000_000
CLAIM = "attempt string, batch int, key string"
OUTCOME = "attempt string, batch int, key string, code string, message string, claimed_before boolean, repeated boolean"
#: What may have become of a key; the last two have no outcome yet.
STATES = ("removed", "gone", "not_found", "failed", "unknown", "pending")


def _complete(spark: SparkSession, path: str) -> bool:
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def plan(targets: DataFrame, path: str, keys_a_batch: int = KEYS_A_BATCH, legacy_suffix: bool = False) -> DataFrame:
    """(key, class, store_path, n_targets, batch) of a run's targets; a plan that is written stays as it is, whatever the targets are now."""
    spark, where = targets.sparkSession, f"{path.rstrip('/')}/plan"
    if not _complete(spark, where):
        keys = dedup_keys(expand_targets(targets, legacy_suffix))
        staged = f"{path.rstrip('/')}/staged"
        keys.write.mode("overwrite").parquet(staged)
        keys = spark.read.parquet(staged)
        batches = max(1, -(-keys.count() // keys_a_batch))  # from the files' footers
        keys.withColumn("batch", F.pmod(F.xxhash64("key"), F.lit(batches)).cast("int")).write.mode("overwrite").parquet(where)
    return spark.read.parquet(where)


def claim(keys: DataFrame, path: str, attempt: str) -> None:
    """Log that an attempt is about to delete keys(batch, key)."""
    keys.select(F.lit(attempt).alias("attempt"), "batch", "key").write.mode("append").parquet(f"{path.rstrip('/')}/claims")


def _settled() -> str:
    return "code is null or code = 'NoSuchKey'"


def left(spark: SparkSession, path: str) -> DataFrame:
    """(key, batch, claimed_before): the plan's keys without an outcome, or with failures only, and whether any attempt has claimed them."""
    path = path.rstrip("/")
    keys = spark.read.parquet(f"{path}/plan").select("key", "batch")
    settled = _read(spark, f"{path}/outcomes", OUTCOME).where(_settled()).select("key").distinct()
    claimed = _read(spark, f"{path}/claims", CLAIM).select("key").distinct().withColumn("claimed", F.lit(True))
    rows = keys.join(settled, "key", "left_anti").join(claimed, "key", "left")
    return rows.select("key", "batch", F.coalesce("claimed", F.lit(False)).alias("claimed_before"))


def _delete(keys: DataFrame, deleter: Deleter) -> DataFrame:
    """(batch, key, code, message, claimed_before, repeated) of keys(batch, key, claimed_before), and of what else the store reports."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        repeated = TaskContext.get().attemptNumber() > 0  # the stage reads stored keys only, so Spark runs tasks again but never the stage
        for frame in frames:
            for s in range(0, len(frame), DELETE_BATCH):
                some = frame.iloc[s : s + DELETE_BATCH]
                names = some["key"].tolist()
                said = {k: v if isinstance(v, tuple) else (v, None) for k, v in deleter(names).items()}
                known = dict(zip(names, some["claimed_before"].tolist()))
                batch = dict(zip(names, some["batch"].tolist()))
                told = names + sorted(set(said).difference(names))
                codes, messages = zip(*[said.get(k, (None, None)) for k in told])
                yield pd.DataFrame({"batch": [batch.get(k, batch[names[0]]) for k in told], "key": told, "code": codes, "message": messages, "claimed_before": [known.get(k, False) for k in told], "repeated": repeated}, dtype=object)

    return keys.select("batch", "key", "claimed_before").mapInPandas(run, "batch int, key string, code string, message string, claimed_before boolean, repeated boolean")


def attempt(spark: SparkSession, path: str, deleter: Deleter, name: str, max_batches: int | None = None, tasks: int | None = None) -> int:
    """Delete what is left of a plan, batch by batch, as attempt `name`, which must be new; returns how many batches are left.

    A batch's claims are written before its keys are deleted, by about `tasks` tasks, its outcomes after. As many batches are under way at once as there
    are tasks, of KEYS_A_BATCH keys together at most, or one that is larger; an attempt that is killed leaves these in doubt. `max_batches` ends the attempt
    after so many. Reports of the store on keys that were not asked for are logged, and raise UnknownOutcomes at the end.
    """
    path = path.rstrip("/")
    work = f"{path}/work/{name}"
    if _complete(spark, work):
        raise ValueError(f"there has been an attempt {name}")
    tasks = tasks or spark.sparkContext.defaultParallelism
    planned = spark.read.parquet(f"{path}/plan").agg(F.count("*").alias("keys"), F.max("batch").alias("last")).first()
    at_once = max(1, min(tasks, KEYS_A_BATCH * ((planned.last or 0) + 1) // max(1, planned.keys)))
    salt = F.pmod(F.xxhash64("key"), F.lit(-(-tasks // at_once)))
    left(spark, path).repartition("batch", salt).write.mode("overwrite").partitionBy("batch").parquet(work)
    rows = _read(spark, work, "key string, claimed_before boolean, batch int")
    batches = [r.batch for r in rows.select("batch").distinct().orderBy("batch").collect()]
    now = batches if max_batches is None else batches[:max_batches]
    for s in range(0, len(now), at_once):
        some = rows.where(F.col("batch").isin(now[s : s + at_once]))
        claim(some, path, name)
        told = _delete(some, deleter).select(F.lit(name).alias("attempt"), "batch", "key", "code", "message", "claimed_before", "repeated")
        told.write.mode("append").parquet(f"{path}/outcomes")
    stray = _read(spark, f"{path}/outcomes", OUTCOME).where(F.col("attempt") == name).join(rows.select("key"), "key", "left_anti")
    if strange := stray.select("key").limit(5).collect():
        raise UnknownOutcomes(f"the store reported on keys that were not asked for: {', '.join(r.key for r in strange)}")
    return len(batches) - len(now)


def records(spark: SparkSession, path: str) -> DataFrame:
    """(key, class, store_path, status, error): one row for each key of the plan, by all attempts so far.

    removed: an attempt deleted it. gone: the store did not have it when an attempt or task asked again. not_found: it was not there at the
    first time. failed: the last attempt's error. unknown: claimed, without an outcome. pending: not claimed yet.
    """
    path = path.rstrip("/")
    told = _read(spark, f"{path}/outcomes", OUTCOME)
    absent = F.col("code") == "NoSuchKey"
    status = F.when(F.col("code").isNull(), 0).when(absent & (F.col("claimed_before") | F.col("repeated")), 1).when(absent, 2).otherwise(3)
    error = F.concat(F.lit("s3 error: code = "), F.col("code"), F.lit(", message = "), F.coalesce("message", F.lit("")))
    told = told.groupBy("key").agg(F.min(status).alias("state"), F.max(F.when(status == 3, F.struct("attempt", error.alias("error")))).alias("last"))
    claimed = _read(spark, f"{path}/claims", CLAIM).select("key").distinct().withColumn("claimed", F.lit(True))
    rows = spark.read.parquet(f"{path}/plan").join(told, "key", "left").join(claimed, "key", "left")
    state = F.coalesce("state", F.when(F.col("claimed"), 4).otherwise(5))
    names = F.array(*[F.lit(s) for s in STATES])
    return rows.select("key", "class", "store_path", F.element_at(names, state + 1).alias("status"), F.when(state == 3, F.col("last.error")).otherwise("").alias("error"))


def stats(records: DataFrame) -> DataFrame:
    """(class, attempted, removed, gone, not_found, failed, unknown, pending): a row for each class."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in STATES]
    return records.groupBy("class").agg(F.count_if(F.col("status") != "pending").alias("attempted"), *counts)
