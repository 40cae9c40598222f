"""Incremental ingest of object bodies: a streaming file source whose checkpoint remembers what is in, or batch joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stowage.operators.audit import MD5, checksum_gate, fetch_worklist
from stowage.sources import schemas
from stowage.sources.readers import file_id


def stream_bodies(spark: SparkSession, source: str, table: str, checkpoint: str, glob: str = "*.narinfo", max_files: int | None = None) -> int:
    """Append the bodies of new files under `source` to the Parquet table at `table`; returns the rows added.

    Each run takes what is new and ends. Running again without new files adds nothing.
    """
    reader = spark.readStream.format("binaryFile").schema(schemas.BINARY_FILE).option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    rows = (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(source)
    rows = rows.select(file_id("path").alias("key"), "content", F.md5("content").alias("md5"), F.col("modificationTime").alias("fetched"))
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "1000000")  # one small record a batch; by default only the last hundred are kept
    try:
        query = rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)
    finally:
        spark.conf.set(kept, before)


class BadBodies(Exception):
    pass


#: Asks the store for a list of keys and returns the bodies by key; a string in place of a body is the store's error, as is a key left out.
Fetcher = Callable[[list[str]], dict[str, bytes | str]]
FETCH_BATCH = 256


def fetch_bodies(keys: DataFrame, fetcher: Fetcher) -> DataFrame:
    """keys(key, ...) with content and error: the bodies, asked for where the keys are, so that only keys were ever shuffled."""
    extra = [f for f in keys.schema.fields if f.name not in ("content", "error")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, len(whole), FETCH_BATCH):
                b = whole.slice(s, FETCH_BATCH)
                names = b.column("key").to_pylist()
                said = fetcher(names)
                got = [said.get(k, "NoSuchKey") for k in names]
                content = pa.array([x if isinstance(x, bytes) else None for x in got], pa.binary())
                error = pa.array([None if isinstance(x, bytes) else x for x in got], pa.string())
                yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in extra), content, error], names=[*(f.name for f in extra), "content", "error"])

    types = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in extra), "content binary", "error string"])
    return keys.select(*[f"`{f.name}`" for f in extra]).mapInArrow(run, types)


def wanted_keys(work: DataFrame) -> DataFrame:
    """(key, e_tag) of a worklist, each key once; e_tag is null where the listed rows of a key differ in it, so that no body can match."""
    tags = work.groupBy("key").agg(F.min(F.lower("e_tag")).alias("least"), F.max(F.lower("e_tag")).alias("most"), F.count_if(F.col("e_tag").isNull()).alias("none"))
    return tags.select("key", F.when((F.col("least") == F.col("most")) & (F.col("none") == 0), F.col("least")).alias("e_tag"))


class Ingested(NamedTuple):
    added: int
    quarantined: int
    done: DataFrame


def _append(rows: DataFrame, path: str) -> int:
    """Append rows to a table; how many there were is observed while they are written, so bodies are read once.

    rows must be a scan with filters: then the writing tasks themselves observe, and a task that runs again counts once.
    """
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return seen.get["n"]


def ingest_report(inventory: DataFrame, objects: DataFrame | Fetcher, raw_path: str, quarantine_path: str, done: DataFrame, strict: bool = False, force: bool = False) -> Ingested:
    """One ingest of a report: what is still to fetch, fetched, checked, stored and marked as done.

    `objects` is a Fetcher, which is called where the keys are, or a table (key, content), which is joined with them: shuffled, if it is not in buckets by key. A key
    that is listed in several files is fetched once. Bodies with the right MD5 are appended to the table at `raw_path` (key, content), which must exist; others to `quarantine_path` with the reason.
    `strict` raises BadBodies, after writing, if there are any. done(file_id) comes back with the files of which nothing is left to fetch.
    """
    spark = inventory.sparkSession
    work = wanted_keys(fetch_worklist(inventory, spark.read.parquet(raw_path), done, force))
    fetched = f"{quarantine_path.rstrip('/')}-fetched"  # read twice below
    if isinstance(objects, DataFrame):
        work.join(objects.select("key", "content").dropDuplicates(["key"]), "key").write.mode("overwrite").parquet(fetched)
    else:
        fetch_bodies(work, objects).where("content is not null").drop("error").write.mode("overwrite").parquet(fetched)
    good, bad = checksum_gate(spark.read.parquet(fetched))
    added = _append(good.select("key", "content"), raw_path)
    quarantined = _append(bad.select("key", "content", "e_tag", "reason"), quarantine_path)
    if strict and quarantined:
        raise BadBodies(f"{quarantined} bodies have another checksum than the report says; see {quarantine_path}")
    left = fetch_worklist(inventory, spark.read.parquet(raw_path), done, force)
    return Ingested(added, quarantined, mark_done(done, left, inventory.select("file_id").distinct()))


BODIES = "key string, content binary, batch bigint"
QUARANTINE = "key string, content binary, md5 string, reason string, batch bigint"
MARKS = "file_id string, batch bigint"


def _written(spark: SparkSession, path: str, schema: str) -> DataFrame:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def ingest_batch(arrived: DataFrame, batch: int, inventory: DataFrame, path: str) -> None:
    """One micro-batch of arrived(key, content): checked against the inventory's e-tags, stored once, quarantined or marked, under its number.

    <path>/raw gets bodies with the right MD5 of keys that no other batch has stored, each key once; <path>/quarantine the others with the reason, among them
    keys that the inventory does not list; <path>/marks the files of which the last body is there now. Each table holds a folder for
    a batch, which a repeated batch writes again, so a batch that is replayed changes nothing. Keys and checksums are shuffled; the
    batch's bodies meet a broadcast list of its own keys, so a batch must be bounded, as maxFilesPerTrigger does.
    """
    spark, base = inventory.sparkSession, path.rstrip("/")
    into = lambda name: f"{base}/{name}/batch={batch}"
    arrived.select("key", "content").write.mode("overwrite").parquet(into("arrived"))
    arrived = spark.read.schema("key string, content binary").parquet(into("arrived")).withColumn("row", F.struct("_metadata.file_path", "_metadata.row_index"))
    stored = _written(spark, f"{base}/raw", BODIES).where(F.col("batch") != batch).select("key")
    listed = wanted_keys(inventory).withColumn("listed", F.lit(True))
    sums = arrived.where("key is not null").select("key", F.md5("content").alias("md5"), "row")
    rows = sums.join(listed, "key", "left").join(stored.distinct().withColumn("stored", F.lit(True)), "key", "left")
    reason = (
        F.when(F.col("listed").isNull(), "not_listed")
        .when(~F.coalesce(F.col("e_tag").rlike(MD5), F.lit(False)), "no_md5")
        .when(~F.coalesce(F.col("md5") == F.col("e_tag"), F.lit(False)), "bad_checksum")
        .when(F.col("stored"), "stored")
    )
    rows = rows.select("key", "md5", "row", reason.alias("reason"))
    first = rows.where("reason is null").groupBy("key").agg(F.min("row").alias("first"))
    told = rows.join(first, "key", "left").withColumn("reason", F.when(F.col("reason").isNull() & (F.col("row") != F.col("first")), "stored").otherwise(F.col("reason")))
    told.select("row", "md5", "reason").write.mode("overwrite").parquet(into("told"))
    told = spark.read.schema("row struct<file_path: string, row_index: bigint>, md5 string, reason string").parquet(into("told"))
    both = arrived.join(F.broadcast(told), "row")
    both.where("reason is null").select("key", "content").write.mode("overwrite").parquet(into("raw"))
    both.where("reason != 'stored'").select("key", "content", "md5", "reason").write.mode("overwrite").parquet(into("quarantine"))
    marked = _written(spark, f"{base}/marks", MARKS).where(F.col("batch") != batch).select("file_id")
    work = fetch_worklist(inventory, _written(spark, f"{base}/raw", BODIES), marked)
    files = inventory.select("file_id").distinct().join(marked, "file_id", "left_anti")
    files.join(work.select("file_id").distinct(), "file_id", "left_anti").write.mode("overwrite").parquet(into("marks"))


def stream_checked(arrivals: DataFrame, inventory: DataFrame, path: str, checkpoint: str) -> None:
    """Ingest a stream arrivals(key, content) into <path> by ingest_batch(), until what is there now is in.

    The checkpoint holds which input is in which batch; batches are numbered without gaps, and one that was interrupted comes again with its number.
    """
    query = arrivals.writeStream.foreachBatch(lambda rows, batch: ingest_batch(rows, batch, inventory, path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def checked_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(raw, quarantine, marks) that stream_checked() has written, each with its batch."""
    base = path.rstrip("/")
    return tuple(_written(spark, f"{base}/{name}", schema) for name, schema in (("raw", BODIES), ("quarantine", QUARANTINE), ("marks", MARKS)))


def new_objects(arrived: DataFrame, known: DataFrame, day: str = "day") -> DataFrame:
    """arrived(key, ...) of days that are not complete in known(day) yet; the batch form of the same."""
    return arrived.join(known.select(day).distinct(), day, "left_anti")


def ingest_stats(bodies: DataFrame) -> DataFrame:
    """One row: bodies fetched and their bytes."""
    return bodies.agg(F.count("*").alias("fetched"), F.coalesce(F.sum(F.octet_length("content")), F.lit(0)).cast("bigint").alias("bytes"))


def mark_done(state: DataFrame, worklist: DataFrame, files: DataFrame) -> DataFrame:
    """state(file_id) with the files that have nothing left to fetch."""
    open_ = worklist.select("file_id").distinct()
    return state.select("file_id").union(files.select("file_id").join(open_, "file_id", "left_anti")).distinct()
