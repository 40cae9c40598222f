"""Tables of bodies in buckets by key: joins by key and the removal of bodies read them where they are, without a shuffle of content.

Each file holds keys of one bucket. The catalog knows the layout; a new session declares it from the folder. All functions that take a table
of bodies (verification, ingest, the worklist) use it as it is: only what they join it with is shuffled, into the same buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .audit import BROADCAST_ROWS, _hadoop, finish_swap, swap_files

COLUMNS = "key string, content binary"


def write_bodies(raw: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Store raw(key, content) at `path` as the table `name`, in so many buckets; the one shuffle that bodies ever see. A table of that name is replaced.

    Every bucket should fit a task: take the bytes of all bodies over 128 MB or so, and a multiple of the cores. Null keys share a bucket.
    """
    rows = raw.select("key", "content").repartition(buckets, "key")
    rows.write.mode("overwrite").bucketBy(buckets, "key").option("path", path).saveAsTable(name)
    return raw.sparkSession.table(name)


def declare(spark: SparkSession, name: str, path: str, buckets: int) -> DataFrame:
    """The table that write_bodies() has left at `path`, in a session whose catalog does not know it."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({COLUMNS}) USING parquet CLUSTERED BY (key) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def append_bodies(raw: DataFrame, name: str, path: str, buckets: int) -> None:
    """Add raw(key, content) to the table; rows go to their buckets, what is stored stays in place."""
    rows = raw.select("key", "content").repartition(buckets, "key")
    rows.write.mode("append").bucketBy(buckets, "key").option("path", path).saveAsTable(name)


def rewrite_buckets(name: str, path: str, buckets: int, verified: DataFrame) -> int:
    """Take the bodies whose checksum differs, by verified(key, status), out of the table; returns how many.

    Only files that hold such bodies are written again, each by one task and into its own bucket; the others keep their names. The old files go to
    <path>-replaced, by noted moves that finish_swap() completes after an interruption. Keys are shuffled, bodies are not: files are read with
    broadcast lists of at most `BROADCAST_ROWS` keys; a file with more is joined bucket by bucket.
    """
    spark, base = verified.sparkSession, path.rstrip("/")
    finish_swap(spark, base)
    bad = verified.where("status = 'bad_checksum'").select("key").distinct()
    where = spark.table(name).select("key", F.col("_metadata.file_path").alias("file"))
    found = f"{base}-found"
    where.join(bad, "key", "left_semi").write.mode("overwrite").parquet(found)
    hits = spark.read.schema("key string, file string").parquet(found)
    names = [r.file for r in hits.select("file").distinct().orderBy("file").collect()]  # one for each file to be written again
    _, files = _hadoop(spark, found)
    if not names:
        files.delete(_hadoop(spark, found)[0], True)
        return 0
    removed = hits.count()
    gone = hits.select("key").distinct()
    touched = spark.table(name).where(F.col("_metadata.file_path").isin(names)).select("key", "content")
    kept = touched.join(F.broadcast(gone) if removed <= BROADCAST_ROWS else gone, "key", "left_anti")
    staged = f"{name}_staged"
    kept.write.mode("overwrite").bucketBy(buckets, "key").option("path", f"{base}-new").saveAsTable(staged)
    spark.sql(f"DROP TABLE {staged}")  # its files stay, as its path was given
    swap_files(spark, base, names)
    files.delete(_hadoop(spark, found)[0], True)
    spark.catalog.refreshTable(name)
    return removed
