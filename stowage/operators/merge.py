"""Merging of a report's listing files and exporting of narinfo tables, both sorted."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .narinfo import parse_narinfos


def sort_columns(order_by: str) -> list[Column]:
    """ "col [ASC|DESC], ..." as columns; nulls come last in either direction. Only names are taken, no expressions."""
    out = []
    for part in order_by.split(","):
        m = re.fullmatch(r"\s*([A-Za-z_][A-Za-z0-9_]*)(?:\s+(asc|desc))?\s*", part, re.IGNORECASE)
        if not m:
            raise ValueError(f"not a sort column: {part!r}")
        out.append(F.desc_nulls_last(m[1]) if (m[2] or "").lower() == "desc" else F.asc_nulls_last(m[1]))
    return out


def merged(inventory: DataFrame, order_by: str = "key") -> DataFrame:
    """All rows of a report's files without the bucket, sorted: one range exchange, so any number of tasks share the sort."""
    return inventory.drop("bucket").orderBy(*sort_columns(order_by))


def merge_inventory(inventory: DataFrame, path: str, order_by: str = "key", single_file: bool = False, rows_a_file: int = 0) -> None:
    """Write merged() as zstd Parquet. Files are in order; `single_file` makes one, sorted by one task."""
    rows = merged(inventory, order_by)
    writer = (rows.coalesce(1) if single_file else rows).write.mode("overwrite").option("compression", "zstd")
    (writer.option("maxRecordsPerFile", rows_a_file) if rows_a_file else writer).parquet(path)


def export_narinfos(records: DataFrame, path: str, block_size: int = 512 << 20, look_up: int = 0, rows_a_file: int = 0) -> int:
    """Write parsed records in key order as zstd Parquet, in large row groups so that dictionaries of references pay; returns their number.

    `look_up`: if over zero, each row group gets a Bloom filter of its hashes, made for so many, about 1.2 bytes each. Key order is not the order of
    hashes, so without one a look-up of a hash reads every row group. Records are stored first, as a sort reads its input twice: once for its ranges.
    """
    staged = f"{path.rstrip('/')}-staged"
    records.write.mode("overwrite").parquet(staged)
    return _sorted_export(records.sparkSession.read.schema(records.schema).parquet(staged), path, block_size, look_up, rows_a_file)


def _sorted_export(records: DataFrame, path: str, block_size: int, look_up: int, rows_a_file: int) -> int:
    rows = records.orderBy("key").drop("key", "dq_missing_store_path", "dq_invalid_utf8")
    writer = rows.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", block_size).option("parquet.dictionary.page.size", 8 << 20)
    if look_up:
        writer = writer.option("parquet.bloom.filter.enabled#hash", "true").option("parquet.bloom.filter.expected.ndv#hash", look_up).option("parquet.enable.dictionary#hash", "false")
    (writer.option("maxRecordsPerFile", rows_a_file) if rows_a_file else writer).parquet(path)
    return records.sparkSession.read.parquet(path).count()  # from the files' footers


#: Hashes that are looked up by a filter, which row groups are skipped by; more are joined.
LOOKED_UP = 10


def look_up(spark: SparkSession, path: str, hashes: list[bytes]) -> DataFrame:
    """The exported records with one of a few hashes; row groups whose Bloom filters have none of them are not read."""
    if not 0 < len(hashes) <= LOOKED_UP:
        raise ValueError(f"look up 1 to {LOOKED_UP} hashes, or join with them")
    wanted = F.lit(False)
    for h in hashes:
        wanted = wanted | (F.col("hash") == F.lit(bytearray(h)))
    return spark.read.parquet(path).where(wanted)


def order_breaks(spark: SparkSession, path: str, key: str = "key") -> DataFrame:
    """(file, rows, breaks, first, last, follows): whether the files under `path` are in order of a column, by one scan without a sort.

    breaks: rows of a file that come before the one above them; follows: whether the file begins where the one before it by name ended, or later. Each
    split of a file sends on its ends for each batch; what is put in order is those, and a row for each file.
    """
    rows = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"), F.col(key).alias("key"))
    kind = rows.schema["key"].dataType.simpleString()

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for file in pc.unique(whole.column("file")):  # a batch may hold the end of a file and the beginning of another
                b = whole.filter(pc.equal(whole.column("file"), file))
                k, n = b.column("key"), len(b)
                down = pc.sum(pc.less(k.slice(1), k.slice(0, n - 1))).as_py() or 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file.as_py()]), b.column("at").slice(0, 1), pa.array([n], pa.int64()), pa.array([down], pa.int64()), k.slice(0, 1), k.slice(n - 1)],
                    names=["file", "at", "n", "breaks", "first", "last"],
                )

    parts = rows.mapInArrow(ends, f"file string, at bigint, n bigint, breaks bigint, first {kind}, last {kind}")
    inside = Window.partitionBy("file").orderBy("at")
    parts = parts.withColumn("breaks", F.col("breaks") + F.coalesce((F.col("first") < F.lag("last").over(inside)).cast("int"), F.lit(0)))
    files = parts.groupBy("file").agg(F.sum("n").alias("rows"), F.sum("breaks").alias("breaks"), F.min_by("first", "at").alias("first"), F.max_by("last", "at").alias("last"))
    before = F.lag("last").over(Window.orderBy("file"))  # a row for each file
    return files.withColumn("follows", F.coalesce(F.col("first") >= before, F.lit(True)))


def export_raw(raw: DataFrame, path: str) -> DataFrame:
    """Parse raw(key, content), export the records and return one row of statistics: processed, exported, failed.

    Bodies are read and parsed once: the counts are observed while the parsed records are stored, which are sorted from there.
    """
    spark, seen = raw.sparkSession, Observation()
    parsed = parse_narinfos(raw, seen)
    exported = export_narinfos(parsed.records, path)
    processed, sound = seen.get["processed"], seen.get["exported"]
    if sound != exported:  # a stage that ran again may be observed twice
        return parse_narinfos(raw).stats()
    return spark.createDataFrame([(processed, exported, processed - exported)], "processed long, exported long, failed long")
