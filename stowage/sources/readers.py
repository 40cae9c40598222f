"""Readers: report manifests, inventory listings, raw narinfo bodies, collection targets and object listings."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stowage.session import scratch

from . import schemas


def _folder(prefix: str) -> str:
    return prefix if prefix.endswith("/") else prefix + "/"


def file_id(key: str) -> Column:
    """The last part of a key."""
    return F.element_at(F.split(key, "/"), -1)


def read_manifests(spark: SparkSession, prefix: str, report_ids: list[str] | None = None) -> DataFrame:
    """<prefix>/<report>/manifest.json of the given reports, or of all, with report_id from the path."""
    folder = _folder(prefix)
    paths = [f"{folder}{r}/manifest.json" for r in report_ids] if report_ids else [f"{folder}*/manifest.json"]
    rows = spark.read.schema(schemas.MANIFEST).option("multiLine", True).json(paths)
    return rows.withColumn("report_id", F.regexp_extract("_metadata.file_path", "([^/]+)/manifest\\.json$", 1))


def read_inventory(spark: SparkSession, root: str, manifests: DataFrame, report_id: str) -> DataFrame:
    """All listing files of one report as one bag of rows, with file_id. The manifest's file list, a few names, is read first."""
    files = manifests.where(F.col("report_id") == report_id).select(F.explode("files.key").alias("key"))
    paths = [_folder(root) + r.key for r in files.collect()]
    if not paths:
        return spark.createDataFrame([], f"{schemas.OBJECT}, file_id string")
    return spark.read.schema(schemas.OBJECT).parquet(*paths).withColumn("file_id", F.col("_metadata.file_name"))


def read_raw_narinfos(spark: SparkSession, path: str) -> DataFrame:
    """(key, content) of every .narinfo object under a folder. For many small objects, compact once with write_raw_narinfos()."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.narinfo").option("recursiveFileLookup", True).load(path)
    return rows.select(file_id("path").alias("key"), "content")


def write_raw_narinfos(spark: SparkSession, source: str, path: str, rows_a_file: int = 1_000_000) -> None:
    """Compact the .narinfo objects under `source` once into a table of (key, content) that read_raw_table() reads."""
    read_raw_narinfos(spark, source).write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows_a_file).parquet(path)


def with_millis(inventory: DataFrame, column: str = "last_modified_date") -> DataFrame:
    """inventory with last_modified_ms: the column's milliseconds since 1970."""
    return inventory.withColumn("last_modified_ms", F.unix_millis(column))


def read_raw_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RAW_NARINFO).parquet(path)


def read_gc_targets(spark: SparkSession, path: str) -> DataFrame:
    """Targets as narinfo records, under the fixed schema."""
    return spark.read.schema(schemas.NARINFO).parquet(path)


def target_violations(targets: DataFrame) -> DataFrame:
    """(hash, rule): targets whose hashes are no 20 and 32 bytes, which a table's schema cannot say."""
    rules = F.array(
        F.when(F.coalesce(F.octet_length("hash"), F.lit(0)) != 20, "hash_length"),
        F.when(F.coalesce(F.octet_length("file_hash"), F.lit(0)) != 32, "file_hash_length"),
    )
    return targets.select("hash", F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("rule"))


def list_objects(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(key, size, last_modified) of the objects below a folder, or directly in it; contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    prefix = _folder(path if ":" in path else f"file:{path}")
    key = F.substring(F.col("path"), F.lit(len(prefix) + 1), F.length("path"))
    rows = rows.select(key.alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"))
    return rows if recursive else rows.where(~F.contains("key", F.lit("/")))


#: Lists what is directly in a folder, or all below it: (path, size, last modified in microseconds, whether it is a folder).
Lister = Callable[[str, bool], Iterable[tuple[str, int, int, bool]]]


def list_folder(path: str, recursive: bool) -> Iterator[tuple[str, int, int, bool]]:
    """The lister for all stores that Arrow's file systems know by URI, and for local paths."""
    from pyarrow import fs

    files, base = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    head = path[: len(path.rstrip("/")) - len(base.rstrip("/"))]
    for info in files.get_file_info(fs.FileSelector(base, recursive=recursive, allow_not_found=True)):
        yield head + info.path, info.size or 0, (info.mtime_ns or 0) // 1000, info.type == fs.FileType.Directory


LISTED = "path string, size bigint, modified bigint, folder boolean"
LISTED_ROWS = 10_000


def list_by_shards(spark: SparkSession, path: str, lister: Lister = list_folder, levels: int = 2, tasks: int | None = None) -> DataFrame:
    """(key, size, last_modified) of all objects below a folder, listed by tasks: the first levels folder by folder, then each folder there as a whole.

    The driver lists nothing and holds no names: each level's folders are stored and dealt to tasks. Keys are relative to the folder. A folder
    that is not there has no objects.
    """
    root, many = path.rstrip("/"), tasks or spark.sparkContext.defaultParallelism

    def listed(folders: DataFrame, recursive: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for folder in b.column("path").to_pylist():
                    rows = iter(lister(folder, recursive))
                    while some := list(islice(rows, LISTED_ROWS)):
                        columns = zip(*some)
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.bool_()))], names=["path", "size", "modified", "folder"])

        return folders.select("path").mapInArrow(run, LISTED)

    folders, found = spark.createDataFrame([(root,)], "path string"), []
    for _ in range(levels):
        where = scratch(spark)
        listed(folders, False).write.parquet(where)
        level = spark.read.schema(LISTED).parquet(where)
        found.append(level)
        folders = level.where("folder").repartition(many, "path")
    rows = listed(folders, True)
    for level in found:
        rows = rows.union(level)
    rows = rows.where("not folder")
    key = F.substring(F.col("path"), F.lit(len(root) + 2), F.length("path"))
    return rows.select(key.alias("key"), "size", F.timestamp_micros("modified").alias("last_modified"))


def discover_reports(listing: DataFrame, prefix: str) -> DataFrame:
    """(report_id): the names with a T one level under the prefix of listing(key), sorted."""
    folder = _folder(prefix)
    name = F.split_part(F.substring(F.col("key"), len(folder) + 1, 2**31 - 1), F.lit("/"), F.lit(1))
    rows = listing.where(F.startswith("key", F.lit(folder)) & F.contains(F.substring(F.col("key"), len(folder) + 1, 2**31 - 1), F.lit("/")))
    return rows.select(name.alias("report_id")).where(F.contains("report_id", F.lit("T"))).distinct().orderBy("report_id")


def manifest_files(manifests: DataFrame) -> DataFrame:
    """(report_id, file_index, key, size, MD5checksum, file_id) of manifests(report_id, files)."""
    rows = manifests.select("report_id", F.posexplode("files").alias("file_index", "f"))
    return rows.select("report_id", "file_index", "f.key", "f.size", "f.MD5checksum", file_id("f.key").alias("file_id"))


def manifest_violations(manifests: DataFrame) -> DataFrame:
    """(report_id, rule, file_index): every rule that a manifest breaks; no row if it is sound."""
    none = F.lit(None).cast("int").alias("file_index")
    whole = manifests.select("report_id", F.filter(F.array(
        F.when(F.coalesce(F.size("files"), F.lit(0)) < 1, "no_files"),
        F.when(F.coalesce("fileFormat", F.lit("")) == "", "no_format"),
    ), lambda r: r.isNotNull()).alias("rules"))
    whole = whole.select("report_id", F.explode("rules").alias("rule"), none)
    each = manifest_files(manifests).select("report_id", "file_index", F.filter(F.array(
        F.when(F.coalesce("key", F.lit("")) == "", "file_without_key"),
        F.when(F.coalesce("size", F.lit(0)) <= 0, "file_without_size"),
    ), lambda r: r.isNotNull()).alias("rules"))
    return whole.unionByName(each.select("report_id", F.explode("rules").alias("rule"), "file_index"))


def manifest_report(manifests: DataFrame) -> DataFrame:
    """Header fields, number of files and their total size of each report."""
    total = F.aggregate(F.transform("files", lambda f: f["size"]), F.lit(0).cast("bigint"), lambda a, s: a + F.coalesce(s, F.lit(0)))
    return manifests.select(
        "report_id", "sourceBucket", "destinationBucket", "version", "creationTimestamp", "fileFormat",
        F.size("files").cast("bigint").alias("n_files"), total.alias("total_size"), F.to_json("files").alias("files_json"),
    )
