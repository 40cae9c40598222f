"""Verification of stored objects against an inventory report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stowage.functions.hashes import comma_count, human_bytes

from .narinfo import narinfo_only
from .running import running_sums

MD5 = "^[0-9a-fA-F]{32}$"


def missing_files(files: DataFrame, ingested: DataFrame) -> DataFrame:
    """Listing files(file_id, ...) of manifests that are not among ingested(file_id)."""
    return files.join(ingested.select("file_id").distinct(), "file_id", "left_anti")


def assert_ingested(files: DataFrame, ingested: DataFrame) -> None:
    """Verification needs every listing file: the first few missing ones are named in the error."""
    gone = [r.file_id for r in missing_files(files, ingested).select("file_id").limit(5).collect()]
    if gone:
        raise ValueError(f"listing files are not ingested yet: {', '.join(map(str, gone))}")


def fetch_worklist(inventory: DataFrame, raw: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """Narinfo rows of inventory whose body is not in raw(key), of files not in done(file_id); `force` ignores done."""
    rows = narinfo_only(inventory)
    if not force:
        rows = rows.join(done.select("file_id").distinct(), "file_id", "left_anti")
    return rows.join(raw.select("key"), "key", "left_anti")


def verify_objects(inventory: DataFrame, raw: DataFrame) -> DataFrame:
    """(file_id, key, size, e_tag, status) of narinfo rows: missing, unverifiable (the e-tag is no MD5), verified or bad_checksum.

    Only checksums are shuffled, not bodies. A key that is stored more than once is verified if all its bodies are, so each listed row gives one.
    """
    sums = raw.select("key", F.md5("content").alias("md5")).groupBy("key")
    sums = sums.agg(F.min("md5").alias("least"), F.max("md5").alias("most"))
    sums = sums.select("key", F.when(F.col("least") == F.col("most"), F.col("least")).otherwise("several").alias("md5"))
    rows = narinfo_only(inventory).select("file_id", "key", "size", "e_tag").join(sums, "key", "left")
    status = (
        F.when(F.col("md5").isNull(), "missing")
        .when(~F.coalesce(F.col("e_tag").rlike(MD5), F.lit(False)), "unverifiable")
        .when(F.col("md5") == F.lower("e_tag"), "verified")
        .otherwise("bad_checksum")
    )
    return rows.select("file_id", "key", "size", "e_tag", status.alias("status"))


def drop_invalid(raw: DataFrame, verified: DataFrame) -> DataFrame:
    """raw without the bodies whose checksum differs."""
    return raw.join(verified.where("status = 'bad_checksum'").select("key").distinct(), "key", "left_anti")


def checksum_gate(objects: DataFrame, expected: str = "e_tag") -> tuple[DataFrame, DataFrame]:
    """objects(key, content, <expected>) that have the MD5 they should, and the others with the reason, for quarantine."""
    bad = F.when(~F.coalesce(F.col(expected).rlike(MD5), F.lit(False)), "no_md5").when(F.md5("content") != F.lower(expected), "bad_checksum")
    rows = objects.withColumn("reason", bad)
    return rows.where("reason is null").drop("reason"), rows.where("reason is not null")


def _counts() -> list:
    n = F.col("narinfo")
    of = lambda status: F.count_if(F.col("status") == status)
    return [
        F.count("*").alias("objects_count"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("objects_size"),
        F.count_if(n).alias("narinfo_count"),
        F.coalesce(F.sum(F.when(n, F.col("size"))), F.lit(0)).cast("bigint").alias("narinfo_size"),
        *[of(s).alias(name) for s, name in (("verified", "verified"), ("missing", "missing"), ("unverifiable", "invalid"), ("bad_checksum", "bad_checksum"))],
    ]


def verify_stats(inventory: DataFrame, raw: DataFrame) -> DataFrame:
    """Counts and bytes for each file_id, and of all files in a row whose is_total is 1 and file_id null.

    Rows of the inventory are counted before the join, statuses after it, so only narinfo rows meet the bodies' checksums.
    """
    statuses = verify_objects(inventory, raw).select("file_id", "size", "status", F.lit(True).alias("narinfo"))
    others = inventory.where(~F.coalesce(F.endswith("key", F.lit(".narinfo")), F.lit(False)))
    others = others.select("file_id", "size", F.lit(None).cast("string").alias("status"), F.lit(False).alias("narinfo"))
    rows = statuses.unionByName(others)
    per_file = rows.groupBy("file_id").agg(*_counts())
    names = [c for c in per_file.columns if c != "file_id"]  # the total adds up the few rows of the files, not the objects again
    return per_file.rollup("file_id").agg(F.grouping("file_id").cast("int").alias("is_total"), *[F.sum(c).cast("bigint").alias(c) for c in names])


def stats_text(stats: DataFrame) -> DataFrame:
    """verify_stats() for people: sizes as "1.5 kB" and counts as "1,234", null where they are zero."""
    shown = lambda c: F.when(F.col(c) != 0, human_bytes(c) if c.endswith("_size") else comma_count(c)).alias(c)
    return stats.select("file_id", "is_total", *[shown(c) for c in stats.columns if c not in ("file_id", "is_total")])


def stats_document(stats: DataFrame) -> DataFrame:
    """(document): the totals of verify_stats() as indented JSON, without the numbers that are zero."""
    text = stats_text(stats.where("is_total = 1"))
    objects = F.struct(F.col("objects_size").alias("size"), F.col("objects_count").alias("count"))
    narinfo = F.struct(F.col("narinfo_size").alias("size"), F.col("narinfo_count").alias("count"), "verified", "missing", "invalid", "bad_checksum")
    return text.select(F.to_json(F.struct(objects.alias("objects"), narinfo.alias("narinfo")), {"pretty": "true"}).alias("document"))


def with_deleted(stats: DataFrame, dropped: DataFrame) -> DataFrame:
    """verify_stats() with `deleted`: how many keys of dropped(file_id, key) each file has, and all have in the total."""
    gone = dropped.select("file_id", "key").distinct().rollup("file_id").agg(F.grouping("file_id").cast("int").alias("is_total"), F.count("*").alias("deleted"))
    of = gone.select(F.col("file_id").alias("of_file"), F.col("is_total").alias("of_total"), "deleted")
    rows = stats.join(of, stats["file_id"].eqNullSafe(of["of_file"]) & (stats["is_total"] == of["of_total"]), "left")
    return rows.select(*stats.columns, F.coalesce("deleted", F.lit(0)).alias("deleted"))


#: Keys of bodies that are broadcast at most when files are written again.
BROADCAST_ROWS = 500_000


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def finish_swap(spark: SparkSession, raw_path: str) -> None:
    """Carry out the moves that a swap of files has noted, as far as they are not done; nothing if none is noted."""
    base = raw_path.rstrip("/")
    note, files = _hadoop(spark, f"{base}-swap")
    if not files.exists(_hadoop(spark, f"{base}-swap/_SUCCESS")[0]):
        return
    files.mkdirs(_hadoop(spark, f"{base}-replaced")[0])
    for kind, into in (("old", f"{base}-replaced"), ("new", base)):
        for r in spark.read.schema("kind string, file string").json(f"{base}-swap").where(F.col("kind") == kind).collect():
            source, target = _hadoop(spark, r.file)[0], _hadoop(spark, f"{into}/{r.file.rsplit('/', 1)[1]}")[0]
            if files.exists(source) and not files.rename(source, target):
                raise OSError(f"could not move {source} to {target}")
    files.delete(_hadoop(spark, f"{base}-new")[0], True)
    files.delete(note, True)


def swap_files(spark: SparkSession, base: str, old: list[str]) -> None:
    """Put the files of <base>-new in the place of `old` ones, which go to <base>-replaced: the moves are noted, then made."""
    staged, files = _hadoop(spark, f"{base}-new")
    new = [str(f.getPath().toString()) for f in files.listStatus(staged) if f.getPath().getName().startswith("part-")]
    noted = [("old", f) for f in old] + [("new", f) for f in new]
    spark.createDataFrame(noted, "kind string, file string").coalesce(1).write.mode("overwrite").json(f"{base}-swap")
    finish_swap(spark, base)


def rewrite_valid(raw_path: str, verified: DataFrame) -> int:
    """Take the bodies whose checksum differs out of the table of bodies at `raw_path`; returns how many.

    Only files that hold such bodies are written again, found by key and file name; the others stay as they are. The old files go to
    <path>-replaced. The moves are noted in <path>-swap before the first is made, so that a run that ended among them is finished by the next
    one, or by finish_swap(). Bodies are not shuffled: each group of files is read with a broadcast list of at most `BROADCAST_ROWS`
    keys, or with those of one file.
    """
    spark, base = verified.sparkSession, raw_path.rstrip("/")
    finish_swap(spark, base)
    bad = verified.where("status = 'bad_checksum'").select("key").distinct()
    where = spark.read.parquet(base).select("key", F.col("_metadata.file_path").alias("file"))
    found = f"{base}-found"
    where.join(bad, "key", "left_semi").write.mode("overwrite").parquet(found)
    hits = spark.read.schema("key string, file string").parquet(found)
    names = hits.groupBy("file").agg(F.count("*").alias("n")).orderBy("file").collect()  # a row for each file to be written again
    groups: list[tuple[list[str], int]] = []
    for r in names:
        if not groups or groups[-1][1] + r.n > BROADCAST_ROWS:
            groups.append(([], 0))
        groups[-1] = ([*groups[-1][0], r.file], groups[-1][1] + r.n)
    _, files = _hadoop(spark, base)
    files.delete(_hadoop(spark, f"{base}-new")[0], True)
    for some, _ in groups:
        gone = hits.where(F.col("file").isin(some)).select("key").distinct()
        spark.read.parquet(*some).join(F.broadcast(gone), "key", "left_anti").write.mode("append").parquet(f"{base}-new")
    if names:
        swap_files(spark, base, [r.file for r in names])
    files.delete(_hadoop(spark, found)[0], True)
    return sum(r.n for r in names)


def running_totals(per_file: DataFrame) -> DataFrame:
    """Per-file counts with running sums in file order."""
    names = ["objects_count", "objects_size", "narinfo_count", "verified", "missing", "bad_checksum"]
    return running_sums(per_file.where("is_total = 0").select("file_id", *names), "file_id", names).drop(*names)


def shard_counts(df: DataFrame, width: int = 3) -> DataFrame:
    """Narinfos by the first characters of their keys."""
    return narinfo_only(df).groupBy(F.left("key", F.lit(width)).alias("shard")).agg(F.count("*").alias("n"))
