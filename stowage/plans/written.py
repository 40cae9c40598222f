"""Queries of jobs that write tables and read them back, with the SQL each must equal."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stowage.functions import hashes
from stowage.operators import audit, buckets, gc, ledger, merge, retention
from stowage.operators import narinfo as nar
from stowage.operators.running import running_sums
from stowage.plans import derived
from stowage.plans.catalogue import _GOOD, _KEEP, _PLAN, _ROLLUP, _query
from stowage.session import scratch
from stowage.sources import readers, schemas
from stowage.streaming import ingest

# Deletion runs


def _store(keys: list[str]) -> dict[str, str | tuple[str, str]]:
    """A store that tells by a key's sixth character that it is not there or may not be deleted."""
    said = {k: "NoSuchKey" if k[5] in "01" else ("AccessDenied", "denied") if k[5] == "2" else "" for k in keys}
    return {k: v for k, v in said.items() if v}


_STATUS = """CASE WHEN substr(key, 6, 1) = '2' THEN 'failed' WHEN substr(key, 6, 1) NOT IN ('0', '1') THEN 'removed' WHEN class = 'nar' THEN 'gone' ELSE 'not_found' END"""


def _resumed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of three attempts: one that ended after it claimed the NARs, one that stopped after a batch, one that went on to the end."""
    path = scratch(spark)
    keys = ledger.plan(derived.gc_targets(spark, sf_dir), path, keys_a_batch=5_000)
    ledger.claim(keys.where("class = 'nar'"), path, "attempt-1")
    ledger.attempt(spark, path, _store, "attempt-2", max_batches=1)
    ledger.attempt(spark, path, _store, "attempt-3")
    return ledger.records(spark, path)


@_query(f"""WITH {derived.SQL_GC}
SELECT key, class, store_path, {_STATUS} AS status, CASE WHEN substr(key, 6, 1) = '2' THEN 's3 error: code = AccessDenied, message = denied' ELSE '' END AS error FROM keys""")
def gc_ledger_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resumed_run(spark, sf_dir)


@_query(f"""WITH {derived.SQL_GC}, told AS (SELECT *, {_STATUS} AS status FROM keys)
SELECT class, CAST(count(*) AS BIGINT) AS attempted, """ + ", ".join(f"CAST(count(*) FILTER (status = '{s}') AS BIGINT) AS {s}" for s in ledger.STATES) + " FROM told GROUP BY class")
def gc_ledger_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.stats(_resumed_run(spark, sf_dir))


@_query(f"""WITH {derived.SQL_GC}
SELECT key, store_path, status = 'not_found' AND NOT starts_with(key, 'nar/0') AS not_found,
    CASE WHEN status = 'not_found' AND starts_with(key, 'nar/0') THEN '{gc.NOT_LISTED}' ELSE '' END AS error FROM dry""")
def gc_partly_listed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry run of which one prefix could not be listed, read back."""
    path = scratch(spark)
    gc.collect_garbage(derived.gc_targets(spark, sf_dir), path, listing=derived.listing(spark, sf_dir), unlisted=("nar/0",))
    return spark.read.schema(schemas.REMOVAL).parquet(path)


@_query(f"WITH {derived.SQL_NARINFO} SELECT hash, rule FROM narinfo, (VALUES ('hash_length', 3), ('file_hash_length', 5)) AS rules(rule, k) WHERE p_partkey % k = 0")
def target_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of which every third has a hash that is too short, every fifth a file hash that is too long."""
    rows = derived.narinfo(spark, sf_dir).withColumn("whole", F.lower(F.hex("hash")))
    rows = rows.withColumns({"hash": F.expr("if(p_partkey % 3 = 0, substring(hash, 1, 19), hash)"), "file_hash": F.expr("if(p_partkey % 5 = 0, concat(file_hash, X'00'), file_hash)")})
    told = readers.target_violations(rows).withColumn("start", F.lower(F.hex(F.expr("substring(hash, 1, 19)"))))
    return told.join(rows.select("whole", F.left("whole", F.lit(38)).alias("start")), "start").select(F.col("whole").alias("hash"), "rule")


@_query(f"WITH {derived.SQL_LOCATED} SELECT p_partkey, b32 AS hash_text, file_b32 AS file_text FROM located")
def hash_sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL functions for base-32 text, over bytes and over hexadecimal text."""
    hashes.register(spark)
    derived.narinfo(spark, sf_dir).createOrReplaceTempView("stowage_hashes")
    return spark.sql("SELECT p_partkey, nixbase32(hash) AS hash_text, nixbase32_hex(lower(hex(file_hash))) AS file_text FROM stowage_hashes")


# Reports


def _put(spark: SparkSession, path: str, text: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    out.write(bytearray(text.encode()))
    out.close()


def _stored_report(spark: SparkSession, sf_dir: str) -> str:
    """Manifests and listing files as a store holds them: <root>/<report>/manifest.json and <root>/data/<file>."""
    root = scratch(spark)
    for r in derived.manifests(spark, sf_dir).select("report_id", F.to_json(F.struct(*[c.strip() for c in ("files", "sourceBucket", "destinationBucket", "version", "creationTimestamp", "fileFormat")]), {"pretty": "true"}).alias("text")).collect():
        _put(spark, f"{root}/{r.report_id}/manifest.json", r.text)  # a manifest for each report
    rows = derived.inventory(spark, sf_dir).withColumn("last_modified_date", F.timestamp_seconds("modified")).drop("modified")
    rows.repartition("file_id").write.partitionBy("file_id").parquet(f"{root}/parts")
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(f"{root}/data"))
    for folder in files.listStatus(path(f"{root}/parts")):
        if (name := folder.getPath().getName()).startswith("file_id="):
            part = next(f.getPath() for f in files.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-"))
            files.rename(part, path(f"{root}/data/{name.removeprefix('file_id=')}"))
    return root


@_query(
    f"WITH {derived.SQL_MANIFESTS} SELECT report_id, CAST(row_number() OVER (PARTITION BY report_id ORDER BY key) - 1 AS INTEGER) AS file_index, key, size, \"MD5checksum\", file_id FROM listed"
)
def manifests_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.manifest_files(readers.read_manifests(spark, _stored_report(spark, sf_dir)))


@_query(f"""WITH {derived.SQL_MANIFESTS} SELECT bucket, key, size, e_tag, storage_class, i.file_id, modified * 1000 AS last_modified_ms
FROM inventory i WHERE i.file_id IN (SELECT file_id FROM listed WHERE report_id = '{derived.REPORTS[1]}')""")
def report_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All listing files of one report, found by its manifest."""
    root = _stored_report(spark, sf_dir)
    rows = readers.read_inventory(spark, root, readers.read_manifests(spark, root, [derived.REPORTS[1]]), derived.REPORTS[1])
    return readers.with_millis(rows).drop("last_modified_date")


@_query(
    f"WITH {derived.SQL_MANIFESTS} SELECT DISTINCT 'data/' || file_id AS key, 'data' AS kind FROM inventory"
    " UNION ALL SELECT DISTINCT report_id || '/manifest.json', 'manifest' FROM listed"
)
def report_store_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a store of reports holds, listed by tasks."""
    root = _stored_report(spark, sf_dir)
    rows = readers.list_by_shards(spark, root).where("size > 0 and key not like 'parts/%' and not key rlike '(^|/)[._][^/]*$'")
    return rows.select("key", F.when(F.startswith("key", F.lit("data/")), "data").otherwise("manifest").alias("kind"))


@_query(f"""WITH {derived.SQL_INVENTORY} SELECT CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS breaks, true AS follows, min(key) AS first, max(key) AS last FROM inventory""")
def merged_files_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a sorted merge, proven to be in order by one scan."""
    path = f"{scratch(spark)}/merged"
    merge.merge_inventory(derived.inventory(spark, sf_dir), path, rows_a_file=400)
    files = merge.order_breaks(spark, path)
    return files.agg(F.sum("rows").alias("rows"), F.sum("breaks").alias("breaks"), F.every("follows").alias("follows"), F.min("first").alias("first"), F.max("last").alias("last"))


@_query(f"WITH {derived.SQL_LOCATED} SELECT hash, pname, file_size FROM located WHERE {_GOOD} AND p_partkey % 29 <> 0 AND hash IN (SELECT sha1(CAST(k AS VARCHAR)) FROM (SELECT unnest([1, 2, 50, 77, 190]) AS k))")
def narinfo_look_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few hashes looked up in an export with Bloom filters."""
    path = f"{scratch(spark)}/table"
    merge.export_narinfos(nar.parse_narinfos(derived.narinfo_bodies(spark, sf_dir)).records, path, look_up=100_000)
    hashed = [hashlib.sha1(str(k).encode()).digest() for k in (1, 2, 50, 77, 190)]
    return merge.look_up(spark, path, hashed).select(F.lower(F.hex("hash")).alias("hash"), "pname", F.col("file_size").cast("bigint").alias("file_size"))


@_query(f"WITH {derived.SQL_GC} SELECT CAST(count(DISTINCT substr(store_path, 12, 32)) AS BIGINT) AS store_paths, true AS close FROM keys")
def gc_store_paths_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct store paths of three runs that share keys, exact and by their merged sketches, which must be within 6 %."""
    keys = gc.dedup_keys(gc.expand_targets(derived.gc_targets(spark, sf_dir)))
    runs = [keys.where("class = 'nar'"), keys.where("class = 'narinfo' and key < 'm'"), keys.where("key >= 'k'")]
    sketches = gc.store_path_sketch(runs[0]).union(gc.store_path_sketch(runs[1])).union(gc.store_path_sketch(runs[2]))
    exact = keys.agg(F.count_distinct(F.substring("store_path", 12, 32)).alias("store_paths"))
    close = F.abs(F.col("store_paths") - F.col("estimate")) <= 0.06 * F.col("store_paths")
    return exact.join(gc.store_paths_of_all(sketches).withColumnRenamed("store_paths", "estimate")).select("store_paths", close.alias("close"))  # a row each


@_query(f"WITH {derived.SQL_INVENTORY} SELECT key, size, CAST(sum(size) OVER (ORDER BY key ROWS UNBOUNDED PRECEDING) AS BIGINT) AS size_so_far FROM inventory")
def inventory_running_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes up to and with each object, in key order."""
    return running_sums(derived.inventory(spark, sf_dir).select("key", "size"), "key", ["size"])


# Ingest and verification

_REASON = "CASE WHEN doc_id % 101 = 0 THEN 'no_md5' WHEN doc_id % 17 = 0 THEN 'bad_checksum' END"


def _source(bodies: DataFrame, path: str, bytes_a_file: int = 64 << 20, bodies_a_batch: int = 500_000) -> int:
    """Write bodies as files that arrive, four at least and of bounded size; returns how many files make a batch: two batches at least, of bounded numbers."""
    size = bodies.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("content")), F.lit(0)).alias("bytes")).first()
    files, batches = max(4, -(-size.bytes // bytes_a_file)), max(2, -(-size.n // bodies_a_batch))
    bodies.repartition(files).write.parquet(path)
    return max(1, files // batches)


def _streamed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All bodies as a stream of files in two batches or more."""
    root = scratch(spark)
    a_batch = _source(derived.raw_narinfo(spark, sf_dir), f"{root}/source")
    arrivals = spark.readStream.schema(schemas.RAW_NARINFO).option("maxFilesPerTrigger", a_batch).parquet(f"{root}/source")
    listing = scratch(spark)  # read by every batch
    derived.inventory(spark, sf_dir).select("key", "e_tag", "file_id").write.parquet(listing)
    ingest.stream_checked(arrivals, spark.read.parquet(listing), f"{root}/tables", f"{root}/checkpoint")
    return ingest.checked_tables(spark, f"{root}/tables")


@_query(
    f"WITH {derived.SQL_INVENTORY} SELECT key, md5(CASE WHEN doc_id % 17 = 0 THEN text || 'x' ELSE text END) AS md5, {_REASON} AS reason"
    " FROM inventory JOIN documents USING (doc_id) WHERE doc_id % 13 <> 0"
)
def ingest_stream_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, bad, _ = _streamed(spark, sf_dir)
    return raw.select("key", F.md5("content").alias("md5"), F.lit(None).cast("string").alias("reason")).union(bad.select("key", "md5", "reason"))


@_query(f"WITH {derived.SQL_INVENTORY} SELECT DISTINCT file_id FROM inventory WHERE file_id NOT IN (SELECT file_id FROM inventory WHERE doc_id % 13 = 0 OR doc_id % 101 = 0 OR doc_id % 17 = 0)")
def ingest_stream_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir)[2].select("file_id")


@_query(
    f"WITH {derived.SQL_INVENTORY} SELECT CASE WHEN doc_id % 13 = 0 OR {_REASON} IS NOT NULL THEN 'missing' ELSE 'verified' END AS status, CAST(2 * count(*) AS BIGINT) AS n"
    " FROM inventory WHERE doc_id IS NOT NULL GROUP BY 1"
)
def ingest_listed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ingest of a report that lists each body in two files, verified after: a body is stored once, and each listed row counts once."""
    root, listed = scratch(spark), derived.inventory(spark, sf_dir)
    listed = listed.unionByName(listed.withColumn("file_id", F.concat(F.lit("again-"), "file_id")))
    bodies = derived.raw_narinfo(spark, sf_dir)
    bodies.limit(0).write.parquet(f"{root}/raw")
    ingest.ingest_report(listed, bodies, f"{root}/raw", f"{root}/bad", spark.createDataFrame([], "file_id string"))
    return audit.verify_objects(listed, spark.read.parquet(f"{root}/raw")).groupBy("status").agg(F.count("*").alias("n"))


@_query(
    f"WITH {derived.SQL_INVENTORY} SELECT key, md5(CASE WHEN doc_id % 17 = 0 THEN text || 'x' ELSE text END) AS md5 FROM verified JOIN documents USING (doc_id)"
    " WHERE doc_id % 13 <> 0 AND status <> 'bad_checksum'"
)
def drop_invalid_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored bodies after the files that held bad ones were written again."""
    path = f"{scratch(spark)}/raw"
    derived.raw_narinfo(spark, sf_dir).write.parquet(path)
    audit.rewrite_valid(path, audit.verify_objects(derived.inventory(spark, sf_dir), spark.read.parquet(path)))
    return spark.read.parquet(path).select("key", F.md5("content").alias("md5"))


def _in_buckets(spark: SparkSession, sf_dir: str) -> tuple[str, str, int]:
    """Name, folder and buckets of the bodies in buckets: half is written, the table is declared anew, the other half is appended."""
    name, path, n = f"bodies_{uuid.uuid4().hex}", f"{scratch(spark)}/raw", max(8, spark.sparkContext.defaultParallelism)
    raw = derived.raw_narinfo(spark, sf_dir)
    buckets.write_bodies(raw.where("key < 'h'"), name, path, n)
    spark.sql(f"DROP TABLE {name}")
    buckets.declare(spark, name, path, n)
    buckets.append_bodies(raw.where("key >= 'h'"), name, path, n)
    return name, path, n


@_query(f"WITH {derived.SQL_INVENTORY} SELECT file_id, key, size, e_tag, status FROM verified")
def verify_status_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verification of bodies that are in buckets by key: they are read where they are."""
    return audit.verify_objects(derived.inventory(spark, sf_dir), spark.table(_in_buckets(spark, sf_dir)[0]))


@_query(
    f"WITH {derived.SQL_INVENTORY} SELECT key, md5(CASE WHEN doc_id % 17 = 0 THEN text || 'x' ELSE text END) AS md5 FROM verified JOIN documents USING (doc_id)"
    " WHERE doc_id % 13 <> 0 AND status <> 'bad_checksum'"
)
def drop_invalid_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is in the buckets after the files with bad bodies were written again."""
    name, path, n = _in_buckets(spark, sf_dir)
    buckets.rewrite_buckets(name, path, n, audit.verify_objects(derived.inventory(spark, sf_dir), spark.table(name)))
    return spark.table(name).select("key", F.md5("content").alias("md5"))


@_query(f"WITH {_ROLLUP} SELECT file_id, is_total, narinfo_count, bad_checksum, bad_checksum AS deleted FROM rolled")
def verify_stats_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed, raw = derived.inventory(spark, sf_dir), derived.raw_narinfo(spark, sf_dir)
    dropped = audit.verify_objects(listed, raw).where("status = 'bad_checksum'")
    return audit.with_deleted(audit.verify_stats(listed, raw), dropped).select("file_id", "is_total", "narinfo_count", "bad_checksum", "deleted")


@_query(f"SELECT CAST(count(*) AS BIGINT) AS processed, CAST(count(*) FILTER ({_GOOD}) AS BIGINT) AS exported, CAST(count(*) FILTER (NOT ({_GOOD})) AS BIGINT) AS failed FROM part")
def export_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of an export, observed while it is written."""
    return merge.export_raw(derived.narinfo_bodies(spark, sf_dir), f"{scratch(spark)}/table")


# Retention


def _denied(keys: list[str]) -> dict[str, str | tuple[str, str]]:
    return {k: ("AccessDenied", "no") for k in keys if k[-1] in "02468"}


@_query(f"""WITH {_PLAN}, going AS (
    SELECT DISTINCT file_id, right(file_id, 1) IN ('0', '2', '4', '6', '8') AS denied FROM plan WHERE delete_file
), held AS (
    SELECT DISTINCT p.report_id FROM plan p JOIN going f ON p.file_id = f.file_id WHERE p.delete_file AND f.denied
)
SELECT 'file' AS class, file_id AS name, CASE WHEN denied THEN 's3 error: code = AccessDenied, message = no' ELSE '' END AS error FROM going
UNION ALL SELECT DISTINCT 'manifest', report_id, CASE WHEN report_id IN (SELECT report_id FROM held) THEN 'a file of it could not be deleted' ELSE '' END FROM plan""")
def retention_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan carried out in a store that denies some files."""
    path = scratch(spark)
    keep = retention.keep_list(spark, _KEEP.strip("()").replace("'", ""))
    retention.apply_retention(retention.plan_retention(derived.manifests(spark, sf_dir), keep), "reports/", "data/", _denied, path)
    return spark.read.parquet(path).select("class", "name", "error")
