"""Queries of the object-store jobs on tables derived from the given ones, with the SQL each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stowage.functions import hashes
from stowage.operators import audit, gc, merge, retention
from stowage.operators import narinfo as nar
from stowage.plans import derived
from stowage.session import scratch
from stowage.sources import readers, schemas
from stowage.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


# Rendering


@_query(f"WITH {derived.SQL_LOCATED} SELECT p_partkey, b32 AS hash_text, file_b32 AS file_text, nar_b32 AS nar_text FROM located")
def nixbase32_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived.narinfo(spark, sf_dir).withColumn("hexa", F.lower(F.hex("nar_hash")))
    rows = rows.withColumn("nar_text", hashes.nixbase32_hex("hexa"))
    rows = hashes.render_hashes(rows, {"hash": 20, "file_hash": 32})
    return rows.select("p_partkey", F.col("hash").alias("hash_text"), F.col("file_hash").alias("file_text"), "nar_text")


@_query(f"WITH {derived.SQL_NARINFO} SELECT p_partkey, hash AS hash_hex, file_hash AS file_hex FROM narinfo")
def nixbase32_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hashes.render_hashes(derived.narinfo(spark, sf_dir), {"hash": 20, "file_hash": 32})
    rows = hashes.decode_hashes(rows, {"hash": 20, "file_hash": 32})
    return rows.select("p_partkey", F.lower(F.hex("hash")).alias("hash_hex"), F.lower(F.hex("file_hash")).alias("file_hex"))


@_query(f"WITH {derived.SQL_LOCATED} SELECT p_partkey, nar_key AS url FROM located")
def nar_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashes.register(spark)
    derived.narinfo(spark, sf_dir).createOrReplaceTempView("stowage_narinfo")
    return spark.sql("SELECT p_partkey, narURL(file_hash, compression) AS url FROM stowage_narinfo")


@_query(f"WITH {derived.SQL_LOCATED} SELECT p_partkey, store_path, narinfo_key, nar_key FROM located")
def store_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashes.render_locations(derived.narinfo(spark, sf_dir)).select("p_partkey", "store_path", "narinfo_key", "nar_key")


# Reports


@_query(
    f"WITH {derived.SQL_MANIFESTS} SELECT report_id, CAST(count(*) AS BIGINT) AS n_files, CAST(sum(size) AS BIGINT) AS total_size,"
    " CASE WHEN report_id LIKE '2024-01-03%' THEN '' ELSE 'Parquet' END AS \"fileFormat\" FROM listed GROUP BY report_id"
)
def manifest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.manifest_report(derived.manifests(spark, sf_dir)).select("report_id", "n_files", "total_size", "fileFormat")


@_query(
    f"WITH {derived.SQL_MANIFESTS} SELECT report_id, CAST(row_number() OVER (PARTITION BY report_id ORDER BY key) - 1 AS INTEGER) AS file_index, key, size, file_id FROM listed"
)
def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.manifest_files(derived.manifests(spark, sf_dir)).select("report_id", "file_index", "key", "size", "file_id")


@_query(
    f"WITH {derived.SQL_MANIFESTS}, numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY report_id ORDER BY key) - 1 AS INTEGER) AS file_index FROM listed)"
    " SELECT report_id, 'file_without_size' AS rule, file_index FROM numbered WHERE size <= 0"
    " UNION ALL SELECT '2024-01-03T00-00Z', 'no_format', NULL"
)
def manifest_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.manifest_violations(derived.manifests(spark, sf_dir))


@_query(
    "SELECT DISTINCT strftime(ts, '%Y-%m-%dT%H-00Z') AS report_id FROM events WHERE event_id % 10 <> 0"
)
def report_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.date_format("ts", "yyyy-MM-dd'T'HH'-00Z'")
    keys = derived.table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("reports/data/"), name)).otherwise(F.concat(F.lit("reports/"), name, F.lit("/manifest.json"))).alias("key")
    )
    return readers.discover_reports(keys, "reports")


@_query(f"WITH {derived.SQL_INVENTORY} SELECT key, size, modified, e_tag, storage_class, file_id FROM inventory")
def inventory_merge_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merged(derived.inventory(spark, sf_dir), "key")


@_query(f"WITH {derived.SQL_MANIFESTS} SELECT report_id, file_id, size FROM listed WHERE right(file_id, 1) NOT IN ('1', '3', '5')")
def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = readers.manifest_files(derived.manifests(spark, sf_dir))
    return audit.missing_files(files, _ingested(spark, sf_dir)).select("report_id", "file_id", "size")


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.inventory(spark, sf_dir).where("right(file_id, 1) in ('1', '3', '5')").select("file_id").distinct()


@_query(f"WITH {derived.SQL_INVENTORY} SELECT key, modified * 1000 AS last_modified_ms FROM inventory")
def listing_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived.inventory(spark, sf_dir).withColumn("last_modified_date", F.timestamp_seconds("modified"))
    return readers.with_millis(rows).select("key", "last_modified_ms")


_WORK = "doc_id % 13 = 0"


@_query(f"WITH {derived.SQL_INVENTORY} SELECT key, file_id, size FROM inventory WHERE {_WORK} AND right(file_id, 1) NOT IN ('1', '3', '5')")
def fetch_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audit.fetch_worklist(derived.inventory(spark, sf_dir), derived.raw_narinfo(spark, sf_dir), _ingested(spark, sf_dir))
    return rows.select("key", "file_id", "size")


@_query(f"WITH {derived.SQL_INVENTORY} SELECT key, file_id, size FROM inventory WHERE {_WORK}")
def fetch_worklist_forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audit.fetch_worklist(derived.inventory(spark, sf_dir), derived.raw_narinfo(spark, sf_dir), _ingested(spark, sf_dir), force=True)
    return rows.select("key", "file_id", "size")


@_query(f"WITH {derived.SQL_INVENTORY} SELECT DISTINCT file_id FROM inventory WHERE file_id NOT IN (SELECT file_id FROM inventory WHERE {_WORK} AND right(file_id, 1) NOT IN ('1', '3', '5'))")
def files_marked_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = derived.inventory(spark, sf_dir).select("file_id").distinct()
    return ingest.mark_done(_ingested(spark, sf_dir), fetch_worklist(spark, sf_dir), files)


# Verification


@_query(f"WITH {derived.SQL_INVENTORY} SELECT file_id, key, size, e_tag, status FROM verified")
def verify_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.verify_objects(derived.inventory(spark, sf_dir), derived.raw_narinfo(spark, sf_dir))


_ROLLUP = f"""{derived.SQL_INVENTORY}, rolled AS (
    SELECT i.file_id, CAST(grouping(i.file_id) AS INTEGER) AS is_total, CAST(count(*) AS BIGINT) AS objects_count, CAST(sum(i.size) AS BIGINT) AS objects_size,
        CAST(count(i.doc_id) AS BIGINT) AS narinfo_count, CAST(coalesce(sum(i.size) FILTER (i.doc_id IS NOT NULL), 0) AS BIGINT) AS narinfo_size,
        CAST(count(*) FILTER (v.status = 'verified') AS BIGINT) AS verified, CAST(count(*) FILTER (v.status = 'missing') AS BIGINT) AS missing,
        CAST(count(*) FILTER (v.status = 'unverifiable') AS BIGINT) AS invalid, CAST(count(*) FILTER (v.status = 'bad_checksum') AS BIGINT) AS bad_checksum
    FROM inventory i LEFT JOIN verified v ON i.doc_id = v.doc_id GROUP BY ROLLUP (i.file_id)
)"""


@_query(f"WITH {_ROLLUP} SELECT * FROM rolled")
def verify_stats_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.verify_stats(derived.inventory(spark, sf_dir), derived.raw_narinfo(spark, sf_dir))


def _sql_size(c: str) -> str:
    units = " ".join(
        f"WHEN {c} >= 1e{3 * k} THEN (CASE WHEN round({c} / 1e{3 * k} * 10) / 10 < 10 THEN format('{{:.1f}}', round({c} / 1e{3 * k} * 10) / 10) ELSE format('{{:.0f}}', round({c} / 1e{3 * k} * 10) / 10) END) || ' {u}'"
        for k, u in reversed(list(enumerate(("kB", "MB", "GB", "TB"), 1)))
    )
    return f"CASE {units} WHEN {c} = 0 THEN NULL ELSE {c} || ' B' END AS {c}"


_COUNTS = ("objects_count", "narinfo_count", "verified", "missing", "invalid", "bad_checksum")


@_query(f"WITH {_ROLLUP} SELECT file_id, is_total, {_sql_size('objects_size')}, {_sql_size('narinfo_size')}, " + ", ".join(f"CASE WHEN {c} <> 0 THEN format('{{:,}}', {c}) END AS {c}" for c in _COUNTS) + " FROM rolled")
def verify_stats_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.stats_text(verify_stats_rollup(spark, sf_dir))


_SO_FAR = ", ".join(
    f"CAST(sum({c}) OVER (ORDER BY file_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS {c}_so_far" for c in ("objects_count", "objects_size", "narinfo_count", "verified", "missing", "bad_checksum")
)


@_query(f"WITH {_ROLLUP} SELECT file_id, {_SO_FAR} FROM rolled WHERE is_total = 0")
def verify_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.running_totals(verify_stats_rollup(spark, sf_dir))


@_query(
    f"WITH {derived.SQL_INVENTORY} SELECT key, md5(CASE WHEN doc_id % 17 = 0 THEN text || 'x' ELSE text END) AS md5 FROM verified JOIN documents USING (doc_id)"
    " WHERE doc_id % 13 <> 0 AND status <> 'bad_checksum'"
)
def drop_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derived.raw_narinfo(spark, sf_dir)
    verified = audit.verify_objects(derived.inventory(spark, sf_dir), raw)
    return audit.drop_invalid(raw, verified).select("key", F.md5("content").alias("md5"))


@_query(
    "SELECT doc_id, CASE WHEN doc_id % 101 = 0 THEN 'no_md5' ELSE 'bad_checksum' END AS reason FROM documents WHERE doc_id % 101 = 0 OR doc_id % 17 = 0"
)
def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = derived.table(spark, sf_dir, "documents")
    tag = F.when(F.col("doc_id") % 101 == 0, "none").otherwise(F.upper(F.md5("text")))
    text = F.when(F.col("doc_id") % 17 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    _, bad = audit.checksum_gate(docs.select("doc_id", F.encode(text, "UTF-8").alias("content"), tag.alias("e_tag")))
    return bad.select("doc_id", "reason")


@_query(f"WITH {derived.SQL_INVENTORY} SELECT left(key, 3) AS shard, CAST(count(*) AS BIGINT) AS n FROM inventory WHERE doc_id IS NOT NULL GROUP BY 1")
def shard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.shard_counts(derived.inventory(spark, sf_dir))


@_query(f"WITH {derived.SQL_INVENTORY} SELECT CASE WHEN doc_id IS NULL THEN 'nar' ELSE 'narinfo' END AS class, CAST(count(*) AS BIGINT) AS n, CAST(sum(size) AS BIGINT) AS bytes FROM inventory GROUP BY 1")
def object_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nar.classify_keys(derived.inventory(spark, sf_dir))
    return rows.groupBy("class").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))


# Narinfo texts

_BROKEN = {"store_path": "p_partkey % 23 = 0 AND p_partkey % 29 <> 0", "file_size": "p_partkey % 19 = 0", "nar_hash": "p_partkey % 31 = 0"}
_GOOD = " AND ".join(f"NOT ({c})" for c in _BROKEN.values())
_REFS = """entries AS (
    SELECT l_orderkey % (SELECT max(p_partkey) FROM part) + 1 AS of, list({'name': b32 || '-p', 'part': l_partkey} ORDER BY l_orderkey, l_linenumber, b32) AS es
    FROM lineitem JOIN located ON l_partkey = p_partkey GROUP BY 1
), listed AS (
    SELECT of, CASE WHEN of % 4 = 0 THEN list_sort(list_distinct(es)) ELSE es END AS es FROM entries
), refs AS (
    SELECT of, list_transform(es, lambda e: e.part) AS parts, list_transform(es, lambda e: e.name) AS names FROM listed
)"""


@_query(f"""WITH {derived.SQL_LOCATED}, {_REFS}
SELECT b32 || '.narinfo' AS key, CASE WHEN p_partkey % 29 = 0 THEN repeat('0', 40) ELSE hash END AS hash,
    CASE WHEN p_partkey % 29 = 0 THEN '' ELSE pname END AS pname,
    CASE WHEN p_partkey % 7 = 0 THEN 'bzip2' ELSE compression END AS compression, file_hash, nar_hash, file_size, nar_size,
    coalesce(array_to_string(list_transform(parts, lambda p: sha1(CAST(p AS VARCHAR))), ','), '') AS refs,
    CASE WHEN p_partkey % 2 = 0 THEN repeat('0', 40) ELSE hash END AS deriver, CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE pname END AS deriver_pname,
    'x86_64-linux' AS system, CASE WHEN p_partkey % 11 = 0 THEN 'fixed:r:sha256' END AS ca_algo, CASE WHEN p_partkey % 11 = 0 THEN nar_hash END AS ca_hash,
    coalesce(len(list_filter(range(1, len(names)), lambda i: names[i] >= names[i + 1])) > 0, false) AS out_of_order,
    p_partkey % 29 = 0 AS no_store_path
FROM located LEFT JOIN refs ON of = p_partkey WHERE {_GOOD}""")
def narinfo_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = nar.parse_narinfos(derived.narinfo_bodies(spark, sf_dir)).records
    text = lambda c: F.lower(F.hex(c)).alias(c)
    return r.select(
        "key", text("hash"), "pname", "compression", text("file_hash"), text("nar_hash"), F.col("file_size").cast("bigint").alias("file_size"),
        F.col("nar_size").cast("bigint").alias("nar_size"), F.lower(F.array_join(F.transform("references", F.hex), ",")).alias("refs"),
        text("deriver"), "deriver_pname", "system", "ca_algo", text("ca_hash"), F.col("quirk_references_out_of_order").alias("out_of_order"),
        F.col("dq_missing_store_path").alias("no_store_path"),
    )


@_query(f"WITH {derived.SQL_LOCATED} " + " UNION ALL ".join(f"SELECT narinfo_key AS key, '{rule}' AS rule FROM located WHERE {c}" for rule, c in _BROKEN.items()))
def narinfo_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nar.parse_narinfos(derived.narinfo_bodies(spark, sf_dir)).rejects


@_query(f"SELECT CAST(count(*) AS BIGINT) AS processed, CAST(count(*) FILTER ({_GOOD}) AS BIGINT) AS exported, CAST(count(*) FILTER (NOT ({_GOOD})) AS BIGINT) AS failed FROM part")
def parse_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nar.parse_narinfos(derived.narinfo_bodies(spark, sf_dir)).stats()


@_query(f"""WITH {derived.SQL_LOCATED}, {_REFS}
SELECT b32 || '.narinfo' AS key, len(list_filter(range(1, len(names)), lambda i: names[i] >= names[i + 1])) > 0 AS out_of_order, CAST(len(names) AS INTEGER) AS n_refs
FROM located JOIN refs ON of = p_partkey WHERE {_GOOD}""")
def references_quirk(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = nar.parse_narinfos(derived.narinfo_bodies(spark, sf_dir)).records.where("size(`references`) > 0")
    return r.select("key", F.col("quirk_references_out_of_order").alias("out_of_order"), F.size("references").alias("n_refs"))


@_query(f"WITH {derived.SQL_LOCATED} SELECT narinfo_key AS key, 0 AS place, 'cache-1' AS domain, nar_hash AS value FROM located WHERE {_GOOD}")
def narinfo_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = nar.signatures(nar.parse_narinfos(derived.narinfo_bodies(spark, sf_dir)).records)
    return s.select("key", "place", "domain", F.decode("value", "UTF-8").alias("value"))


@_query(f"""WITH {derived.SQL_LOCATED}, {_REFS}, edges AS (
    SELECT unnest(parts) AS part FROM located JOIN refs ON of = p_partkey WHERE {_GOOD}
) SELECT sha1(CAST(part AS VARCHAR)) AS reference, CAST(count(*) AS BIGINT) AS n FROM edges GROUP BY part""")
def reference_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = nar.reference_edges(nar.parse_narinfos(derived.narinfo_bodies(spark, sf_dir)).records)
    return edges.groupBy("reference").agg(F.count("*").alias("n")).select(F.lower(F.hex("reference")).alias("reference"), "n")


@_query(f"WITH {derived.SQL_LOCATED} SELECT CASE WHEN p_partkey % 29 = 0 THEN repeat('0', 40) ELSE hash END AS hash, nar_hash, file_size FROM located WHERE {_GOOD}")
def narinfo_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored bodies parsed, exported, and read back under the schema of collection targets."""
    path = scratch(spark)
    merge.export_raw(derived.narinfo_bodies(spark, sf_dir), f"{path}/table")
    text = lambda c: F.lower(F.hex(c)).alias(c)
    return readers.read_gc_targets(spark, f"{path}/table").select(text("hash"), text("nar_hash"), F.col("file_size").cast("bigint").alias("file_size"))


_FAULTS = {
    "StorePath": "store_path", "FileSize": "file_size", "NarSize": "nar_size", "FileHash": "file_hash", "NarHash": "nar_hash", "Deriver": "deriver", "CA": "ca", "Sig": "sig",
}


@_query("SELECT o_orderkey, rule FROM orders, (SELECT unnest(range(8)) AS k, unnest(" + str(list(_FAULTS.values())) + ") AS rule) WHERE o_orderkey % 8 = k")
def narinfo_every_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A body for each order with a fault in one field, all eight in turn."""
    k = F.col("o_orderkey") % len(_FAULTS)
    field = F.element_at(F.array(*[F.lit(f) for f in _FAULTS]), (k + 1).cast("int"))
    text = F.concat(F.lit("System: x86_64-linux\nCompression: xz\n"), field, F.lit(": /broken "), F.col("o_orderkey").cast("string"), F.lit("\n"))
    raw = derived.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.encode(text, "UTF-8").alias("content"))
    return nar.parse_narinfos(raw).rejects.select(F.col("key").alias("o_orderkey"), "rule")


#: A field, SQL for its value with h and b, 64 hexadecimal and 52 base-32 digits, and the rule that it breaks, if any: each on one side of a limit.
_LIMITS = (
    ("FileSize", "'18446744073709551615'", None),
    ("FileSize", "'18446744073709551616'", "file_size"),
    ("FileSize", "concat(id, 'x')", "file_size"),
    ("NarSize", "concat(repeat('0', 25), id)", None),
    ("NarSize", "concat('-', id)", "nar_size"),
    ("NarSize", "''", "nar_size"),
    ("FileHash", "concat('sha256:', h)", None),
    ("FileHash", "concat('sha256:', left(h, 63))", "file_hash"),
    ("FileHash", "concat('sha256:', b, '0')", "file_hash"),
    ("NarHash", "concat('sha256:', b)", None),
    ("NarHash", "concat('sha256:e', substring(b, 2))", "nar_hash"),
    ("NarHash", "concat('sha512:', b)", "nar_hash"),
    ("StorePath", "concat('/nix/store/', right(b, 32), '-x')", None),
    ("StorePath", "concat('/nix/store/', right(b, 32), '-')", "store_path"),
    ("StorePath", "concat('/nix/store/', right(b, 31), '-x')", "store_path"),
    ("Deriver", "concat(right(b, 32), '-x.drv')", None),
    ("Deriver", "concat(right(b, 32), 'x.drv')", "deriver"),
    ("CA", "concat('fixed:sha1:', left(h, 40))", None),
    ("CA", "concat('fixed:sha1:', left(h, 39))", "ca"),
    ("CA", "concat('other:sha256:', b)", "ca"),
    ("Sig", "concat('k-1:', base64(encode(h, 'UTF-8')))", None),
    ("Sig", "concat('k-1:', base64(encode(left(h, 63), 'UTF-8')))", "sig"),
    ("Sig", "base64(encode(h, 'UTF-8'))", "sig"),
)


@_query("SELECT o_orderkey, rule FROM orders JOIN (VALUES " + ", ".join(f"({k}, '{rule or 'none'}')" for k, (_, _, rule) in enumerate(_LIMITS)) + f") AS f(k, rule) ON o_orderkey % {len(_LIMITS)} = k")
def narinfo_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A body for each order with a field just within or just past what its rule allows, in turn; `none` for those that are accepted."""
    rows = derived.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("id"))
    rows = rows.withColumn("h", F.sha2("id", 256)).withColumn("b", hashes.nixbase32_hex("h", 32))
    k = F.col("o_orderkey") % len(_LIMITS)
    line = F.lit(None).cast("string")
    for at, (field, value, _) in enumerate(_LIMITS):
        line = F.when(k == at, F.concat(F.lit(f"{field}: "), F.regexp_replace(F.expr(value), "[\r\n]", ""))).otherwise(line)
    raw = rows.select(F.col("o_orderkey").alias("key"), F.encode(F.concat(line, F.lit("\nSystem: x86_64-linux\n")), "UTF-8").alias("content"))
    parsed = nar.parse_narinfos(raw)
    return parsed.rejects.union(parsed.records.select("key", F.lit("none"))).select(F.col("key").alias("o_orderkey"), "rule")


_DIGEST = {"md5": ("md5({})", 16), "sha1": ("sha1({})", 20), "sha256": ("sha256({})", 32), "sha512": ("sha256({0}) || sha256('x' || {0})", 64)}


@_query("SELECT o_orderkey, algo AS ca_algo, hash AS ca_hash, CAST(2 AS INTEGER) AS signatures FROM (" + " UNION ALL ".join(
    f"SELECT o_orderkey, '{'fixed:r:' if k % 2 else 'text:'}{a}' AS algo, {sql.format('CAST(o_orderkey AS VARCHAR)')} AS hash FROM orders WHERE o_orderkey % 4 = {k}" for k, (a, (sql, _)) in enumerate(_DIGEST.items())
) + ")")
def narinfo_content_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A body for each order with a content address, in base 32 or hexadecimal, of each algorithm, and two signatures."""
    rows, key = derived.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("id")), F.col("o_orderkey")
    hexa = F.when(key % 4 == 0, F.md5("id")).when(key % 4 == 1, F.sha1("id")).when(key % 4 == 2, F.sha2("id", 256)).otherwise(F.concat(F.sha2("id", 256), F.sha2(F.concat(F.lit("x"), "id"), 256)))
    rows = rows.withColumn("hexa", hexa).withColumn("ca", F.when(key % 3 == 0, F.col("hexa")).otherwise(hashes.nixbase32_hex("hexa")))
    algo = F.element_at(F.array(*[F.lit(f"{'fixed:r:' if k % 2 else 'text:'}{a}") for k, a in enumerate(_DIGEST)]), (key % 4 + 1).cast("int"))
    sig = F.concat(F.regexp_replace(F.base64(F.encode(F.sha2("id", 256), "UTF-8")), "[\r\n]", ""), F.lit("\n"))
    text = F.concat(F.lit("CA: "), algo, F.lit(":"), "ca", F.lit("\nSig: a-1:"), sig, F.lit("Sig: b-1:"), sig)
    r = nar.parse_narinfos(rows.select(key.alias("key"), F.encode(text, "UTF-8").alias("content"))).records
    return r.select(F.col("key").alias("o_orderkey"), "ca_algo", F.lower(F.hex("ca_hash")).alias("ca_hash"), F.size("signature_values").alias("signatures"))


# Garbage collection


@_query(f"""WITH {derived.SQL_LOCATED}
SELECT narinfo_key AS key, 'narinfo' AS class, store_path FROM located WHERE p_partkey % 2 = 0
UNION ALL SELECT nar_key, 'nar', store_path FROM located WHERE p_partkey % 2 = 0""")
def gc_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gc.expand_targets(derived.gc_targets(spark, sf_dir))


@_query(f"WITH {derived.SQL_GC} SELECT key, class, store_path, CAST(n_targets AS BIGINT) AS n_targets FROM keys")
def gc_key_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gc.dedup_keys(gc_keys(spark, sf_dir))


@_query(f"WITH {derived.SQL_GC} SELECT key, class, store_path, CAST(n_targets AS BIGINT) AS n_targets, status FROM dry")
def gc_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gc.dry_run(gc_key_dedup(spark, sf_dir), derived.listing(spark, sf_dir))


@_query(f"""WITH {derived.SQL_GC}
SELECT key, class, store_path, status = 'not_found' AS not_found,
    CASE WHEN status = 'present' AND right(store_path, 1) = 'n' THEN 's3 error: code = AccessDenied, message = denied' ELSE '' END AS error FROM dry""")
def gc_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gc_dry_run(spark, sf_dir)
    code = F.when(F.col("status") == "not_found", "NoSuchKey").when(F.right("store_path", F.lit(1)) == "n", "AccessDenied")
    return gc.merge_outcomes(rows, rows.select("key", code.alias("code"), F.lit("denied").alias("message")))


_STATS = ", ".join(
    f"CAST(count(*) FILTER (class = '{c}') AS BIGINT) AS attempted_{c}s, CAST(0 AS BIGINT) AS removed_{c}s,"
    f" CAST(count(*) FILTER (class = '{c}' AND status = 'not_found') AS BIGINT) AS not_found_{c}s, CAST(0 AS BIGINT) AS errors_{c}s"
    for c in ("nar", "narinfo")
)
_ALL_STATS = f"""WITH {derived.SQL_GC} SELECT (SELECT CAST(count(*) AS BIGINT) FROM part WHERE p_partkey % 2 = 0) AS targets, {_STATS},
    CAST(count(DISTINCT substr(store_path, 12, 32)) AS BIGINT) AS store_paths, true AS dry_run FROM dry"""


@_query(_ALL_STATS)
def gc_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gc_dry_run(spark, sf_dir)
    records = rows.select("key", "class", "store_path", (F.col("status") == "not_found").alias("not_found"), F.lit("").alias("error"))
    return gc.gc_stats(records, derived.gc_targets(spark, sf_dir), dry=True)


@_query(
    f"SELECT dry_run, targets AS targets_narinfos, attempted_nars AS removed_nars, attempted_narinfos AS removed_narinfos, CAST(0 AS BIGINT) AS removed_errors,"
    f" not_found_nars AS missing_nars, not_found_narinfos AS missing_narinfos FROM ({_ALL_STATS})"
)
def gc_stats_compatible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gc.compatible_stats(gc_stats(spark, sf_dir))


@_query(f"""WITH {derived.SQL_GC}
SELECT key, class, store_path, CASE WHEN status = 'not_found' AND starts_with(key, 'nar/0') THEN 'unknown' ELSE status END AS status FROM dry""")
def gc_dry_run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gc.dry_run(gc_key_dedup(spark, sf_dir), derived.listing(spark, sf_dir), unlisted=("nar/0",))
    return rows.select("key", "class", "store_path", "status")


_RUN = ", ".join(
    f"CAST(count(*) FILTER (class = '{c}') AS BIGINT) AS attempted_{c}s, CAST(count(*) FILTER (class = '{c}' AND status = 'present' AND NOT failed) AS BIGINT) AS removed_{c}s,"
    f" CAST(count(*) FILTER (class = '{c}' AND status = 'not_found') AS BIGINT) AS not_found_{c}s, CAST(count(*) FILTER (class = '{c}' AND failed) AS BIGINT) AS errors_{c}s"
    for c in ("nar", "narinfo")
)


@_query(f"""WITH {derived.SQL_GC}, told AS (SELECT *, status = 'present' AND right(store_path, 1) = 'n' AS failed FROM dry)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM part WHERE p_partkey % 2 = 0) AS targets, {_RUN},
    CAST(count(DISTINCT substr(store_path, 12, 32)) AS BIGINT) AS store_paths, false AS dry_run FROM told""")
def gc_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A real run on simulated outcomes: some keys are not there, some are denied, and denials are reported twice."""
    rows = gc_dry_run(spark, sf_dir)
    code = F.when(F.col("status") == "not_found", "NoSuchKey").when(F.right("store_path", F.lit(1)) == "n", "AccessDenied")
    outcomes = rows.select("key", code.alias("code"), F.lit("denied").alias("message"))
    outcomes = outcomes.union(outcomes.where("code = 'AccessDenied'").withColumn("code", F.lit("NoSuchKey")))
    return gc.gc_stats(gc.merge_outcomes(rows, outcomes), derived.gc_targets(spark, sf_dir), dry=False)


@_query(f"WITH {derived.SQL_GC} SELECT key, store_path, status = 'not_found' AS not_found, '' AS error FROM dry")
def gc_removal_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a dry run writes, read back."""
    path = scratch(spark)
    gc.collect_garbage(derived.gc_targets(spark, sf_dir), path, listing=derived.listing(spark, sf_dir))
    return spark.read.schema(schemas.REMOVAL).parquet(path)


# Retention

_KEEP = "('2024-01-01T00-00Z', '2024-01-03T00-00Z')"
_PLAN = f"""{derived.SQL_MANIFESTS}, plan AS (
    SELECT report_id, file_id, file_id NOT IN (SELECT file_id FROM listed WHERE report_id IN {_KEEP}) AS delete_file FROM listed WHERE report_id NOT IN {_KEEP}
)"""


@_query(f"WITH {_PLAN} SELECT * FROM plan")
def retention_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = retention.keep_list(spark, " 2024-01-01T00-00Z, ,2024-01-03T00-00Z,unknown")
    return retention.plan_retention(derived.manifests(spark, sf_dir), keep)


@_query(
    f"WITH {_PLAN} SELECT CAST(count(DISTINCT report_id) AS BIGINT) AS manifests_deleted, CAST(count(file_id) AS BIGINT) AS file_entries,"
    " CAST(count(*) FILTER (delete_file) AS BIGINT) AS files_deleted FROM plan"
)
def retention_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.retention_counts(retention_plan(spark, sf_dir))


# Ingest


@_query(
    "WITH e AS (SELECT *, CAST(ts AS DATE) AS day FROM events) SELECT event_id, strftime(day, '%Y-%m-%d') AS day FROM e"
    " WHERE day NOT IN (SELECT day FROM e WHERE event_id % 1000 = 0)"
)
def new_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived.table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return ingest.new_objects(rows, rows.where("event_id % 1000 = 0")).select("event_id", "day")


@_query(
    "SELECT CAST(count(*) AS BIGINT) AS fetched, CAST(sum(octet_length(encode(CASE WHEN doc_id % 17 = 0 THEN text || 'x' ELSE text END))) AS BIGINT) AS bytes"
    " FROM documents WHERE doc_id % 13 <> 0"
)
def ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.ingest_stats(derived.raw_narinfo(spark, sf_dir))
