"""Object-store tables derived from the given tables, in Spark and as SQL for the oracles.

The given tables have no package store, so hashes are SHA digests of ids, checksums are MD5 of texts, and so on; both sides use
functions that either engine has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stowage.functions.hashes import narinfo_key, render_locations
from stowage.session import scratch
from stowage.sources.readers import read_raw_table

REPORTS = ("2024-01-01T00-00Z", "2024-01-02T00-00Z", "2024-01-03T00-00Z", "2024-01-04T00-00Z")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(name: str):
    return F.col(name).cast("string")


def narinfo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A narinfo record for each part; three parts share a NAR."""
    size = F.col("p_size")
    file_size = size.cast("bigint") * 1000 + F.col("p_partkey") % 1000
    parts, cores = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), spark.sparkContext.defaultParallelism
    if len(parts.inputFiles()) < cores:  # a few files would leave most cores idle while hashes are worked out
        parts = parts.repartition(cores)
    return parts.select(
        "p_partkey",
        F.unhex(F.sha1(_id("p_partkey"))).alias("hash"),
        F.replace("p_name", F.lit(" "), F.lit("-")).alias("pname"),
        F.when(size % 4 == 0, "xz").when(size % 4 == 1, "zstd").when(size % 4 == 2, "none").otherwise("bzip2").alias("compression"),
        F.unhex(F.sha2(F.expr("p_partkey div 3").cast("string"), 256)).alias("file_hash"),
        F.unhex(F.sha2(F.concat(F.lit("nar"), _id("p_partkey")), 256)).alias("nar_hash"),
        file_size.alias("file_size"),
        (file_size * 3).alias("nar_size"),
    )


def gc_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return narinfo(spark, sf_dir).where("p_partkey % 2 = 0")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key): what the store still holds; a fifth of the narinfos and a tenth of the NARs are gone."""
    rows = render_locations(narinfo(spark, sf_dir))
    narinfos = rows.where("p_partkey % 5 != 0").select(F.col("narinfo_key").alias("key"))
    nars = rows.where("(p_partkey div 3) % 10 != 0").select(F.col("nar_key").alias("key"))
    return narinfos.union(nars).distinct()


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows: documents as narinfos, pages as NARs."""
    docs = table(spark, sf_dir, "documents").select(
        F.lit("store").alias("bucket"),
        F.unhex(F.sha1(_id("doc_id"))).alias("hash"),
        F.octet_length("text").cast("bigint").alias("size"),
        (F.lit(1_700_000_000) + F.col("doc_id") % 86400).alias("modified"),
        F.when(F.col("doc_id") % 101 == 0, F.concat(F.md5("text"), F.lit("-2"))).otherwise(F.md5("text")).alias("e_tag"),
        F.lit("STANDARD").alias("storage_class"),
        F.col("source").alias("file_id"),
    )
    docs = docs.select("bucket", narinfo_key("hash").alias("key"), "size", "modified", "e_tag", "storage_class", "file_id")
    pages = table(spark, sf_dir, "pages").select(
        F.lit("store").alias("bucket"),
        F.concat(F.lit("nar/"), F.sha2(_id("page_id"), 256), F.lit(".nar.xz")).alias("key"),
        F.octet_length("html").cast("bigint").alias("size"),
        (F.lit(1_700_000_000) + F.col("page_id") % 86400).alias("modified"),
        F.md5("html").alias("e_tag"),
        F.lit("STANDARD").alias("storage_class"),
        F.concat(F.lit("page"), (F.col("page_id") % 8).cast("string")).alias("file_id"),
    )
    return docs.unionByName(pages)


def raw_narinfo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, content): stored bodies; some are altered and some were never fetched."""
    docs = table(spark, sf_dir, "documents").where("doc_id % 13 != 0")
    altered = F.when(F.col("doc_id") % 17 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    rows = docs.select(F.unhex(F.sha1(_id("doc_id"))).alias("hash"), F.encode(altered, "UTF-8").alias("content"))
    return rows.select(narinfo_key("hash").alias("key"), "content")


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report for each day: one file for each of the inventory's files, two thirds of them on any day."""
    files = inventory(spark, sf_dir).groupBy("file_id").agg(F.sum("size").cast("bigint").alias("size"))
    days = spark.createDataFrame([(k, r) for k, r in enumerate(REPORTS)], "day int, report_id string")
    listed = files.crossJoin(F.broadcast(days)).where("(ascii(right(file_id, 1)) + day) % 3 != 0")
    entry = F.struct(
        F.concat(F.lit("data/"), "file_id").alias("key"),
        F.when((F.col("day") == 3) & (F.col("file_id") == "page1"), 0).otherwise(F.col("size")).cast("bigint").alias("size"),
        F.md5("file_id").alias("MD5checksum"),
    )
    rows = listed.groupBy("report_id").agg(F.array_sort(F.collect_list(entry)).alias("files"))
    fmt = F.when(F.col("report_id") == REPORTS[2], "").otherwise("Parquet")
    return rows.select("report_id", "files", F.lit("store").alias("sourceBucket"), F.lit("reports").alias("destinationBucket"),
        F.lit("2016-11-30").alias("version"), F.lit("1704067200000").alias("creationTimestamp"), fmt.alias("fileFormat"))


_STORED: dict[tuple[str, str], str] = {}


def narinfo_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """narinfo_text() as a stored table, as bodies are: written once a session and folder into the shared scratch folder."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _STORED:
        path = scratch(spark)
        narinfo_text(spark, sf_dir).write.parquet(path)
        _STORED[key] = path
    return read_raw_table(spark, _STORED[key])


def narinfo_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, content): narinfo bodies in text, with the parts of its orders as a part's references and with faults by key.

    Orders are dealt to the parts in turn. Every fourth part lists its references once each, by name.
    """
    from stowage.functions.hashes import nixbase32, render_arrays

    parts = narinfo(spark, sf_dir)
    many = table(spark, sf_dir, "part").agg(F.max("p_partkey").alias("many"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").crossJoin(F.broadcast(many))  # one row
    refs = lines.select((F.col("l_orderkey") % F.col("many") + 1).alias("of"), F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("s"))
    refs = refs.groupBy("of").agg(F.collect_list("s").alias("s"))
    rows = parts.join(refs, parts["p_partkey"] == F.col("of"), "left")  # numbers are shuffled, names are made after
    rows = rows.withColumn("r", render_arrays(F.transform("s.l_partkey", lambda k: F.unhex(F.sha1(k.cast("string"))))))
    rows = rows.withColumn("names", F.sort_array(F.arrays_zip(F.col("s.l_orderkey").alias("o"), F.col("s.l_linenumber").alias("n"), "r"))["r"])
    names = F.when(F.col("of") % 4 == 0, F.sort_array(F.array_distinct("names"))).otherwise(F.col("names"))
    rows = rows.withColumn("refs", F.concat(F.array_join(names, "-p "), F.lit("-p")))
    k = F.col("p_partkey")
    end = F.when(k % 3 == 0, "\r\n").otherwise("\n")
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, end)
    size = F.when(k % 19 == 0, F.lit(" 5")).otherwise(F.col("file_size").cast("string"))
    path = F.when(k % 23 == 0, F.concat(F.lit("/nix/store/e"), F.substring("b32", 2, 31), F.lit("-"), "pname")).otherwise(F.concat(F.lit("/nix/store/"), "b32", F.lit("-"), "pname"))
    file_hash = F.when(k % 5 == 0, F.lower(F.hex("file_hash"))).otherwise(F.col("file_b32"))
    sig = F.concat(F.lit("cache-1:"), F.regexp_replace(F.base64(F.encode(F.concat(F.lower(F.hex("nar_hash"))), "UTF-8")), "[\r\n]", ""))
    rows = rows.withColumns({"b32": nixbase32("hash", 20), "file_b32": nixbase32("file_hash", 32), "nar_b32": nixbase32("nar_hash", 32)})
    text = F.concat(
        F.when(k % 29 == 0, "").otherwise(line("StorePath", path)),
        line("URL", F.lit("ignored")),
        F.when(k % 7 == 0, "").otherwise(line("Compression", F.col("compression"))),
        line("FileHash", F.concat(F.lit("sha256:"), file_hash)),
        line("FileSize", F.lit("1")),
        line("FileSize", size),
        line("NarHash", F.concat(F.when(k % 31 == 0, "md5:").otherwise("sha256:"), "nar_b32")),
        line("NarSize", F.col("nar_size").cast("string")),
        F.when(F.col("of").isNull(), F.lit("References:\n")).otherwise(line("References", F.col("refs"))),
        line("Deriver", F.when(k % 2 == 0, "unknown-deriver").otherwise(F.concat("b32", F.lit("-"), "pname", F.lit(".drv")))),
        line("Sig", sig),
        F.when(k % 11 == 0, line("CA", F.concat(F.lit("fixed:r:sha256:"), "nar_b32"))).otherwise(""),
        F.lit("System: x86_64-linux"),
    )
    return rows.select(F.concat("b32", F.lit(".narinfo")).alias("key"), F.encode(text, "UTF-8").alias("content"))


# The same in SQL.


def sql_b32(hexa: str, size: int) -> str:
    """SQL for the base-32 text of a hexadecimal string of `size` bytes."""
    # The number that the bytes spell, last byte first, as a string of bits, cut in fives from its end.
    bits = f"array_to_string(list_transform(range({size - 1}, -1, -1), lambda i: lpad(bin(CAST('0x' || substr({hexa}, 2 * i + 1, 2) AS INTEGER)), 8, '0')), '')"
    fives = f"regexp_extract_all(lpad({bits}, {5 * ((8 * size + 4) // 5)}, '0'), '[01]{{5}}')"
    return f"array_to_string(list_transform({fives}, lambda b: substr('0123456789abcdfghijklmnpqrsvwxyz', 1 + CAST('0b' || b AS INTEGER), 1)), '')"


SQL_NARINFO = """narinfo AS (
    SELECT p_partkey, sha1(CAST(p_partkey AS VARCHAR)) AS hash, replace(p_name, ' ', '-') AS pname,
        CASE p_size % 4 WHEN 0 THEN 'xz' WHEN 1 THEN 'zstd' WHEN 2 THEN 'none' ELSE 'bzip2' END AS compression,
        sha256(CAST(p_partkey // 3 AS VARCHAR)) AS file_hash, sha256('nar' || CAST(p_partkey AS VARCHAR)) AS nar_hash,
        CAST(p_size AS BIGINT) * 1000 + p_partkey % 1000 AS file_size, (CAST(p_size AS BIGINT) * 1000 + p_partkey % 1000) * 3 AS nar_size
    FROM part
)"""

_SUFFIX = "CASE WHEN compression = 'none' THEN '' WHEN compression = 'bzip2' THEN '.bz2' ELSE '.' || compression END"

SQL_LOCATED = f"""{SQL_NARINFO}, located AS (
    SELECT *, '/nix/store/' || b32 || '-' || pname AS store_path, b32 || '.narinfo' AS narinfo_key,
        'nar/' || file_b32 || '.nar' || {_SUFFIX} AS nar_key
    FROM (SELECT *, {sql_b32("hash", 20)} AS b32, {sql_b32("file_hash", 32)} AS file_b32, {sql_b32("nar_hash", 32)} AS nar_b32 FROM narinfo)
)"""

SQL_GC = f"""{SQL_LOCATED}, keys AS (
    SELECT key, class, min(store_path) AS store_path, count(*) AS n_targets FROM (
        SELECT narinfo_key AS key, 'narinfo' AS class, store_path FROM located WHERE p_partkey % 2 = 0
        UNION ALL SELECT nar_key, 'nar', store_path FROM located WHERE p_partkey % 2 = 0
    ) GROUP BY key, class
), listing AS (
    SELECT narinfo_key AS key FROM located WHERE p_partkey % 5 <> 0
    UNION SELECT nar_key FROM located WHERE (p_partkey // 3) % 10 <> 0
), dry AS (
    SELECT k.*, CASE WHEN l.key IS NULL THEN 'not_found' ELSE 'present' END AS status FROM keys k LEFT JOIN listing l ON k.key = l.key
)"""

SQL_INVENTORY = f"""docs AS (
    SELECT *, sha1(CAST(doc_id AS VARCHAR)) AS h FROM documents
), inventory AS (
    SELECT doc_id, 'store' AS bucket, {sql_b32("h", 20)} || '.narinfo' AS key, CAST(octet_length(encode(text)) AS BIGINT) AS size,
        1700000000 + doc_id % 86400 AS modified, CASE WHEN doc_id % 101 = 0 THEN md5(text) || '-2' ELSE md5(text) END AS e_tag,
        'STANDARD' AS storage_class, source AS file_id
    FROM docs
    UNION ALL
    SELECT NULL, 'store', 'nar/' || sha256(CAST(page_id AS VARCHAR)) || '.nar.xz', CAST(octet_length(encode(html)) AS BIGINT),
        1700000000 + page_id % 86400, md5(html), 'STANDARD', 'page' || CAST(page_id % 8 AS VARCHAR)
    FROM pages
), verified AS (
    SELECT *, CASE WHEN doc_id % 13 = 0 THEN 'missing' WHEN doc_id % 101 = 0 THEN 'unverifiable'
        WHEN doc_id % 17 = 0 THEN 'bad_checksum' ELSE 'verified' END AS status
    FROM inventory WHERE doc_id IS NOT NULL
)"""

SQL_MANIFESTS = f"""{SQL_INVENTORY}, days(day, report_id) AS (
    VALUES {", ".join(f"({k}, '{r}')" for k, r in enumerate(REPORTS))}
), files AS (
    SELECT file_id, CAST(sum(size) AS BIGINT) AS total FROM inventory GROUP BY file_id
), listed AS (
    SELECT d.report_id, f.file_id, 'data/' || f.file_id AS key, CASE WHEN d.day = 3 AND f.file_id = 'page1' THEN 0 ELSE f.total END AS size,
        md5(f.file_id) AS MD5checksum
    FROM files f CROSS JOIN days d WHERE (ascii(right(f.file_id, 1)) + d.day) % 3 <> 0
)"""
