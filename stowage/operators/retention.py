"""Retention of reports: which manifests and listing files go, and how many."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stowage.sources.readers import manifest_files

from .gc import Deleter, delete_keys, merge_outcomes


def keep_list(spark: SparkSession, text: str | None) -> DataFrame:
    """(report_id) of a comma-separated list, trimmed, without empty parts; none left is an error."""
    names = [p.strip() for p in (text or "").split(",") if p.strip()]
    if not names:
        raise ValueError("name at least one report to keep")
    return spark.createDataFrame([(n,) for n in dict.fromkeys(names)], "report_id string")


def plan_retention(manifests: DataFrame, keep: DataFrame, protect_shared: bool = True) -> DataFrame:
    """(report_id, file_id, delete_file): a row for each file entry of the reports that go; reports without files have one with null file_id.

    Ids of keep(report_id) that are unknown do nothing. A file that a kept report lists as well is not deleted, unless
    protect_shared is False. An empty keep list removes everything.
    """
    names = keep.select("report_id").distinct()
    go = manifests.join(names, "report_id", "left_anti").select("report_id", "files")
    entries = go.select("report_id", F.explode_outer("files").alias("f")).select("report_id", F.element_at(F.split("f.key", "/"), -1).alias("file_id"))
    if not protect_shared:
        return entries.withColumn("delete_file", F.col("file_id").isNotNull())
    kept = manifest_files(manifests.join(names, "report_id", "left_semi")).select("file_id").distinct().withColumn("kept", F.lit(True))
    return entries.join(kept, "file_id", "left").select("report_id", "file_id", (F.col("file_id").isNotNull() & F.col("kept").isNull()).alias("delete_file"))


def retention_counts(plan: DataFrame) -> DataFrame:
    """One row: manifests deleted, file entries listed by them, and file entries deleted."""
    return plan.agg(
        F.count_distinct("report_id").alias("manifests_deleted"), F.count("file_id").alias("file_entries"), F.count_if("delete_file").alias("files_deleted")
    )


def retention_keys(plan: DataFrame, reports: str, data: str) -> DataFrame:
    """(key, class, store_path): the objects that a plan deletes, each once: listing files under `data`, manifests under `reports`."""
    manifests = plan.select(F.concat(F.lit(reports), "report_id", F.lit("/manifest.json")).alias("key"), F.lit("manifest").alias("class"), F.col("report_id").alias("store_path"))
    files = plan.where("delete_file").select(F.concat(F.lit(data), "file_id").alias("key"), F.lit("file").alias("class"), F.col("file_id").alias("store_path"))
    return manifests.union(files).distinct()


def apply_retention(plan: DataFrame, reports: str, data: str, deleter: Deleter, path: str) -> DataFrame:
    """Delete what a plan says and write (key, class, name, not_found, error) to `path`; returns counts by class of what was removed, absent and failed.

    Files go before manifests, and a manifest of which a file could not be deleted is left alone, with an error that says so: what is left can be
    found, and deleted by a later run, by the manifests that are left.
    """
    spark, base = plan.sparkSession, path.rstrip("/")
    plan.write.mode("overwrite").parquet(f"{base}-plan")
    plan = spark.read.schema(plan.schema).parquet(f"{base}-plan")
    retention_keys(plan, reports, data).write.mode("overwrite").parquet(f"{base}-keys")
    keys = spark.read.parquet(f"{base}-keys")

    def carried_out(some: DataFrame, kind: str) -> DataFrame:
        codes = f"{base}-codes-{kind}"
        delete_keys(some, deleter).write.mode("overwrite").parquet(codes)
        return merge_outcomes(some, spark.read.parquet(codes)).withColumnRenamed("store_path", "name")

    carried_out(keys.where("class = 'file'"), "file").write.mode("overwrite").parquet(path)
    failed = spark.read.parquet(path).where("error != ''").select(F.col("name").alias("file_id"))
    held = plan.where("delete_file").join(failed, "file_id", "left_semi").select(F.col("report_id").alias("store_path")).distinct()
    held.write.mode("overwrite").parquet(f"{base}-held")
    held, manifests = spark.read.parquet(f"{base}-held"), keys.where("class = 'manifest'")
    carried_out(manifests.join(held, "store_path", "left_anti"), "manifest").write.mode("append").parquet(path)
    left = manifests.join(held, "store_path", "left_semi").select("key", "class", F.col("store_path").alias("name"), F.lit(False).alias("not_found"), F.lit("a file of it could not be deleted").alias("error"))
    left.write.mode("append").parquet(path)
    failed, gone = F.col("error") != "", F.col("not_found")
    return spark.read.parquet(path).groupBy("class").agg(F.count_if(~failed & ~gone).alias("removed"), F.count_if(gone).alias("not_found"), F.count_if(failed).alias("errors"))
