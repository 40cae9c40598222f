"""Garbage collection: targets to keys, dry run or deletion, outcomes and statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stowage.functions.hashes import render_locations

from .narinfo import classify_keys

#: Deletes a list of keys and returns an error code, or a code and a message, by key for those that failed; NoSuchKey means that it was not there.
Deleter = Callable[[list[str]], dict[str, str | tuple[str, str]]]
DELETE_BATCH = 1000


def expand_targets(targets: DataFrame, legacy_suffix: bool = False) -> DataFrame:
    """(key, class, store_path): the narinfo and the nar key of each target(hash, pname, file_hash, compression)."""
    rows = render_locations(targets, legacy_suffix)
    pair = F.array(
        F.struct(F.col("narinfo_key").alias("key"), F.lit("narinfo").alias("class"), "store_path"),
        F.struct(F.col("nar_key").alias("key"), F.lit("nar").alias("class"), "store_path"),
    )
    return rows.select(F.explode(pair).alias("x")).select("x.*")


def dedup_keys(keys: DataFrame) -> DataFrame:
    """(key, class, store_path, n_targets): each key once, with the smallest store path, whatever the partitioning."""
    # The class follows from the key, so grouping by the key alone serves a join by key as well.
    rows = keys.groupBy("key").agg(F.min("class").alias("class"), F.min("store_path").alias("store_path"), F.count("*").alias("n_targets"))
    return rows.select("key", "class", "store_path", "n_targets")


def dry_run(keys: DataFrame, listing: DataFrame, unlisted: tuple[str, ...] = ()) -> DataFrame:
    """keys with status present, not_found or unknown by a listing(key) of the store; a null listing key matches nothing.

    `unlisted`: prefixes of which the listing failed; of keys under them that are not in the listing nothing is known.
    """
    there = listing.select("key").where("key is not null").distinct().withColumn("there", F.lit(True))
    rows = keys.join(there, "key", "left")
    unsure = F.lit(False)
    for prefix in unlisted:
        unsure = unsure | F.startswith("key", F.lit(prefix))
    return rows.withColumn("status", F.when(F.col("there"), "present").when(unsure, "unknown").otherwise("not_found")).drop("there")


def delete_keys(keys: DataFrame, deleter: Deleter) -> DataFrame:
    """(key, code, message) for every key: null if it was deleted, else the store's error. What the store says of other keys follows.

    Side effects: write the result before any other use, and switch speculation off for the job. A repeated task finds NoSuchKey, which is no error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            names = b["key"].tolist()
            for s in range(0, len(names), DELETE_BATCH):
                some = names[s : s + DELETE_BATCH]
                said = {k: v if isinstance(v, tuple) else (v, None) for k, v in deleter(some).items()}
                told = some + sorted(set(said).difference(some))
                codes, messages = zip(*[said.get(k, (None, None)) for k in told])
                yield pd.DataFrame({"key": told, "code": codes, "message": messages}, dtype=object)

    return keys.select("key").mapInPandas(run, "key string, code string, message string")


def merge_outcomes(keys: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Removal records (key, class, store_path, not_found, error) of keys with outcomes(key, code, message) of those that failed.

    Of several outcomes of one key an error counts before NoSuchKey, then the last by code and message.
    """
    failed = outcomes.where("code is not null")
    code, message = F.col("code"), F.coalesce("message", F.lit("")) if "message" in outcomes.columns else F.lit("")
    failed = failed.groupBy("key").agg(F.max(F.struct((code != "NoSuchKey").alias("wrong"), code, message.alias("message"))).alias("o"))
    failed = failed.select("key", "o.code", "o.message")
    rows = keys.join(failed, "key", "left")
    error = F.when(code.isNull() | (code == "NoSuchKey"), "").otherwise(F.concat(F.lit("s3 error: code = "), code, F.lit(", message = "), F.col("message")))
    return rows.select("key", "class", "store_path", F.coalesce(code == "NoSuchKey", F.lit(False)).alias("not_found"), error.alias("error"))


def unknown_outcomes(keys: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Outcomes for keys that were not asked for; there should be none."""
    return outcomes.join(keys.select("key"), "key", "left_anti")


def gc_stats(records: DataFrame, targets: DataFrame, dry: bool) -> DataFrame:
    """One row: targets, and by class keys attempted, removed, not found and failed; distinct store paths touched.

    Nothing is removed in a dry run. records(key, class, store_path, not_found, error).
    """
    nar, narinfo = F.col("class") == "nar", F.col("class") == "narinfo"
    failed, gone = F.col("error") != "", F.col("not_found")
    done = ~gone & ~failed & ~F.lit(dry)
    parts = []
    for name, kind in (("nars", nar), ("narinfos", narinfo)):
        parts += [
            F.count_if(kind).alias(f"attempted_{name}"),
            F.count_if(kind & done).alias(f"removed_{name}"),
            F.count_if(kind & gone).alias(f"not_found_{name}"),
            F.count_if(kind & failed).alias(f"errors_{name}"),
        ]
    paths = F.count_distinct(F.substring("store_path", 12, 32)).alias("store_paths")
    total = targets.agg(F.count("*").alias("targets"))
    return total.crossJoin(records.agg(*parts, paths)).withColumn("dry_run", F.lit(dry))


#: Sketches have 2^SKETCH_BITS registers: an estimate is within 1.6 % in two of three cases.
SKETCH_BITS = 12


def store_path_sketch(records: DataFrame) -> DataFrame:
    """(sketch): the distinct store paths of one run's records in a few kB, to be kept with the run and merged with those of others."""
    return records.agg(F.hll_sketch_agg(F.substring("store_path", 12, 32), SKETCH_BITS).alias("sketch"))


def store_paths_of_all(sketches: DataFrame) -> DataFrame:
    """(store_paths): an estimate of the distinct store paths of all runs whose sketches(sketch) are given, without their records."""
    return sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("store_paths"))


def compatible_stats(stats: DataFrame) -> DataFrame:
    """The same numbers as the older tool gave them: removed counts every outcome, errors are never counted."""
    return stats.select(
        "dry_run", F.col("targets").alias("targets_narinfos"), F.col("attempted_nars").alias("removed_nars"), F.col("attempted_narinfos").alias("removed_narinfos"),
        F.lit(0).cast("bigint").alias("removed_errors"), F.col("not_found_nars").alias("missing_nars"), F.col("not_found_narinfos").alias("missing_narinfos"),
    )


def stats_document(stats: DataFrame, compatible: bool = False) -> DataFrame:
    """(document): statistics as indented JSON: what was removed and what failed, or, if `compatible`, the older tool's numbers."""
    s = compatible_stats(stats)
    if not compatible:
        s = stats.select(
            "dry_run", F.col("targets").alias("targets_narinfos"), F.col("removed_nars"), F.col("removed_narinfos"), (F.col("errors_nars") + F.col("errors_narinfos")).alias("removed_errors"),
            F.col("not_found_nars").alias("missing_nars"), F.col("not_found_narinfos").alias("missing_narinfos"),
        )
    tree = F.struct(
        "dry_run",
        F.struct(F.col("targets_narinfos").alias("nar_infos")).alias("targets"),
        F.struct(F.col("removed_nars").alias("nars"), F.col("removed_narinfos").alias("nar_infos"), F.col("removed_errors").alias("errors")).alias("removed"),
        F.struct(F.col("missing_nars").alias("nars"), F.col("missing_narinfos").alias("nar_infos")).alias("missing_in_s3"),
    )
    return s.select(F.to_json(tree, {"pretty": "true"}).alias("document"))


class MissingTargets(Exception):
    pass


class RemovalErrors(Exception):
    pass


class UnknownOutcomes(Exception):
    pass


def assert_clean(stats: DataFrame) -> None:
    """Raise if keys failed, else if targets were missing; call it after the outputs are written."""
    r = stats.first()
    if r.errors_nars + r.errors_narinfos:
        raise RemovalErrors(f"{r.errors_nars + r.errors_narinfos} keys could not be removed")
    if r.not_found_nars + r.not_found_narinfos:
        raise MissingTargets("missing store paths during GC")


#: The error of a key of which a dry run knows nothing.
NOT_LISTED = "its prefix could not be listed"


def collect_garbage(targets: DataFrame, path: str, listing: DataFrame | None = None, deleter: Deleter | None = None, legacy_suffix: bool = False, unlisted: tuple[str, ...] = ()) -> DataFrame:
    """Run a collection and return its statistics: a dry run against `listing`, or a deletion by `deleter`.

    In a dry run, keys under the prefixes `unlisted` that are not in the listing are neither present nor absent: their row has an error.

    The outcome rows are written to `path` (zstd Parquet, one row for each key) before anything reads them, so that keys are
    deleted once; statistics come from the written rows. Reports of the store on keys that were not asked for raise UnknownOutcomes
    after the rows are written.
    """
    if (listing is None) == (deleter is None):
        raise ValueError("give either a listing, for a dry run, or a deleter")
    keys = dedup_keys(expand_targets(targets, legacy_suffix))
    if deleter is None:
        outcomes = dry_run(keys, listing, unlisted)
        error = F.when(F.col("status") == "unknown", NOT_LISTED).otherwise("")
        records = outcomes.select("key", "class", "store_path", (F.col("status") == "not_found").alias("not_found"), error.alias("error"))
    else:
        spark = targets.sparkSession
        names = f"{path.rstrip('/')}-keys"
        keys.write.mode("overwrite").parquet(names)
        keys = spark.read.parquet(names)
        codes = f"{path.rstrip('/')}-codes"
        delete_keys(keys, deleter).write.mode("overwrite").parquet(codes)
        outcomes = spark.read.parquet(codes)
        records = merge_outcomes(keys, outcomes)
    records.drop("class").write.mode("overwrite").option("compression", "zstd").parquet(path)
    if deleter is not None and (stray := unknown_outcomes(keys, outcomes).select("key").limit(5).collect()):
        raise UnknownOutcomes(f"the store reported on keys that were not asked for: {', '.join(r.key for r in stray)}")
    return gc_stats(classify_keys(targets.sparkSession.read.parquet(path)), targets, deleter is None)
