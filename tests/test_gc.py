"""The two end-to-end scenarios: a real deletion and a dry run, 10,000 pairs with half as targets."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stowage.operators import gc

PAIRS = 10_000


@pytest.fixture(scope="module")
def targets(spark):
    k = F.col("id").cast("string")
    rows = spark.range(PAIRS).select(
        "id", F.unhex(F.sha1(k)).alias("hash"), F.concat(F.lit("pkg-"), k).alias("pname"), F.lit("none").alias("compression"),
        F.unhex(F.sha2(k, 256)).alias("file_hash"), F.unhex(F.sha2(k, 256)).alias("nar_hash"),
    )
    return rows.cache()


def file_deleter(folder: str, denied: tuple[str, ...] = ()):
    """Deletes files under a folder, as a stand-in for a store."""

    def delete(keys: list[str]) -> dict[str, str]:
        import os

        codes = {}
        for key in keys:
            path = os.path.join(folder, key.replace("/", "_"))
            if key in denied:
                codes[key] = "AccessDenied"
            elif os.path.exists(path):
                os.remove(path)
            else:
                codes[key] = "NoSuchKey"
        return codes

    return delete


def test_deletion(spark, targets, tmp_path):
    half = targets.where("id % 2 = 0")
    store = tmp_path / "store"
    store.mkdir()
    for r in gc.dedup_keys(gc.expand_targets(targets)).select("key").collect():
        (store / r.key.replace("/", "_")).touch()
    stats = gc.collect_garbage(half, str(tmp_path / "out"), deleter=file_deleter(str(store)))
    r = stats.first()
    assert (r.targets, r.removed_nars, r.removed_narinfos, r.not_found_nars, r.not_found_narinfos) == (5000, 5000, 5000, 0, 0)
    assert r.errors_nars == r.errors_narinfos == 0 and r.store_paths == 5000 and not r.dry_run
    gc.assert_clean(stats)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.columns == ["key", "store_path", "not_found", "error"]
    assert out.count() == 10_000 and out.where("error != '' or not_found").count() == 0
    assert len(list(store.iterdir())) == PAIRS
    again = gc.collect_garbage(half, str(tmp_path / "again"), deleter=file_deleter(str(store))).first()
    assert again.removed_nars == 0 and again.not_found_nars == 5000


def test_dry_run(spark, targets, tmp_path):
    half = targets.where("id % 2 = 0")
    keys = gc.expand_targets(targets)
    narinfos = keys.where("class = 'narinfo'").select("key").where(F.crc32(F.col("key").cast("binary")) % 5 != 0)
    nars = keys.where("class = 'nar'").select("key").where(F.crc32(F.col("key").cast("binary")) % 10 != 0)
    listing = narinfos.union(nars)
    stats = gc.collect_garbage(half, str(tmp_path / "out"), listing=listing)
    r = stats.first()
    gone = gc.expand_targets(half).join(listing, "key", "left_anti")
    assert r.not_found_narinfos == gone.where("class = 'narinfo'").count() > 0
    assert r.not_found_nars == gone.where("class = 'nar'").count() > 0
    old = gc.compatible_stats(stats).first()
    assert (old.removed_nars, old.removed_narinfos, old.removed_errors, old.dry_run) == (5000, 5000, 0, True)
    with pytest.raises(gc.MissingTargets):
        gc.assert_clean(stats)
    assert '"missing_in_s3"' in gc.stats_document(stats).first().document


def test_failures_and_shared_nars(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "name string, nar int").select(
        F.unhex(F.sha1("name")).alias("hash"), F.col("name").alias("pname"), F.lit("bzip2").alias("compression"), F.unhex(F.sha2(F.col("nar").cast("string"), 256)).alias("file_hash")
    )
    keys = gc.dedup_keys(gc.expand_targets(rows))
    assert sorted((r["class"], r.n_targets) for r in keys.collect()) == [("nar", 1), ("nar", 2), ("narinfo", 1), ("narinfo", 1), ("narinfo", 1)]
    denied = keys.where("class = 'narinfo'").select("key").first().key
    stats = gc.collect_garbage(rows, str(tmp_path / "out"), deleter=file_deleter(str(tmp_path), (denied,)))
    assert stats.first().errors_narinfos == 1
    with pytest.raises(gc.RemovalErrors):
        gc.assert_clean(stats)
    outcomes = spark.createDataFrame([(denied, "AccessDenied", "no"), ("stray", "X", "y")], "key string, code string, message string")
    assert [r.key for r in gc.unknown_outcomes(keys, outcomes).collect()] == ["stray"]
    errors = gc.merge_outcomes(keys, outcomes).where("error != ''").collect()
    assert [r.error for r in errors] == ["s3 error: code = AccessDenied, message = no"]


def test_no_targets(spark, targets, tmp_path):
    r = gc.collect_garbage(targets.limit(0), str(tmp_path / "none"), listing=spark.createDataFrame([], "key string")).first()
    assert r.targets == r.attempted_nars == r.store_paths == 0


def test_unknown_outcomes_messages_and_repeats(spark, tmp_path):
    rows = spark.createDataFrame([("a",), ("b",)], "name string").select(
        F.unhex(F.sha1("name")).alias("hash"), F.col("name").alias("pname"), F.lit("none").alias("compression"), F.unhex(F.sha2("name", 256)).alias("file_hash")
    )
    keys = gc.dedup_keys(gc.expand_targets(rows))
    first = keys.orderBy("key").first().key
    said = gc.collect_garbage(rows, str(tmp_path / "m"), deleter=lambda ks: {k: ("SlowDown", "try later") for k in ks if k == first})
    assert said.first().errors_nars + said.first().errors_narinfos == 1
    assert [r.error for r in spark.read.parquet(str(tmp_path / "m")).where("error != ''").collect()] == ["s3 error: code = SlowDown, message = try later"]
    with pytest.raises(gc.UnknownOutcomes, match="stray"):
        gc.collect_garbage(rows, str(tmp_path / "u"), deleter=lambda ks: {"stray": "X"})
    assert spark.read.parquet(str(tmp_path / "u")).count() == 4
    twice = spark.createDataFrame([(first, "NoSuchKey", "z"), (first, "AccessDenied", "no"), (first, None, None)], "key string, code string, message string")
    merged = gc.merge_outcomes(keys, twice)
    assert merged.count() == 4 and [r.error for r in merged.where("error != ''").collect()] == ["s3 error: code = AccessDenied, message = no"]


def test_unlisted_prefixes_are_unknown(spark):
    keys = spark.createDataFrame([("nar/a", "nar", "p", 1), ("nar/b", "nar", "p", 1), ("c.narinfo", "narinfo", "p", 1)], "key string, class string, store_path string, n_targets int")
    got = gc.dry_run(keys, spark.createDataFrame([("nar/a",), (None,)], "key string"), unlisted=("nar/",))
    assert sorted((r.key, r.status) for r in got.collect()) == [("c.narinfo", "not_found"), ("nar/a", "present"), ("nar/b", "unknown")]
