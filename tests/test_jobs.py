"""Jobs that write: replayed stream batches, files written again, running sums, retention with failures, fetching by key."""

from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from stowage.operators import audit, merge, retention
from stowage.operators.running import running_sums
from stowage.streaming import ingest


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def bodies(spark, *rows):
    return spark.createDataFrame([(k, None if c is None else bytearray(c.encode())) for k, c in rows], "key string, content binary")


def inventory(spark, *rows):
    return spark.createDataFrame([(k, e, f, 1) for k, e, f in rows], "key string, e_tag string, file_id string, size long")


def tables(spark, path):
    raw, bad, marks = ingest.checked_tables(spark, path)
    return sorted((r.key, bytes(r.content).decode()) for r in raw.collect()), sorted((r.key, r.reason) for r in bad.collect()), sorted(r.file_id for r in marks.collect())


def test_replayed_batches_change_nothing(spark, tmp_path):
    listed = inventory(spark, ("a.narinfo", md5("A"), "f"), ("a.narinfo", md5("A").upper(), "g"), ("b.narinfo", md5("B"), "g"), ("c.narinfo", "x-2", "h"), ("d.narinfo", md5("D"), "i"), ("d.narinfo", md5("E"), "i"), ("nar/n", "z", "n"))
    path = str(tmp_path / "t")
    first = bodies(spark, ("a.narinfo", "A"), ("a.narinfo", "A"), ("c.narinfo", "C"), ("z.narinfo", "Z"), ("b.narinfo", "not B"), (None, "Q"), ("d.narinfo", "D"))
    for _ in range(2):
        ingest.ingest_batch(first, 0, listed, path)
        assert tables(spark, path) == (
            [("a.narinfo", "A")], [("b.narinfo", "bad_checksum"), ("c.narinfo", "no_md5"), ("d.narinfo", "no_md5"), ("z.narinfo", "not_listed")], ["f", "n"],
        )
    for _ in range(2):
        ingest.ingest_batch(bodies(spark, ("b.narinfo", "B"), ("a.narinfo", "A"), ("b.narinfo", None)), 1, listed, path)
        raw, bad, marks = tables(spark, path)
        assert raw == [("a.narinfo", "A"), ("b.narinfo", "B")] and marks == ["f", "g", "n"] and ("b.narinfo", "bad_checksum") in bad and len(bad) == 5
    ingest.ingest_batch(first, 0, listed, path)  # even an earlier one, after later ones
    assert tables(spark, path)[0] == [("a.narinfo", "A"), ("b.narinfo", "B")] and tables(spark, path)[2] == ["f", "g", "n"]
    ingest.ingest_batch(first.limit(0), 2, listed, path)
    assert tables(spark, path)[0] == raw


def test_stream_is_resumed_by_its_checkpoint(spark, tmp_path):
    listed = inventory(spark, *[(f"{k}.narinfo", md5(str(k)), "f") for k in range(6)])
    source, path = str(tmp_path / "s"), str(tmp_path / "t")
    run = lambda: ingest.stream_checked(spark.readStream.schema("key string, content binary").option("maxFilesPerTrigger", 1).parquet(source), listed, path, str(tmp_path / "c"))
    for ks in ((0, 1), (1, 2), (3,)):
        bodies(spark, *[(f"{k}.narinfo", str(k)) for k in ks]).coalesce(1).write.mode("append").parquet(source)
    run()
    assert [k for k, _ in tables(spark, path)[0]] == [f"{k}.narinfo" for k in range(4)] and tables(spark, path)[2] == []
    run()
    bodies(spark, ("4.narinfo", "4"), ("5.narinfo", "5"), ("0.narinfo", "0")).coalesce(1).write.mode("append").parquet(source)
    run()
    assert tables(spark, path) == ([(f"{k}.narinfo", str(k)) for k in range(6)], [], ["f"])


def test_bodies_are_fetched_once_where_their_keys_are(spark, tmp_path):
    listed = inventory(spark, ("a.narinfo", md5("a.narinfo"), "f"), ("a.narinfo", md5("a.narinfo"), "g"), ("b.narinfo", md5("b"), "g"), ("c.narinfo", md5("c.narinfo"), "h"), ("x.narinfo", md5("x.narinfo"), "h"))
    asked = tmp_path / "asked"
    asked.mkdir()

    def fetch(keys):
        for k in keys:
            with open(asked / k, "a") as f:
                f.write("x")
        return {k: "SlowDown" if k == "c.narinfo" else k.encode() for k in keys if k != "x.narinfo"}

    raw, bad = str(tmp_path / "raw"), str(tmp_path / "bad")
    bodies(spark).write.parquet(raw)
    got = ingest.ingest_report(listed, fetch, raw, bad, spark.createDataFrame([], "file_id string"))
    assert got[:2] == (1, 1) and [r.file_id for r in got.done.collect()] == ["f"]
    assert {p.name: p.stat().st_size for p in asked.iterdir()} == dict.fromkeys(("a.narinfo", "b.narinfo", "c.narinfo", "x.narinfo"), 1)
    stats = {r.file_id: r for r in audit.verify_stats(listed, spark.read.parquet(raw)).collect()}
    assert (stats["f"].verified, stats["g"].verified, stats[None].verified, stats[None].missing) == (1, 1, 2, 3)
    rows = {r.key: r.error for r in ingest.fetch_bodies(listed.select("key", "size").distinct(), fetch).collect()}
    assert rows == {"a.narinfo": None, "b.narinfo": None, "c.narinfo": "SlowDown", "x.narinfo": "NoSuchKey"}


def test_a_body_stored_twice_counts_once(spark):
    listed = inventory(spark, ("a.narinfo", md5("A"), "f"), ("b.narinfo", md5("B"), "f"))
    raw = bodies(spark, ("a.narinfo", "A"), ("a.narinfo", "A"), ("b.narinfo", "B"), ("b.narinfo", "x"))
    assert sorted((r.key, r.status) for r in audit.verify_objects(listed, raw).collect()) == [("a.narinfo", "verified"), ("b.narinfo", "bad_checksum")]


def files(path):
    return {p for p in os.listdir(path) if p.startswith("part-")}


def plans_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_files_with_bad_bodies_are_written_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "raw")
    for k in range(5):
        bodies(spark, *[(f"{k}-{i}.narinfo", f"{k}-{i}") for i in range(20)]).coalesce(1).write.mode("append").parquet(path)
    wrong = {"1-3.narinfo", "3-0.narinfo", "3-19.narinfo"}
    listed = inventory(spark, *[(f"{k}-{i}.narinfo", md5("no" if f"{k}-{i}.narinfo" in wrong else f"{k}-{i}"), f"f{k}") for k in range(5) for i in range(20)])
    before = files(path)
    verified = audit.verify_objects(listed, spark.read.parquet(path))
    stats = audit.with_deleted(audit.verify_stats(listed, spark.read.parquet(path)), verified.where("status = 'bad_checksum'"))
    assert {r.file_id: r.deleted for r in stats.collect()} == {"f0": 0, "f1": 1, "f2": 0, "f3": 2, "f4": 0, None: 3}
    monkeypatch.setattr(audit, "BROADCAST_ROWS", 1)  # each file a group of its own
    assert audit.rewrite_valid(path, verified) == 3
    after = files(path)
    assert len(before & after) == 3 and len(after) == 5 and files(f"{path}-replaced") == before - after
    assert {r.key for r in spark.read.parquet(path).collect()} == {f"{k}-{i}.narinfo" for k in range(5) for i in range(20)} - wrong
    assert audit.rewrite_valid(path, audit.verify_objects(listed, spark.read.parquet(path))) == 0 and files(path) == after
    assert not any(os.path.exists(f"{path}-{x}") for x in ("new", "swap", "found"))


def test_an_interrupted_swap_is_finished(spark, tmp_path):
    path = str(tmp_path / "raw")
    bodies(spark, ("a", "1"), ("b", "2")).coalesce(1).write.parquet(path)
    bodies(spark, ("a", "1")).coalesce(1).write.parquet(f"{path}-new")
    (old,), (new,) = files(path), files(f"{path}-new")
    spark.createDataFrame([("old", f"{path}/{old}"), ("new", f"{path}-new/{new}")], "kind string, file string").coalesce(1).write.json(f"{path}-swap")
    os.mkdir(f"{path}-replaced")
    os.rename(f"{path}/{old}", f"{path}-replaced/{old}")  # as far as it came
    audit.finish_swap(spark, path)
    assert [r.key for r in spark.read.parquet(path).collect()] == ["a"] and not os.path.exists(f"{path}-swap")
    audit.finish_swap(spark, path)


def test_bodies_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "raw")
    bodies(spark, ("a.narinfo", "A")).write.parquet(path)
    raw = spark.read.parquet(path)
    status = plans_of(audit.verify_objects(inventory(spark, ("a.narinfo", md5("A"), "f")), raw))
    for line in status.splitlines():
        assert "Exchange" not in line or "content" not in line
    gone = raw.select("key").distinct()
    plan = plans_of(raw.join(F.broadcast(gone), "key", "left_anti"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_running_sums(spark, ranges):
    rows = [(k * 7919 % 1009, None if k % 11 == 0 else k, -k) for k in range(400)]
    got = running_sums(spark.createDataFrame(rows, "o int, a int, b long").repartition(5), "o", ["a", "b"], ranges).collect()
    a = b = 0
    for want, r in zip(sorted(rows), sorted(got, key=lambda r: r.o), strict=True):
        a, b = a + (want[1] or 0), b + want[2]
        assert (r.o, r.a, r.b, r.a_so_far, r.b_so_far) == (*want, a, b)
    assert running_sums(spark.createDataFrame([], "o int, a int"), "o", ["a"], ranges).collect() == []
    first = running_sums(spark.createDataFrame([(None, 5), (1, 2)], "o int, a int"), "o", ["a"], ranges).collect()
    assert sorted((str(r.o), r.a_so_far) for r in first) == [("1", 7), ("None", 5)]


def test_running_sums_have_no_single_task(spark):
    plan = plans_of(running_sums(spark.range(1000).withColumn("a", F.lit(1)), "id", ["a"], 8))
    assert "SinglePartition" not in plan


def test_manifests_stay_while_a_file_of_theirs_is_left(spark, tmp_path):
    plan = spark.createDataFrame([("r1", "a", True), ("r1", "b", True), ("r2", "b", True), ("r3", "c", True), ("r4", "a", False), ("r5", None, False)], "report_id string, file_id string, delete_file boolean")
    asked = tmp_path / "asked"
    asked.mkdir()

    def delete(keys):
        for k in keys:
            (asked / k.replace("/", "_")).touch()
        return {k: ("AccessDenied", "no") for k in keys if k == "data/a"}

    got = {r["class"]: tuple(r)[1:] for r in retention.apply_retention(plan, "reports/", "data/", delete, str(tmp_path / "out")).collect()}
    assert got == {"file": (2, 0, 1), "manifest": (4, 0, 1)}
    assert {p.name for p in asked.iterdir() if "manifest" in p.name} == {f"reports_r{k}_manifest.json" for k in (2, 3, 4, 5)}
    rows = {r.name: r.error for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows["r1"] == "a file of it could not be deleted" and rows["r2"] == "" and "AccessDenied" in rows["a"]


def test_export_reads_its_bodies_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    rows = bodies(spark, ("a", "System: x\n"), ("b", "FileSize: no\n"), ("c", "FileSize: 5\n")).repartition(2)

    def count(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    stats = merge.export_raw(rows.mapInArrow(count, "key string, content binary"), str(tmp_path / "t")).first()
    assert (stats.processed, stats.exported, stats.failed) == (3, 2, 1)
    assert calls.value == 3
    assert [int(r.file_size) for r in spark.read.parquet(str(tmp_path / "t")).collect()] == [0, 5]


def test_order_is_proven_without_a_sort(spark, tmp_path):
    rows = spark.range(1000).select(F.format_string("%05d", "id").alias("key"), "id").repartition(7)
    merge.merge_inventory(rows.withColumn("bucket", F.lit("b")), str(tmp_path / "m"), rows_a_file=90)
    told = merge.order_breaks(spark, str(tmp_path / "m"))
    assert "Sort [key" not in plans_of(told)
    assert sum(r.rows for r in told.collect()) == 1000 and all(r.follows and not r.breaks for r in told.collect())
    rows.orderBy(F.desc("key")).coalesce(1).write.parquet(str(tmp_path / "down"))
    (r,) = merge.order_breaks(spark, str(tmp_path / "down")).collect()
    assert (r.rows, r.breaks, r.first, r.last) == (1000, 999, "00999", "00000")
    for k, ids in enumerate(((5, 6, 7), (1, 2, 3))):
        spark.createDataFrame([(f"{i}",) for i in ids], "key string").coalesce(1).write.mode("append").parquet(str(tmp_path / "two"))
    assert sorted(r.follows for r in merge.order_breaks(spark, str(tmp_path / "two")).collect()) in ([False, True], [True, True])


def test_look_ups_skip_row_groups(spark, tmp_path):
    k = F.col("id").cast("string")
    rows = spark.range(20_000).select(k.alias("key"), F.unhex(F.sha1(k)).alias("hash"), "id", F.lit(False).alias("dq_missing_store_path"), F.lit(False).alias("dq_invalid_utf8"))

    def scanned(path, n):
        found = merge.look_up(spark, path, [hashlib.sha1(b"77").digest()])
        assert [r.id for r in found.collect()] == [77]
        plan = found._jdf.queryExecution().executedPlan()
        scan = plan.collectLeaves().head()
        return scan.metrics().apply("numOutputRows").value()

    for look_up in (0, 5_000):
        merge.export_narinfos(rows, str(tmp_path / f"t{look_up}"), look_up=look_up, rows_a_file=1000)
    assert scanned(str(tmp_path / "t0"), 0) > 5 * scanned(str(tmp_path / "t5000"), 1)
    with pytest.raises(ValueError):
        merge.look_up(spark, str(tmp_path / "t0"), [])


def test_sketches_of_runs_are_merged(spark):
    from stowage.operators import gc

    run = lambda a, b: spark.range(a, b).select(F.concat(F.lit("/nix/store/"), F.lpad(F.col("id").cast("string"), 32, "0"), F.lit("-x")).alias("store_path"))
    sketches = gc.store_path_sketch(run(0, 40_000)).union(gc.store_path_sketch(run(20_000, 60_000))).union(gc.store_path_sketch(run(0, 0)))
    assert abs(gc.store_paths_of_all(sketches).first().store_paths - 60_000) < 0.05 * 60_000


def test_listing_by_shards(spark, tmp_path):
    from stowage.sources import readers

    for name in ("top", "a/one", "a/b/two", "a/b/c/d/three", "a/b/c/e/four", "x/y/z/five"):
        p = tmp_path / "s" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(name)
    want = sorted((r.key, r.size) for r in readers.list_objects(spark, f"{tmp_path}/s").collect())
    for levels in (0, 1, 2, 5):
        for root in (f"{tmp_path}/s", f"file://{tmp_path}/s/"):
            assert sorted((r.key, r.size) for r in readers.list_by_shards(spark, root, levels=levels, tasks=3).collect()) == want
    assert readers.list_by_shards(spark, f"{tmp_path}/none").collect() == []
    assert all(r.last_modified.year > 2000 for r in readers.list_by_shards(spark, f"{tmp_path}/s").collect())


def test_an_export_reads_its_records_once(spark, tmp_path):
    """A range sort reads its input twice, so what is costly to work out is stored before."""
    from stowage.operators import merge

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def costly(k):
        seen.add(1)
        return k

    rows = spark.range(200).select(F.sha1(F.col("id").cast("string")).alias("key")).select(costly("key").alias("key"), F.lit(True).alias("dq_missing_store_path"), F.lit(False).alias("dq_invalid_utf8"), F.unhex("key").alias("hash"))
    assert merge.export_narinfos(rows, str(tmp_path / "table"), look_up=100) == 200
    assert seen.value == 200


def test_files_that_arrive_are_of_bounded_size(spark, small, tmp_path):
    """More bodies make more files, so no task reads a fixed share of all, and more batches."""
    from stowage.plans import derived, written

    bodies = derived.raw_narinfo(spark, small)
    total, n = sum(len(r.content) for r in bodies.collect()), bodies.count()
    a_batch = written._source(bodies, str(tmp_path / "many"), total // 20, n // 5)
    files = spark.read.parquet(str(tmp_path / "many")).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()
    assert len(files) in (20, 21) and a_batch in (3, 4) and sum(r.n for r in files) == n and max(r.n for r in files) <= n // 20 + 8
    assert written._source(bodies, str(tmp_path / "few")) == 2 and len(list((tmp_path / "few").glob("part-*"))) == 4
