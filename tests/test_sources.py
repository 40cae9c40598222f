from __future__ import annotations

import json
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stowage.operators import audit, merge
from stowage.sources import readers
from stowage.streaming import ingest


@pytest.fixture
def report(spark, tmp_path):
    """A report of two listing files, with its manifest."""
    rows = [("b", f"k{n:03}.narinfo" if n % 3 else f"nar/{n}.nar", n, datetime(2024, 1, 1), "0" * 32, "STANDARD") for n in range(40)]
    schema = pa.schema([("bucket", pa.string()), ("key", pa.string()), ("size", pa.int64()), ("last_modified_date", pa.timestamp("ms", tz="UTC")), ("e_tag", pa.string()), ("storage_class", pa.string())])
    files = []
    for name, part in (("one", rows[:25]), ("two", rows[25:])):
        path = tmp_path / "inv/data" / f"{name}.parquet"
        path.parent.mkdir(parents=True, exist_ok=True)
        columns = dict(zip(schema.names, zip(*part)))
        pq.write_table(pa.table(columns, schema=schema), path)
        files.append({"key": f"inv/data/{name}.parquet", "size": path.stat().st_size, "MD5checksum": "x"})
    for day, listed in (("2024-01-01T00-00Z", files), ("2024-01-02T00-00Z", [])):
        folder = tmp_path / "inv" / day
        folder.mkdir()
        doc = {"files": listed, "sourceBucket": "s", "destinationBucket": "d", "version": "1", "creationTimestamp": "1747098000000", "fileFormat": "Parquet", "fileSchema": "message"}
        (folder / "manifest.json").write_text(json.dumps(doc, indent=2))
    return tmp_path


def test_manifests_and_inventory(spark, report):
    m = readers.read_manifests(spark, f"{report}/inv")
    assert sorted(r.report_id for r in m.collect()) == ["2024-01-01T00-00Z", "2024-01-02T00-00Z"]
    assert readers.read_manifests(spark, f"{report}/inv/", ["2024-01-02T00-00Z"]).count() == 1
    assert [(r.report_id, r.rule) for r in readers.manifest_violations(m).collect()] == [("2024-01-02T00-00Z", "no_files")]
    inv = readers.read_inventory(spark, str(report), m, "2024-01-01T00-00Z")
    assert inv.count() == 40 and {r.file_id for r in inv.select("file_id").distinct().collect()} == {"one.parquet", "two.parquet"}
    assert readers.read_inventory(spark, str(report), m, "2024-01-02T00-00Z").count() == 0
    head = readers.manifest_report(m).where("n_files > 0").first()
    assert head.n_files == 2 and head.total_size > 0 and json.loads(head.files_json)[0]["key"].startswith("inv/data/")
    with pytest.raises(ValueError, match=r"two\.parquet"):
        audit.assert_ingested(readers.manifest_files(m), spark.createDataFrame([("one.parquet",)], "file_id string"))


def test_merge_is_sorted_with_nulls_last(spark, report, tmp_path):
    inv = readers.read_inventory(spark, str(report), readers.read_manifests(spark, f"{report}/inv"), "2024-01-01T00-00Z")
    inv = inv.withColumn("key", F.when(F.col("size") == 7, None).otherwise(F.col("key")))
    for order, single in (("key", False), ("key DESC", True), ("storage_class, size desc", True)):
        out = str(tmp_path / f"m{abs(hash(order))}")
        merge.merge_inventory(inv, out, order, single_file=single)
        back = spark.read.parquet(out)
        assert "bucket" not in back.columns and back.count() == 40
        if single:
            got = [r.size if "size" in order else r.key for r in back.collect()]
            assert got[-1] is None if order == "key DESC" else got == sorted(got, reverse=True)
    with pytest.raises(ValueError, match="not a sort column"):
        merge.sort_columns("key; drop")


def test_discovery(spark):
    keys = ["r/2024-02-01T00-00Z/manifest.json", "r/2024-01-01T00-00Z/manifest.json", "r/2024-01-01T00-00Z/x", "r/data/f", "r/T", "q/2023T/x"]
    got = readers.discover_reports(spark.createDataFrame([(k,) for k in keys], "key string"), "r")
    assert [r.report_id for r in got.collect()] == ["2024-01-01T00-00Z", "2024-02-01T00-00Z"]


def test_listing(spark, tmp_path):
    (tmp_path / "s/nar").mkdir(parents=True)
    (tmp_path / "s/a.narinfo").write_text("x")
    (tmp_path / "s/nar/b.nar").write_text("yy")
    assert sorted((r.key, r.size) for r in readers.list_objects(spark, f"{tmp_path}/s").collect()) == [("a.narinfo", 1), ("nar/b.nar", 2)]
    assert [r.key for r in readers.list_objects(spark, f"{tmp_path}/s", recursive=False).collect()] == ["a.narinfo"]
    assert [(r.key, bytes(r.content)) for r in readers.read_raw_narinfos(spark, f"{tmp_path}/s").collect()] == [("a.narinfo", b"x")]


def test_stream_takes_only_what_is_new(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    for k in range(3):
        (src / f"{k}.narinfo").write_text(f"body {k}")
    (src / "other.txt").write_text("no")
    run = lambda: ingest.stream_bodies(spark, str(src), str(tmp_path / "t"), str(tmp_path / "c"))
    assert run() == 3 and run() == 0
    (src / "9.narinfo").write_text("late")
    assert run() == 1
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert rows.count() == 4
    s = ingest.ingest_stats(rows).first()
    assert (s.fetched, s.bytes) == (4, 3 * 6 + 4)


def test_checksum_gate_and_drop(spark):
    rows = [("a.narinfo", b"x", "9dd4e461268c8034f5c8564e155c67a6"), ("b.narinfo", b"y", "9DD4E461268C8034F5C8564E155C67A6"), ("c.narinfo", b"z", "abc-2"), ("d.narinfo", b"z", None)]
    df = spark.createDataFrame([(k, bytearray(c), e) for k, c, e in rows], "key string, content binary, e_tag string")
    good, bad = audit.checksum_gate(df)
    assert [r.key for r in good.collect()] == ["a.narinfo"]
    assert sorted((r.key, r.reason) for r in bad.collect()) == [("b.narinfo", "bad_checksum"), ("c.narinfo", "no_md5"), ("d.narinfo", "no_md5")]
    inv = df.select("key", "e_tag", F.lit(1).cast("bigint").alias("size"), F.lit("f").alias("file_id"))
    status = audit.verify_objects(inv, df.where("key != 'c.narinfo'"))
    assert sorted((r.key[0], r.status) for r in status.collect()) == [("a", "verified"), ("b", "bad_checksum"), ("c", "missing"), ("d", "unverifiable")]
    assert sorted(r.key[0] for r in audit.drop_invalid(df, status).collect()) == ["a", "c", "d"]


def test_documents_and_millis(spark):
    stats = spark.createDataFrame([("f", 0, 1234, 82854982, 0, 0, 0, 0, 0, 0), (None, 1, 1234, 82854982, 7, 1500, 1000000, 0, 0, 3)], "file_id string, is_total int, objects_count long, objects_size long, narinfo_count long, narinfo_size long, verified long, missing long, invalid long, bad_checksum long")
    doc = json.loads(audit.stats_document(stats).first().document)
    assert doc == {"objects": {"size": "83 MB", "count": "1,234"}, "narinfo": {"size": "1.5 kB", "count": "7", "verified": "1,000,000", "bad_checksum": "3"}}
    rows = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 1, 250000),)], "last_modified_date timestamp")
    assert readers.with_millis(rows).first().last_modified_ms == 1704067201250


def test_objects_under_a_folder_with_an_apostrophe(spark, tmp_path):
    (tmp_path / "it's").mkdir()
    (tmp_path / "it's/a.narinfo").write_text("x")
    assert [r.key for r in readers.list_objects(spark, f"{tmp_path}/it's").collect()] == ["a.narinfo"]
    readers.write_raw_narinfos(spark, f"{tmp_path}/it's", f"{tmp_path}/table")
    assert [(r.key, bytes(r.content)) for r in readers.read_raw_table(spark, f"{tmp_path}/table").collect()] == [("a.narinfo", b"x")]


def test_one_ingest_of_a_report(spark, tmp_path):
    md5 = "9dd4e461268c8034f5c8564e155c67a6"  # of x
    inv = spark.createDataFrame([("a.narinfo", md5, "f"), ("b.narinfo", md5, "g"), ("c.narinfo", md5, "h"), ("nar/d.nar", md5, "f")], "key string, e_tag string, file_id string")
    objects = spark.createDataFrame([("a.narinfo", bytearray(b"x")), ("b.narinfo", bytearray(b"y")), ("z.narinfo", bytearray(b"x"))], "key string, content binary")
    raw, bad = str(tmp_path / "raw"), str(tmp_path / "bad")
    objects.limit(0).write.parquet(raw)
    none = spark.createDataFrame([], "file_id string")
    got = ingest.ingest_report(inv, objects, raw, bad, none)
    assert got[:2] == (1, 1) and [r.file_id for r in got.done.collect()] == ["f"]
    assert [r.key for r in spark.read.parquet(raw).collect()] == ["a.narinfo"] and spark.read.parquet(bad).first().reason == "bad_checksum"
    with pytest.raises(ingest.BadBodies):
        ingest.ingest_report(inv, objects, raw, bad, none, strict=True)
    status = audit.verify_objects(inv.withColumn("size", F.lit(1)).withColumn("e_tag", F.lit("0" * 32)), spark.read.parquet(raw))
    assert audit.rewrite_valid(raw, status) == 1 and spark.read.parquet(raw).count() == 0 and spark.read.parquet(f"{raw}-replaced").count() == 1


def test_retention_is_applied(spark, tmp_path):
    from stowage.operators import retention

    plan = spark.createDataFrame([("r1", "a", True), ("r1", "b", False), ("r2", "a", True), ("r3", None, False)], "report_id string, file_id string, delete_file boolean")
    asked = tmp_path / "asked"
    asked.mkdir()

    def delete(keys):
        for k in keys:
            (asked / k.replace("/", "_")).touch()
        return {k: "NoSuchKey" for k in keys if "r2" in k}

    got = {r["class"]: tuple(r)[1:] for r in retention.apply_retention(plan, "reports/", "data/", delete, str(tmp_path / "out")).collect()}
    assert got == {"file": (1, 0, 0), "manifest": (2, 1, 0)}
    assert sorted(p.name for p in asked.iterdir()) == ["data_a", "reports_r1_manifest.json", "reports_r2_manifest.json", "reports_r3_manifest.json"]
