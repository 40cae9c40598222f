from __future__ import annotations

import hashlib
import os
import re

import pytest

from stowage.operators import audit, buckets
from stowage.streaming import ingest

N = 4


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def bodies(spark, *rows):
    return spark.createDataFrame([(k, None if t is None else bytearray(t.encode())) for k, t in rows], buckets.COLUMNS)


def listing(spark, *rows):
    return spark.createDataFrame([(f, k, 1, t) for f, k, t in rows], "file_id string, key string, size bigint, e_tag string")


def shuffles_content(df):
    """Whether a shuffle by key or a broadcast has a scan that reads content below it; one of counts by file is of another kind."""
    lines, inside = df._jdf.queryExecution().executedPlan().toString().splitlines(), []
    for line in lines:
        depth = re.search("[A-Za-z*]", line).start() if re.search("[A-Za-z*]", line) else 0
        inside = [d for d in inside if d < depth]
        if "ReadSchema" in line and "content" in line.split("ReadSchema")[1] and inside:
            return True
        if re.search("Exchange hashpartitioning\\(key|BroadcastExchange ", line):
            inside.append(depth)
    return False


@pytest.fixture
def stored(spark, tmp_path):
    name, path = f"bodies_{tmp_path.name}", str(tmp_path / "raw")
    rows = [(f"{k}.narinfo", str(k)) for k in range(60)]
    buckets.write_bodies(bodies(spark, *rows), name, path, N)
    yield name, path
    spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture
def large(spark):
    """Tables that are too large to be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def names(path):
    return {f for f in os.listdir(path) if f.startswith("part-")}


def test_joins_by_key_leave_bodies_in_place(spark, stored, large):
    listed = listing(spark, *[("f", f"{k}.narinfo", md5("x" if k == 7 else str(k))) for k in range(70)])
    raw = spark.table(stored[0])
    status = audit.verify_objects(listed, raw)
    assert not shuffles_content(status) and shuffles_content(audit.verify_objects(listed, spark.read.parquet(stored[1])))
    assert not shuffles_content(audit.drop_invalid(raw, status)) and not shuffles_content(audit.verify_stats(listed, raw))
    work = ingest.wanted_keys(listed)
    assert not shuffles_content(work.join(raw.dropDuplicates(["key"]), "key"))
    told = {r.key: r.status for r in status.collect()}
    assert told["7.narinfo"] == "bad_checksum" and told["65.narinfo"] == "missing" and sum(s == "verified" for s in told.values()) == 59


def test_a_new_session_declares_the_layout(spark, stored, large):
    name, path = stored
    spark.sql(f"DROP TABLE {name}")
    raw = buckets.declare(spark, name, path, N)
    buckets.append_bodies(bodies(spark, ("new.narinfo", "n"), (None, "n"), ("null", None)), name, path, N)
    assert spark.table(name).count() == 63
    listed = listing(spark, ("f", "new.narinfo", md5("n")), ("f", "3.narinfo", md5("3")), ("f", None, md5("n")))
    status = audit.verify_objects(listed, spark.table(name))
    assert not shuffles_content(status)
    assert sorted((r.key, r.status) for r in status.collect()) == [("3.narinfo", "verified"), ("new.narinfo", "verified")]
    assert raw.columns == ["key", "content"]


@pytest.mark.parametrize("most", [0, 10])
def test_only_files_with_bad_bodies_are_written_again(spark, stored, large, monkeypatch, most):
    monkeypatch.setattr(buckets, "BROADCAST_ROWS", most)
    name, path = stored
    before = names(path)
    where = {r.key: r.f.rsplit("/", 1)[1] for r in spark.table(name).selectExpr("key", "_metadata.file_path f").collect()}
    first = where["0.narinfo"]
    wrong = [k for k, f in where.items() if f == first][:2]
    listed = listing(spark, *[("f", k, md5("x" if k in wrong else k.removesuffix(".narinfo"))) for k in where])
    assert buckets.rewrite_buckets(name, path, N, audit.verify_objects(listed, spark.table(name))) == 2
    assert before - names(path) == {first} and names(f"{path}-replaced") == {first}
    assert {r.key for r in spark.table(name).collect()} == set(where) - set(wrong)
    status = audit.verify_objects(listed, spark.table(name))
    assert not shuffles_content(status) and sorted(r.key for r in status.where("status = 'missing'").collect()) == sorted(wrong)
    assert buckets.rewrite_buckets(name, path, N, status) == 0
    assert not any(os.path.exists(f"{path}-{x}") for x in ("new", "swap", "found"))


def test_all_bodies_bad_and_an_empty_table(spark, stored):
    name, path = stored
    listed = listing(spark, *[("f", f"{k}.narinfo", md5("x")) for k in range(60)])
    assert buckets.rewrite_buckets(name, path, N, audit.verify_objects(listed, spark.table(name))) == 60
    assert spark.table(name).count() == 0
    empty = buckets.write_bodies(bodies(spark), f"{name}_empty", f"{path}-none", N)
    assert audit.verify_objects(listed, empty).where("status = 'missing'").count() == 60
    spark.sql(f"DROP TABLE {name}_empty")
