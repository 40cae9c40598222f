from __future__ import annotations

import pytest

from stowage.operators import retention


def manifests(spark, **reports):
    rows = [(f"2024-01-{day[1:]}T00-00Z", [(f"some/path/{f}", 100, "abc123") for f in files]) for day, files in reports.items()]
    return spark.createDataFrame(rows, "report_id string, files array<struct<key: string, size: bigint, MD5checksum: string>>")


def keep(spark, *days):
    return spark.createDataFrame([(f"2024-01-{d}T00-00Z",) for d in days], "report_id string")


def counts(spark, m, k, **options):
    r = retention.retention_counts(retention.plan_retention(m, k, **options)).first()
    return r.manifests_deleted, r.files_deleted


CASES = {
    "partial": (dict(d01=["file1", "file2"], d02=["file3", "file4"], d03=["file5"]), ["01", "03"], (1, 2)),
    "all kept": (dict(d01=["file1"], d02=["file2"]), ["01", "02"], (0, 0)),
    "empty keep list": (dict(d01=["file1"]), [], (1, 1)),
    "empty store": ({}, ["01"], (0, 0)),
    "unknown id": (dict(d01=["file1"]), ["01", "77"], (0, 0)),
}


@pytest.mark.parametrize("case", CASES)
def test_cases(spark, case):
    reports, days, want = CASES[case]
    assert counts(spark, manifests(spark, **reports), keep(spark, *days)) == want


def test_shared_files_are_protected(spark):
    m = manifests(spark, d01=["shared", "own"], d02=["shared"])
    assert counts(spark, m, keep(spark, "02")) == (1, 1)
    assert counts(spark, m, keep(spark, "02"), protect_shared=False) == (1, 2)


def test_report_without_files_goes_too(spark):
    assert counts(spark, manifests(spark, d01=[], d02=["x"]), keep(spark, "02")) == (1, 0)


def test_keep_list(spark):
    assert sorted(r.report_id for r in retention.keep_list(spark, " a,,b , a").collect()) == ["a", "b"]
    for text in (None, "", " , "):
        with pytest.raises(ValueError, match="at least one"):
            retention.keep_list(spark, text)
