"""Golden rows of the parser: each reject rule, line handling, and the odd cases."""

from __future__ import annotations

import base64

import pytest
from tests.test_hashes import encode

from stowage.operators.narinfo import classify_keys, parse_narinfos

HASH = "0a" * 16
H52 = "0" * 51 + "a"
SIG = base64.b64encode(bytes(range(64))).decode()


def parse(spark, *texts):
    df = spark.createDataFrame([(str(k), None if t is None else bytearray(t if isinstance(t, bytes) else t.encode())) for k, t in enumerate(texts)], "key string, content binary")
    p = parse_narinfos(df)
    return {r.key: r for r in p.records.collect()}, sorted((r.key, r.rule) for r in p.rejects.collect()), p.stats().first()


GOOD = (
    "",
    None,
    "no colon\nStorePaths: x\n",
    f"StorePath: /nix/store/{HASH}-n\r\nCompression: xz\r\n",
    f"StorePath: /nix/store/{HASH}-n",
    "FileSize: 7\nFileSize: 8\n",
    "FileSize: 18446744073709551615\nFileSize: 0018446744073709551615",
    f"FileHash: sha256:{'AB' * 32}\nNarHash: sha256:{H52}",
    "Deriver: unknown-deriver",
    f"Deriver: {HASH}-x.drv",
    f"Deriver: {HASH}-x",
    f"Sig: a-1:{SIG}\nSig: b-1:{SIG}\n",
    "Compression: \nSystem: \n",
    b"System: caf\xc3\xa9: y\n",
)


def test_good_rows(spark):
    rows, rejects, stats = parse(spark, *GOOD)
    assert not rejects and stats.processed == stats.exported == len(GOOD) and stats.failed == 0
    r = [rows[str(k)] for k in range(len(GOOD))]
    assert bytes(r[0].hash) == bytes(20) and r[0].pname == "" and r[0].compression == "bzip2" and r[0].dq_missing_store_path
    assert r[1].compression == "bzip2" and r[2].dq_missing_store_path
    assert r[3].pname == "n" and r[3].compression == "xz" and encode(bytes(r[3].hash)) == HASH
    assert r[4].pname == "n" and not r[4].dq_missing_store_path
    assert int(r[5].file_size) == 8 and int(r[6].file_size) == 2**64 - 1
    assert bytes(r[7].file_hash) == b"\xab" * 32 and encode(bytes(r[7].nar_hash)) == H52
    assert bytes(r[8].deriver) == bytes(20) and r[8].deriver_pname is None
    assert r[9].deriver_pname == "x" and r[10].deriver_pname == "x"
    assert r[11].signature_domains == ["a-1", "b-1"] and [bytes(x) for x in r[11].signature_values] == [bytes(range(64))] * 2
    assert r[12].compression == "bzip2" and r[12].system is None
    assert r[13].system == "café: y"


@pytest.mark.parametrize(
    ("text", "rule"),
    [
        (f"StorePath: /nix/store/{HASH}-", "store_path"),
        (f"StorePath: /nix/stale/{HASH}-n", "store_path"),
        (f"StorePath: /nix/store/{HASH}_n", "store_path"),
        (f"StorePath: /nix/store/{'e' * 32}-n", "store_path"),
        (f"StorePath: /nix/store/{'e' * 32}-n\nStorePath: /nix/store/{HASH}-n", "store_path"),
        ("FileSize: +5", "file_size"),
        ("FileSize:  5", "file_size"),
        ("FileSize: 1e3", "file_size"),
        ("FileSize: ", "file_size"),
        ("FileSize: 1_0", "file_size"),
        ("NarSize: 18446744073709551616", "nar_size"),
        ("NarSize: " + "9" * 60, "nar_size"),
        ("FileHash: md5:00", "file_hash"),
        (f"FileHash: sha256:{'0' * 53}", "file_hash"),
        (f"NarHash: sha256:{'g' * 64}", "nar_hash"),
        (f"NarHash: sha256:{'e' * 52}", "nar_hash"),
        ("Deriver: ", "deriver"),
        (f"Deriver: {HASH}.x", "deriver"),
        (f"Deriver: {'u' * 32}-x", "deriver"),
        ("CA: fixed", "ca"),
        (f"CA: other:sha256:{H52}", "ca"),
        (f"CA: fixed:sha3:{H52}", "ca"),
        ("CA: fixed:sha256:00", "ca"),
        ("Sig: nothing", "sig"),
        ("Sig: a:AAAA", "sig"),
        ("Sig: a:" + "*" * 88, "sig"),
        ("Sig: a:" + base64.b64encode(bytes(63)).decode(), "sig"),
    ],
)
def test_reject_rules(spark, text, rule):
    rows, rejects, stats = parse(spark, text)
    assert rejects == [("0", rule)] and not rows and stats.failed == 1


@pytest.mark.parametrize(("algo", "b32", "size"), [("md5", 26, 16), ("sha1", 32, 20), ("sha256", 52, 32), ("sha512", 103, 64)])
def test_content_addresses(spark, algo, b32, size):
    raw = bytes(range(size))
    text = encode(raw)
    assert len(text) == b32
    rows, rejects, _ = parse(spark, f"CA: fixed:r:{algo}:{text}", f"CA: text:{algo}:{raw.hex().upper()}")
    assert not rejects
    assert (rows["0"].ca_algo, bytes(rows["0"].ca_hash)) == (f"fixed:r:{algo}", raw)
    assert (rows["1"].ca_algo, bytes(rows["1"].ca_hash)) == (f"text:{algo}", raw)


def test_references(spark):
    a, b, bad = "0" * 31 + "1-a", "0" * 31 + "2-b", "e" * 32 + "-x"
    rows, _, _ = parse(
        spark, f"References: {a} {b}\n", f"References: {b} {a}\n", f"References: {a} {a}", f"References: {a}  short {b} {'0' * 32}_x",
        f"References: {bad} {a}", "References: \n", "References:\n", f"References: {b}\nReferences: {a}",
    )
    got = {k: ([encode(bytes(x))[-1] for x in r.references], r.quirk_references_out_of_order) for k, r in rows.items()}
    assert got == {
        "0": (["1", "2"], False), "1": (["2", "1"], True), "2": (["1", "1"], True), "3": (["1", "2"], False),
        "4": (["1"], True), "5": ([], False), "6": ([], False), "7": (["2", "1"], False),
    }


def test_other_keys_are_an_error(spark):
    df = spark.createDataFrame([("nar/x.narinfo",), ("y.narinfo",)], "key string")
    assert [r["class"] for r in classify_keys(df).collect()] == ["nar", "narinfo"]
    with pytest.raises(Exception, match="neither a nar nor a narinfo"):
        classify_keys(spark.createDataFrame([("z.txt",)], "key string")).collect()


def test_bytes_that_are_no_utf8_cost_no_other_record(spark):
    bad = b"\xff\xfe"
    path = b"StorePath: /nix/store/" + HASH.encode() + b"-"
    rows, rejects, _ = parse(
        spark, path + bad, b"Compression: " + bad, b"System: " + bad, b"Deriver: " + HASH.encode() + b"-" + bad + b".drv", b"Sig: " + bad + b":" + SIG.encode(),
        b"Other: " + bad, b"System: fine", b"FileSize: 1" + bad, b"CA: " + bad, bad + b": " + bad,
    )
    assert rejects == [("7", "file_size"), ("8", "ca")]
    assert {k: r.dq_invalid_utf8 for k, r in rows.items()} == {k: k in "01234" for k in "0123456" + "9"}
    assert rows["6"].system == "fine"


def test_names_keep_their_bytes(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a", bytearray(b"System: x\xff\xc3\xa9"))], "key string, content binary")
    r = parse_narinfos(df).records.select(F.hex(F.col("system").cast("binary")).alias("h")).first()
    assert r.h == "78FFC3A9"


def test_references_are_decoded_once(spark):
    """However often they are used, and in one Arrow step, not value by value in a lambda function."""
    from stowage.operators.narinfo import reference_edges

    df = spark.createDataFrame([("a", bytearray(f"References: {HASH}-x".encode()))], "key string, content binary")
    records = parse_narinfos(df).records
    for rows in (records.where("size(`references`) > 0").selectExpr("key", "size(`references`) as n"), reference_edges(records), records):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
    unused = records.select("key", "signature_values")._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in unused


def test_rules_hold_beside_references(spark):
    rows, rejects, _ = parse(spark, f"FileSize: x\nReferences: {HASH}-x", f"References: {HASH}-x\r\nReferences: \nNarSize: -1\nReferences: {HASH}-y", f"xReferences: {HASH}-x\nReferences:{HASH}-x\nSystem: a")
    assert rejects == [("0", "file_size"), ("1", "nar_size")] and rows["2"].references == [] and rows["2"].system == "a"
