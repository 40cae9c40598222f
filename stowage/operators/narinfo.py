"""Parsing of narinfo texts into typed records, as DataFrame expressions in one scan.

Bytes are read as ISO-8859-1, so one character is one byte for lengths and comparisons; free text gets its bytes back at the
end. A rule is one pattern over the whole text and a value one extraction from it, both in generated code; hashes of references are decoded through Arrow. Each reject rule is a flag of
its own; a record with any flag set is a reject and keeps all its rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stowage.functions.hashes import VALID, decode_arrays, decode_sql, digits_sql, sound_digits_sql

MAX_UINT64 = "18446744073709551615"

#: Content-address algorithms with their lengths in base 32, hexadecimal and bytes.
CA_LENGTHS = {"md5": (26, 32, 16), "sha1": (32, 40, 20), "sha256": (52, 64, 32), "sha512": (103, 128, 64)}

COLUMNS = (
    "hash", "pname", "compression", "file_hash", "file_size", "nar_hash", "nar_size", "references", "deriver", "deriver_pname",
    "system", "signature_domains", "signature_values", "ca_algo", "ca_hash", "quirk_references_out_of_order",
)

_ZERO20, _ZERO32 = "unhex(repeat('00', 20))", "unhex(repeat('00', 32))"

#: Parts of patterns: a base-32 digit, a hexadecimal digit, and that the line ends here.
_B32, _HEX, _END = VALID.strip("^$+"), "[0-9a-fA-F]", "(?![^\\n])"


def _sql(pattern: str) -> str:
    """A pattern as a SQL string literal."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _text(content: str) -> str:
    """SQL for the content's lines, a line feed before each, without one carriage return at a line's end."""
    t = f"replace(decode({content}, 'ISO-8859-1'), '\\r\\n', '\\n')"
    return f"concat('\\n', regexp_replace({t}, {_sql('\\r$(?![\\s\\S])')}, ''))"


def _all(key: str, but: str = "", of: str = "t") -> str:
    """SQL for the values of a key in order: what follows the line's first ": "."""
    return f"regexp_extract_all({of}, {_sql(f'\\n{key}: {but}([^\\n]*+)')}, 1)"


def _last(values: str) -> str:
    return f"try_element_at({values}, -1)"


def _bytes(text: str) -> str:
    """SQL for the text of which these characters are the bytes, kept as they are even where they are no UTF-8."""
    return f"cast(encode({text}, 'ISO-8859-1') as string)"


def _bad(key: str, good: str) -> str:
    """SQL that is true if a line of the key has a value that does not begin with the pattern."""
    return f"t rlike {_sql(f'\\n{key}: (?!{good})')}"


def _bad_uint(key: str) -> str:
    large = f"exists({_all(key)}, v -> coalesce(try_cast(v as decimal(38,0)) > {MAX_UINT64}BD, true))"
    return f"{_bad(key, f'[0-9]++{_END}')} or case when t rlike {_sql(f'\\n{key}: 0*+[0-9]{{20,}}')} then {large} else false end"


def _sha256(value: str, digits: str) -> str:
    h = f"substring({value}, 8)"
    return f"case when {value} is null then {_ZERO32} when length({h}) = 64 then unhex({h}) else {sound_digits_sql(digits, 52)} end"


def _ca_hash(value: str) -> str:
    h = f"substring_index({value}, ':', -1)"
    forms = [(n, f"when length({h}) = {n} and {value} like '%:{a}:%' then unhex({h})") for a, (_, n, _) in CA_LENGTHS.items()]
    forms += [(n, f"when length({h}) = {n} and {value} like '%:{a}:%' then {decode_sql(h, n)}") for a, (n, _, _) in CA_LENGTHS.items()]
    return f"case when {value} is null then null {' '.join(f for _, f in forms)} end"


def _refs(form: str) -> str:
    """SQL for the parts between single spaces of each References line v_refs that have this form and a dash and a name after it."""
    return f"transform(v_refs, v -> regexp_extract_all(v, {_sql(f'(?<![^ ])({form}-[^ ]++)')}, 1))"


def _hashes() -> str:
    """SQL for the sound hashes of all references in order."""
    return f"flatten(transform(v_refs, v -> regexp_extract_all(v, {_sql(f'(?<![^ ])({_B32}{{32}})-[^ ]++')}, 1)))"


_CA = "|".join(f"{a}:(?:{_B32}{{{b32}}}|{_HEX}{{{hexa}}})" for a, (b32, hexa, _) in CA_LENGTHS.items())

#: Rules by name: SQL that is true for a record that must be rejected. t holds the record's lines but references, each after a line feed.
RULES = {
    "store_path": _bad("StorePath", f"/nix/store/{_B32}{{32}}-[^\\n]"),
    "file_size": _bad_uint("FileSize"),
    "nar_size": _bad_uint("NarSize"),
    "file_hash": _bad("FileHash", f"sha256:(?:{_B32}{{52}}|{_HEX}{{64}}){_END}"),
    "nar_hash": _bad("NarHash", f"sha256:(?:{_B32}{{52}}|{_HEX}{{64}}){_END}"),
    "deriver": _bad("Deriver", f"unknown-deriver{_END}|{_B32}{{32}}-[^\\n]"),
    "ca": _bad("CA", f"(?:fixed|text):(?:r:)?(?:{_CA}){_END}"),
    "sig": _bad("Sig", f"[^:\\n]*+:[A-Za-z0-9+/]{{86}}=={_END}"),
}


@dataclass
class Parsed:
    records: DataFrame
    rejects: DataFrame
    flagged: DataFrame

    def stats(self) -> DataFrame:
        """One row: records processed, exported and failed."""
        return self.flagged.agg(
            F.count("*").alias("processed"), F.count_if(F.size("rules") == 0).alias("exported"), F.count_if(F.size("rules") > 0).alias("failed")
        )


def parse_narinfos(raw: DataFrame, seen: Observation | None = None) -> Parsed:
    """Records, rejects and counts of raw(key, content); other columns are ignored. `seen` observes processed and exported as records are used.

    records: key, the record's columns, dq_missing_store_path and dq_invalid_utf8. A missing StorePath is no error: the hash is zero and
    pname empty. Names keep their bytes where these are no UTF-8, and the flag says so. Of repeated scalar fields the last counts, but each must be sound. References and signatures add up in order.
    rejects: (key, rule), one row for each rule broken. Null content is an empty text.
    """
    whole = _fixed(raw.select("key", F.coalesce("content", F.lit(b"")).alias("content")), {"whole": _text("content")}).drop("content")
    # References have no rule and are most of a text, so every other pattern is looked for without them.
    apart = {"t": f"regexp_replace(whole, {_sql('\nReferences: [^\n]*+')}, '')", "v_refs": _all("References", of="whole")}
    flagged = _fixed(whole, apart).drop("whole")
    rules = F.array(*[F.when(F.expr(sql), name) for name, sql in RULES.items()])
    flagged = flagged.withColumn("rules", F.filter(rules, lambda r: r.isNotNull()))
    rejects = flagged.select("key", F.explode("rules").alias("rule"))
    sound = F.size("rules") == 0
    some = flagged if seen is None else flagged.observe(seen, F.count(F.lit(1)).alias("processed"), F.count_if(sound).alias("exported"))
    good = some.where(sound if seen is not None else ~F.expr(" or ".join(f"({sql})" for sql in RULES.values()))).select("key", "t", "v_refs")

    # Values first, then what is decoded from them, so that no value is worked out for each of its uses. An
    # "unknown-deriver" line changes nothing, so an earlier deriver stays.
    values = {
        "v_path": _last(_all("StorePath")),
        "v_compression": _last(_all("Compression")),
        "v_file_hash": _last(_all("FileHash")),
        "v_nar_hash": _last(_all("NarHash")),
        "v_file_size": _last(_all("FileSize")),
        "v_nar_size": _last(_all("NarSize")),
        "v_deriver": _last(_all("Deriver", f"(?!unknown-deriver{_END})")),
        "v_system": _last(_all("System")),
        "v_ca": _last(_all("CA")),
        "v_sigs": _all("Sig"),
    }
    parts = {
        "d_path": digits_sql("substring(v_path, 12, 32)", 32),
        "d_deriver": digits_sql("substring(v_deriver, 1, 32)", 32),
        "d_file_hash": digits_sql("substring(v_file_hash, 8)", 52),
        "d_nar_hash": digits_sql("substring(v_nar_hash, 8)", 52),
        "v_name": "if(endswith(v_deriver, '.drv') and length(v_deriver) >= 37, substring(v_deriver, 34, length(v_deriver) - 37), substring(v_deriver, 34))",
    }
    out = _fixed(_fixed(good, values), parts)
    quirk = f"exists({_refs('[^ ]{32}')}, a -> a != sort_array(array_distinct(a)))"
    domain = _bytes("substring(v, 1, instr(v, ':') - 1)")
    columns = {
        "hash": f"coalesce({sound_digits_sql('d_path', 32)}, {_ZERO20})",
        "pname": f"coalesce({_bytes('substring(v_path, 45)')}, '')",
        "compression": f"coalesce(nullif({_bytes('v_compression')}, ''), 'bzip2')",
        "file_hash": _sha256("v_file_hash", "d_file_hash"),
        "file_size": "coalesce(cast(v_file_size as decimal(20,0)), cast(0 as decimal(20,0)))",
        "nar_hash": _sha256("v_nar_hash", "d_nar_hash"),
        "nar_size": "coalesce(cast(v_nar_size as decimal(20,0)), cast(0 as decimal(20,0)))",
        "references": decode_arrays(F.expr(_hashes())),
        "deriver": f"coalesce({sound_digits_sql('d_deriver', 32)}, {_ZERO20})",
        "deriver_pname": f"nullif({_bytes('v_name')}, '')",
        "system": f"nullif({_bytes('v_system')}, '')",
        "signature_domains": f"transform(v_sigs, v -> {domain})",
        "signature_values": "transform(v_sigs, v -> try_to_binary(substring(v, instr(v, ':') + 1), 'base64'))",
        "ca_algo": "nullif(regexp_replace(v_ca, '^((?:fixed|text):(?:r:)?[^:]*):.*$', '$1'), '')",
        "ca_hash": _ca_hash("v_ca"),
        "quirk_references_out_of_order": quirk,
        "dq_missing_store_path": "v_path is null",
    }
    records = out.select("key", *[(F.expr(sql) if isinstance(sql, str) else sql).alias(c) for c, sql in columns.items()])
    sound = " and ".join(f"coalesce(is_valid_utf8({c}), true)" for c in ("pname", "compression", "deriver_pname", "system"))
    records = records.withColumn("dq_invalid_utf8", F.expr(f"not ({sound} and forall(signature_domains, d -> is_valid_utf8(d)))"))
    return Parsed(records, rejects, flagged)


def _fixed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df with columns that the optimiser does not copy into each of their uses: a one-row inline keeps them apart."""
    fields = ", ".join(f"{sql} as {c}" for c, sql in columns.items())
    return df.selectExpr("*", f"inline(array(struct({fields})))")


def signatures(records: DataFrame) -> DataFrame:
    """(key, place, domain, value): each record's signatures, domains paired with values."""
    pairs = F.posexplode(F.arrays_zip(F.col("signature_domains").alias("domain"), F.col("signature_values").alias("value"))).alias("place", "s")
    return records.select("key", pairs).select("key", "place", "s.domain", "s.value")


def reference_edges(records: DataFrame) -> DataFrame:
    """(hash, reference): one row for each reference, with repeats."""
    return records.select("hash", F.explode("references").alias("reference"))


def narinfo_only(df: DataFrame, key: str = "key") -> DataFrame:
    return df.where(F.endswith(F.col(key), F.lit(".narinfo")))


def classify_keys(df: DataFrame, key: str = "key") -> DataFrame:
    """df with `class`: nar for the prefix nar/, else narinfo for the suffix .narinfo; any other key is an error."""
    k = F.col(key)
    wrong = F.raise_error(F.concat(F.lit("neither a nar nor a narinfo: "), F.coalesce(k, F.lit("null"))))
    return df.withColumn("class", F.when(k.startswith("nar/"), "nar").when(k.endswith(".narinfo"), "narinfo").otherwise(wrong.cast("string")))


__all__ = ["Parsed", "classify_keys", "narinfo_only", "parse_narinfos", "reference_edges", "signatures"]
