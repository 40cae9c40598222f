"""Schemas of the tables. Sizes that are unsigned 64-bit in Parquet files are decimal(20,0) here."""

from __future__ import annotations

OBJECT = "bucket string, key string, size bigint, last_modified_date timestamp, e_tag string, storage_class string"

NARINFO = (
    "hash binary, pname string, compression string, file_hash binary, file_size decimal(20,0), nar_hash binary,"
    " nar_size decimal(20,0), `references` array<binary>, deriver binary, deriver_pname string, system string,"
    " signature_domains array<string>, signature_values array<binary>, ca_algo string, ca_hash binary,"
    " quirk_references_out_of_order boolean"
)

MANIFEST = (
    "files array<struct<key: string, size: bigint, MD5checksum: string>>, sourceBucket string, destinationBucket string,"
    " version string, creationTimestamp string, fileFormat string, fileSchema string"
)

RAW_NARINFO = "key string, content binary"

REMOVAL = "key string, store_path string, not_found boolean, error string"

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"
