"""Rows that every operator must bear: nulls, empty and long texts, repeated rows, ties, and columns with clashing names."""

from __future__ import annotations

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, positions string, hit string, fingerprint string, words string, h bigint, label string, node string"


def docs(spark, *texts, extra=()):
    """Documents 0, 1, ... with the given texts, then (doc_id, text) rows as they are."""
    rows = [(k, t) for k, t in enumerate(texts)] + list(extra)
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), *["x"] * 4, 1, "x", "x") for i, t in rows], SCHEMA)


def labels(spark, rows):
    """(doc_id, quality, toxic)."""
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, quality int, toxic int, text string")
