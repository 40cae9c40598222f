"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and returns a DataFrame; all but the
last return the columns of `documents`. A row counts as empty if its text is null or has no word. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stowage.llm import decontamination, lines, packing, queries, similar, toxicity
from stowage.llm.common import materialise, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on `labels` and the stage's own documents, rejects are gone."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs.select(*COLUMNS), model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines are cut out of the texts and n_chars follows; a document of which nothing is left is gone."""
    rows = lines.dedup_lines(docs.select(*COLUMNS))
    gone = (F.col("n_dropped") > 0) & (F.trim("text") == "")
    rows = rows.where(~F.coalesce(gone, F.lit(False)))
    return rows.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(*COLUMNS)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, by a similarity of 0.8 of their five-word shingles, the document with the smallest doc_id stays."""
    return similar.one_of_each(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item or a near copy of one are gone."""
    return decontamination.drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences."""
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_documents),
    ("benchmark decontamination", decontaminate),
    ("packing", pack),
]

#: Models, fingerprints and tokens have no SQL form; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
