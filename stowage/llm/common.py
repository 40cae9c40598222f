"""Helpers shared by the training-data operators: reading tables and cutting lineage with shared files."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables that every executor and the driver can reach.

    It is the session's ``spark.checkpoint.dir``. Only a local session, whose executors are the driver itself, gets a
    folder of its own where that setting is absent.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            where = tempfile.mkdtemp(prefix="stowage-")
        sc.setCheckpointDir(where)
    return sc.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation. The files stay until the folder's own
    clean-up, as other checkpoints do.
    """
    where = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that materialise() returned, once nothing will read it again."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def batch(**columns: pa.Array) -> pa.RecordBatch:
    """Columns as they are: ids that come in by Arrow go out by Arrow, so that none passes through floats beside a null."""
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
