"""What a session needs to run this package's jobs."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, if they don't have it installed."""
    env = spark.sparkContext.environment
    path = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in path:
        env["PYTHONPATH"] = ":".join([*path, ROOT])
    return spark


def scratch(spark: SparkSession) -> str:
    """A new folder under the shared ``spark.checkpoint.dir``; only a local session without that setting gets one of its own."""
    where = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="stowage-")
        spark.sparkContext.setCheckpointDir(where)
        where = spark.sparkContext.getCheckpointDir()
    return f"{where}/files-{uuid.uuid4().hex}"
