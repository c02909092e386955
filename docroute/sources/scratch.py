"""The folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder if all run on this machine, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not base:
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="spark-")
        base = f"file://{_own[app]}"
    return base.rstrip("/")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keeper(spark: SparkSession, name: str):
    """A function (df, what) that writes a table to the shared folder and reads it again. What was shuffled for a table goes once it is written."""
    base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def keep(df: DataFrame, what: str) -> DataFrame:
        path, before = f"{base}/{what}-{uuid.uuid4().hex[:6]}", spark.conf.get(_CLEANUP, None)
        spark.conf.set(_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            spark.conf.set(_CLEANUP, before) if before else spark.conf.unset(_CLEANUP)
        return spark.read.schema(df.schema).parquet(path)

    return keep
