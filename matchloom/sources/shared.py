"""Tables between the steps of a job, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOTS: set[str] = set()


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the JVM for a path of any store."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = file_system(spark, path)
    return system.exists(where)


def scratch(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir, deleted when the application ends.

    On one machine, as in tests, a temporary folder stands in where the setting is missing.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="matchloom-")
        spark.sparkContext.setCheckpointDir(root)
    base = f"{root.rstrip('/')}/steps/{spark.sparkContext.applicationId}"
    if base not in _ROOTS:
        system, where = file_system(spark, base)
        system.mkdirs(where)
        system.deleteOnExit(where)
        _ROOTS.add(base)
    return f"{base}/{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """The rows written as Parquet and read back: computed once, and a lost executor costs one step."""
    path = path or scratch(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
