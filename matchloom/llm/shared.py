"""The shared scratch folder, and small helpers that the operators have in common."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOTS: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir or the context's checkpoint folder. On one machine (as in tests) a temporary folder where neither is set."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="matchloom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession) -> str:
    """A new path in this application's part of the shared folder, which is deleted when the application ends."""
    root = f"{shared_dir(spark)}/matchloom/{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _ROOTS.add(root)
    return f"{root}/{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, **values: str):
    """The session with other settings for a while; names have _ for the dots."""
    before = {}
    for name, value in values.items():
        key = name.replace("_", ".")
        before[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def written_once(spark: SparkSession):
    """While a table is written: its shuffle files go when it is there, not when the driver next collects garbage."""
    return settings(spark, spark_sql_classic_shuffleDependency_fileCleanup_enabled="true")


def removed(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def stored(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write the rows as Parquet into the shared folder and read them from there.

    This cuts the lineage: a lost executor costs only the tasks of the current step,
    and what is read more than once is computed once. partition_by: a column by whose
    values the files are kept apart, so that a reader of one value opens only its files.
    """
    spark = df.sparkSession
    path = scratch(spark)
    with written_once(spark):
        (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_row(df: DataFrame):
    """All columns of df as one struct, so that no name of theirs can meet one of an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def fresh(df: DataFrame, name: str) -> str:
    """The name, with underscores added until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(col):
    """Lower-case A-Z alone."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
