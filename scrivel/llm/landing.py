"""Tables written to the folder that all executors share, and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Folders of sessions that name none, by application; only single machines have one.
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, and only on a single machine, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is not None:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="scrivel-llm-")
    return _OWN[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def landed(df: DataFrame, name: str = "table", codec: str | None = None) -> DataFrame:
    """Write a table that several steps read. A lost executor costs its tasks, not the table.

    Once the table stands its shuffles are of no use, so their files go with the write. The table
    stays as long as the folder does, since results that read it are computed later. ``codec`` is the
    compression of its files, else the session's.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
