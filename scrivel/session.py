"""Session set-up for programs of this package."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def ship_by_value() -> None:
    """Send this package's Python functions inside the tasks, so workers need no copy of it."""
    import scrivel

    cloudpickle.register_pickle_by_value(scrivel)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see: below ``spark.checkpoint.dir``, or a temporary one on a single machine without it.

    That setting names a shared folder, so it comes back with the scheme of its file system, also where the setting has none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="scrivel-")
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    root = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return f"{re.sub('^file:/+', 'file:///', root)}/{name}-{uuid.uuid4().hex}"


def shared_uri(spark: SparkSession, folder: str) -> str:
    """The folder as an address on the file system that Spark takes for it.

    A path without a scheme belongs to the default file system. On a cluster a folder on one machine's disk is
    refused: every executor would write to its own.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    if full.startswith("file:") and not folder.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{folder} is a folder of one machine; name a shared one, with its scheme")
    return re.sub("^file:/+", "file:///", full)


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session on one machine, for tests and measurements.

    Files are cut into splits small enough for every core to have some, and inputs of the queries, which are files of
    a single row group, are dealt out to all cores.
    """
    settings = {
        "spark.sql.files.maxPartitionBytes": "4m",
        "spark.sql.files.openCostInBytes": "256k",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.scrivel.deal": str(shuffle_partitions),
    } | conf
    builder = SparkSession.builder.master(f"local[{cores}]").appName("scrivel")
    for key, value in settings.items():
        builder = builder.config(key, value)
    ship_by_value()
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
