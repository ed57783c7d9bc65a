"""Where intermediate tables go, and how a lineage is cut.

They go to the folder named by ``spark.checkpoint.dir``, which all executors
share, or below the warehouse where that is unset.  Where that too is a folder of this machine, there must
be no other one: a cluster without a shared folder is an error.  Tables written there outlive
any executor.  They stand in a folder of their application, which its file system removes when the
application ends; whoever has one written may take it away before that with ``discard``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_CONF = "spark.checkpoint.dir"
WAREHOUSE_CONF = "spark.sql.warehouse.dir"


_FOLDERS: dict[str, str] = {}


def scratch_folder(spark: SparkSession) -> str:
    """The folder of this application's tables; made, and marked to be removed, when first asked for."""
    root = spark.conf.get(SHARED_DIR_CONF, None)
    if not root:
        root = f"{spark.conf.get(WAREHOUSE_CONF).rstrip('/')}/scratch"
        if root.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SHARED_DIR_CONF}, or a warehouse that all executors share")
    key = f"{root.rstrip('/')}/vintagemart/{spark.sparkContext.applicationId}"
    if key not in _FOLDERS:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{key}-{uuid.uuid4().hex}")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        _FOLDERS[key] = folder.toString()
    return _FOLDERS[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one table; nothing is created there."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a written table: evaluated once, whatever reads it and how often."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table on the file system its path names, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def free_shuffles(spark: SparkSession) -> None:
    """Ask for the shuffle files of ended jobs to go: Spark removes them when the driver's garbage is collected."""
    spark._jvm.System.gc()
