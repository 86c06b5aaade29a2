"""Lineage cuts that survive executor loss.

Both helpers write to the shared folder named by ``spark.checkpoint.dir``
(reliable storage on a cluster).  A machine-local temporary folder is used
only when the session runs in local mode and no folder is configured, as in
tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, set from ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for an intermediate table under the checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def write_and_read(df: DataFrame, name: str, partition_by=None, path: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Later reads prune columns and (with ``partition_by``) partitions.  Whoever
    gives no ``path`` leaves the table to the end of the session's JVM, which
    deletes it.
    """
    spark = df.sparkSession
    if path is None:
        path = table_path(spark, name)
        delete_on_exit(spark, path)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Delete a folder when the session's JVM ends."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def drop_path(spark: SparkSession, path: str) -> bool:
    """Delete an intermediate folder (any Hadoop file system)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(p, True))
