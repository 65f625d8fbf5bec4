"""Intermediate tables that cut lineage and survive a lost executor.

They are written as Parquet under ``spark.checkpoint.dir``, the folder that driver and executors share. Only where
that is unset, in a local session, a temporary folder takes its place. Tables are deleted when the driver exits or by
``drop``.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared folder; raises on a cluster that names none."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    root = tempfile.mkdtemp(prefix="siltstone-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir()


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Named tables of one operator run, each written once and read back."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_root(spark).rstrip('/')}/siltstone-{uuid.uuid4().hex}"
        atexit.register(self._clear)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            delete(self.spark, f"{self.root}/{name}")

    def clear(self) -> None:
        """Deletes all tables at once; nothing may still read them."""
        delete(self.spark, self.root)

    def _clear(self) -> None:
        try:
            self.clear()
        except Exception:  # the session may be gone by now
            pass
