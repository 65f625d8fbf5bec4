"""Tables laid out by key: rows of a key lie in one bucket, sorted, so the latest row of each key and its joins shuffle nothing.

A bucketed table pays its one shuffle when it is written; every later aggregation or join on the same keys, or on more, reads
bucket by bucket. Two tables meet without a shuffle if their keys have the same types and their numbers of buckets are equal.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from siltstone.sources.scratch import Scratch

BUCKETS = 16


class Laid:
    """Bucketed tables in a scratch folder, known to the session's catalog until the driver exits."""

    def __init__(self, spark: SparkSession, scratch: Scratch | None = None):
        self.spark, self.scratch, self.names = spark, scratch or Scratch(spark), []
        atexit.register(self._forget)

    def save(self, rows: DataFrame, keys: list[str], name: str, buckets: int = BUCKETS) -> DataFrame:
        """Writes rows in ``buckets`` files by the hash of ``keys``, sorted by them; null keys lie together."""
        table = f"siltstone_{name}_{uuid.uuid4().hex}"
        self.names.append(table)
        writer = rows.repartition(buckets, *keys).write.format("parquet").option("path", f"{self.scratch.root}/{name}")
        writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
        return self.spark.table(table)

    def _forget(self) -> None:
        try:
            for table in self.names:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        except Exception:  # the session may be gone by now
            pass
