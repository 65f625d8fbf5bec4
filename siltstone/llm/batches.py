"""What bounds the memory of a Python worker: batches of few rows and bytes, and giving back what a task has done with."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Texts may be long, so a thousand rows, or fewer of that many bytes, make a batch.
ROWS, BYTES = 1000, 4 << 20


def in_small_batches(spark: SparkSession, rows: int = ROWS, bytes_: int = BYTES) -> None:
    """Hands rows to Python workers in batches of at most ``rows`` and about ``bytes_``; results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", bytes_)


def release() -> None:
    """Called at the end of a task: gives freed memory back to the system, as the worker lives on for other tasks."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def others(df: DataFrame, *taken: str) -> list[Column]:
    """The columns of ``df`` but those whose names are taken, whatever case or marks their names have."""
    gone = {t.lower() for t in taken}
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c.lower() not in gone]
