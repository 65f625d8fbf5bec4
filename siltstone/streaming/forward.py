"""The forward window as a stream: new events since the last run, late ones up to two minutes, tallied per day, file and actor.

A run takes what is there and stops. Each micro-batch replaces its own partition of the sink, so a batch that is run
again after a failure leaves no second copy; the checkpoint moves on only after the batch has been written.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.sources.scratch import delete, shared_root
from siltstone.streaming.state import committed

LATE = "2 minutes"


def edits(stream: DataFrame) -> DataFrame:
    """Edits and creations of the event stream, each event id once within the time that events may be late."""
    kinds = F.create_map(*map(F.lit, ("signup", "edit", "purchase", "create")))
    read = stream.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.get_json_object("props", "$.k").cast("int").alias("file_id"), F.col("user_id").alias("actor"), F.element_at(kinds, F.col("event_type")).alias("action"))
    return read.filter("action IS NOT NULL").withWatermark("ts", LATE).dropDuplicatesWithinWatermark(["event_id"])


def write_batch(batch: DataFrame, number: int, sink: str) -> None:
    """Tallies of one micro-batch, in a partition named by its number, which is overwritten if it is there."""
    tally = batch.groupBy(F.to_date("ts").alias("day"), "file_id", "actor").agg(F.count(F.lit(1)).alias("edits"))
    tally.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(sink)


def run_forward(spark: SparkSession, source: str, sink: str | None = None, checkpoint: str | None = None, process: Callable[[DataFrame, int], DataFrame] | None = None, snapshot_limit: int = 0) -> DataFrame:
    """Runs the stream over all that is new in ``source`` and returns the tallies of all batches so far, summed.

    ``process`` works on each batch first and returns its outcomes (kind); failures among them hold the batch back: nothing is
    tallied, the checkpoint stays, and the next run takes the same events. A sink that was not named is deleted when Spark ends.
    """
    named = sink is not None or checkpoint is not None
    base = f"{shared_root(spark).rstrip('/')}/forward-{uuid.uuid4().hex}"
    sink, checkpoint = sink or f"{base}/sink", checkpoint or f"{base}/checkpoint"
    schema = spark.read.parquet(source).schema
    # a file source watches a folder; one file is picked out of its folder by name
    folder, _, name = source.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    is_file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    whole = is_file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(is_file).isFile()
    stream = reader.option("pathGlobFilter", name).parquet(folder) if whole else reader.parquet(source)
    if not named:
        atexit.register(forget, spark, base)

    def one(batch: DataFrame, number: int) -> None:
        if process is not None:
            committed(process(batch, number), snapshot_limit)
        write_batch(batch, number, sink)

    running = edits(stream).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()
    if running.exception():
        raise running.exception()
    return spark.read.parquet(sink).groupBy("day", "file_id", "actor").agg(F.sum("edits").alias("edits"))


def forget(spark: SparkSession, path: str) -> None:
    try:
        delete(spark, path)
    except Exception:  # the session may be gone by now
        pass


def daily_totals(stream: DataFrame, late: str = LATE) -> DataFrame:
    """Counts per day and action of an event stream, final once the watermark has passed the day."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.to_date("w.start").alias("day"), "event_type", "n")
