"""State between batches: versioned tables, the gate before a commit, and walks of one day or one chunk a step.

A state is a Parquet table per batch number. A batch reads the newest version below its own number and overwrites its own,
so a batch that runs again after a failure starts from what it started from before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.sources.scratch import Scratch, delete


class HeldBack(Exception):
    """The batch is not committed; a retry runs over the same rows."""


class StateTable:
    """The versions of one state under ``root``, a folder that driver and executors share; the last ``keep`` stay."""

    def __init__(self, spark: SparkSession, root: str, schema: str, keep: int = 3):
        self.spark, self.root, self.schema, self.keep = spark, root.rstrip("/"), schema, keep

    def versions(self) -> list[int]:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        store = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in store.listStatus(where)] if store.exists(where) else []
        done = [n for n in names if n.startswith("v-") and store.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{n}/_SUCCESS"))]
        return sorted(int(n[2:]) for n in done)

    def before(self, number: int | None = None) -> DataFrame:
        """The newest version below ``number``, or of all; without one no rows."""
        found = [v for v in self.versions() if number is None or v < number]
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/v-{found[-1]}") if found else self.spark.createDataFrame([], self.schema)

    def update(self, number: int, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Writes version ``number``, which ``change`` makes of the one before, and drops those that no retry can need."""
        change(self.before(number)).write.mode("overwrite").parquet(f"{self.root}/v-{number}")
        for old in self.versions()[: -self.keep]:
            delete(self.spark, f"{self.root}/v-{old}")
        return self.before(number + 1)


def gate(outcomes: DataFrame, snapshot_limit: int = 0) -> DataFrame:
    """One row for the outcomes (kind) of a window: counts of each kind of failure, ``advance``, and ``causes`` or null.

    A failed proposal (``stage3``) or a file lost to an error that may pass (``transient``) holds the window back; so do
    snapshots that were not written (``snapshot``), once they are more than ``snapshot_limit``. Other kinds do not count.
    """
    counts = outcomes.agg(*(F.count_if(F.col("kind") == k).alias(k) for k in ("stage3", "transient", "snapshot")))
    causes = F.concat_ws(" + ", *(F.when(F.col(k) > most, F.concat(F.col(k).cast("string"), F.lit(f" {k} failure(s)"))) for k, most in (("stage3", 0), ("transient", 0), ("snapshot", snapshot_limit))))
    return counts.select("stage3", "transient", "snapshot", (causes == "").alias("advance"), F.nullif(causes, F.lit("")).alias("causes"))


def committed(outcomes: DataFrame, snapshot_limit: int = 0) -> None:
    """Raises ``HeldBack`` if the outcomes of a batch hold it back; within ``foreachBatch`` the checkpoint then stays."""
    found = gate(outcomes, snapshot_limit).first()
    if not found["advance"]:
        raise HeldBack(found["causes"])


def next_days(rows: DataFrame, cursors: DataFrame) -> DataFrame:
    """The rows (account, day, ...) of each account's first active day past its cursor (account, cursor); null is before all days."""
    left = rows.join(cursors.select(F.col("account").alias("_account"), "cursor"), F.col("account") == F.col("_account")).filter("cursor IS NULL OR day > cursor").drop("_account", "cursor")
    first = left.groupBy(F.col("account").alias("_account")).agg(F.min("day").alias("_day"))
    return left.join(first, (F.col("account") == F.col("_account")) & (F.col("day") == F.col("_day"))).drop("_account", "_day")


def advanced(rows: DataFrame, cursors: DataFrame) -> DataFrame:
    """``cursors`` after one step: on the day just done, and ``completed`` where no active day was left."""
    done = next_days(rows, cursors).groupBy(F.col("account").alias("_account")).agg(F.min("day").alias("_day"))
    moved = cursors.join(done, F.col("account") == F.col("_account"), "left")
    return moved.select("account", F.coalesce("_day", "cursor").alias("cursor"), F.col("_day").isNull().alias("completed"))


def walk_days(rows: DataFrame, cursors: StateTable, work: Callable[[DataFrame], None], most: int | None = None) -> int:
    """Hands each account's next day to ``work``, all accounts at once, and moves the cursors; a step that fails moves none.

    Stops when no account has a day left, or after ``most`` steps; returns the number of steps. A further call goes on.
    """
    steps = 0
    while most is None or steps < most:
        now = cursors.before()
        due = next_days(rows, now)
        if due.isEmpty():
            break
        work(due)
        number = (cursors.versions() or [0])[-1] + 1
        cursors.update(number, lambda state: advanced(rows, state).select("account", "cursor"))
        steps += 1
    return steps


def chunked(items: DataFrame, order: list[str], size: int) -> DataFrame:
    """``items`` with ``chunk``, numbered from 0 in ``order``, each of at most ``size`` rows.

    Numbers come from counts over ranges of the first column of ``order``, so no task sorts more than a range; rows must differ in ``order``.
    """
    ranged = items.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = ranged.withColumn("_range", F.shiftright("_at", 33))
    ranged = Scratch(items.sparkSession).save(ranged, "ranged")  # numbers depend on how rows were ranged, so they are written once
    counts = {r["_range"]: r["n"] for r in ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, so_far = [], 0
    for number in sorted(counts):
        starts.append((number, so_far))
        so_far += counts[number]
    first = items.sparkSession.createDataFrame(starts, "_of long, _start long")
    placed = ranged.join(F.broadcast(first), F.col("_range") == F.col("_of"))  # a row per partition
    return placed.withColumn("chunk", F.floor((F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)) / size)).select(*items.columns, "chunk")


def run_chunks(items: DataFrame, size: int, order: list[str], done: StateTable, work: Callable[[DataFrame, int], None]) -> int:
    """Works through ``items`` chunk by chunk, keeping the number of the last one in ``done`` (chunk); a run again resumes after it."""
    numbered = chunked(items, order, size)
    last = done.before().agg(F.max("chunk")).first()[0]
    total, steps = numbered.agg(F.max("chunk")).first()[0], 0
    for chunk in range(0 if last is None else last + 1, 0 if total is None else total + 1):
        work(numbered.filter(F.col("chunk") == chunk), chunk)
        done.update(chunk, lambda _, n=chunk: items.sparkSession.createDataFrame([(n,)], done.schema))
        steps += 1
    return steps
