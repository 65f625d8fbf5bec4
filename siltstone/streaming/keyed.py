"""State by key that lives from run to run: files that could not be read, and ideas that are known.

Both are stateful operators of Structured Streaming: the state of a key is updated where its rows arrive, and only keys
with new rows or due timers are touched. The state lies in RocksDB and, by the checkpoint, in the shared folder.
"""

from __future__ import annotations

import contextlib
import datetime
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 24 * 3600 * 1000


@contextlib.contextmanager
def rocks(spark: SparkSession) -> Iterator[None]:
    """Streams that start within keep their state in RocksDB, which stateful operators need."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def run_to_end(stream: DataFrame, sink: str, checkpoint: str, timed: bool = True) -> list[dict]:
    """Takes what is there and stops, appending to Parquet under ``sink``; returns the progress of the batches.

    Operators that go by the clock, as all with a time to live do, have always another batch to run; for these one batch
    is run (``timed`` false).
    """
    trigger = {"availableNow": True} if timed else {"once": True}
    with rocks(stream.sparkSession):
        query = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start()
        query.awaitTermination()
    return [dict(p) for p in query.recentProgress]


class RestrictedFiles(StatefulProcessor):
    """Sightings (ok, ts) of a key (account, file_id) as a worklist, one step a day.

    A day counts as read if any of its sightings was. A day that is still open is an element of a list, so its rows may come
    in any order and in any batches; a timer at its end, when the watermark says that nothing of it can come any more,
    takes it into the value: status, first and last day. So a key's state is its open days and one row.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getListState("days", "day long, ok boolean")
        self.work = handle.getValueState("work", "status string, first long, last long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        days = {d: ok for d, ok in self.days.get()}
        for r in rows:
            day = int(r["ts"].replace(tzinfo=r["ts"].tzinfo or datetime.timezone.utc).timestamp() * 1000) // DAY_MS
            if day not in days:
                self.handle.registerTimer((day + 1) * DAY_MS)
            days[day] = days.get(day, False) or bool(r["ok"])
        self.days.put(sorted(days.items()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        upto = expiredTimerInfo.getExpiryTimeInMs() // DAY_MS
        days = sorted(self.days.get())
        status, first, last = self.work.get() or (None, None, None)
        for day, ok in (d for d in days if d[0] < upto):
            if status is None and ok:
                continue  # what was never restricted is no work
            new = status is None
            status, first, last = "resolved" if ok else "open", day if first is None else first, day
            yield Row(account=key[0], file_id=key[1], day=date(day), status=status, first_seen=date(first), emitted=new)
        if status is not None:
            self.work.update((status, first, last))
        left = [d for d in days if d[0] >= upto]
        self.days.put(left) if left else self.days.clear()

    def close(self) -> None:
        pass


def date(day: int) -> datetime.date:
    return datetime.date(1970, 1, 1) + datetime.timedelta(days=day)


WORK = "account long, file_id long, day date, status string, first_seen date, emitted boolean"


def restricted_stream(sightings: DataFrame, late: str = "2 minutes") -> DataFrame:
    """Steps (account, file_id, day, status, first_seen, emitted) of a stream of sightings (account, file_id, ok, ts).

    A file enters the work on the first day on which it could not be read, with one observation (``emitted``); later days move
    it and a day on which it was read resolves it. A day's step comes once the watermark has passed it; rows that are
    later than ``late`` are dropped, and Spark counts them. Null accounts and ids are a key of their own.
    """
    timed = sightings.select("account", "file_id", "ok", "ts").withWatermark("ts", late)
    return timed.groupBy("account", "file_id").transformWithState(RestrictedFiles(), WORK, "Append", "EventTime")


def worklist(steps: DataFrame) -> DataFrame:
    """The newest step of each file: (account, file_id, status, first_seen, last_seen)."""
    top = steps.groupBy("account", "file_id").agg(F.max_by(F.struct("status", "first_seen"), "day").alias("top"), F.max("day").alias("last_seen"))
    return top.select("account", "file_id", "top.status", "top.first_seen", "last_seen")


class KnownIdeas(StatefulProcessor):
    """Names of a key (account) that have not come before, each once, of a map that forgets what has not come for ``ttl_ms``."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getMapState("known", "name string", "times long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        times: dict[str, int] = {}
        for r in rows:
            times[r["name"]] = times.get(r["name"], 0) + 1
        for name, n in times.items():
            before = self.known.getValue((name,)) if self.known.containsKey((name,)) else None
            self.known.updateValue((name,), ((before[0] if before else 0) + n,))
            if before is None:
                yield Row(account=key[0], name=name)

    def close(self) -> None:
        pass


def new_ideas(ideas: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """The ideas (account, name) of a stream that are new to their account, each once; blank and null names are none.

    With ``ttl_ms`` an idea that has not come for so long by the clock is forgotten, which bounds an account's state.
    Without, all are known for good, so the state is Spark's own for distinct rows, which asks no Python of each name.
    """
    named = ideas.select("account", F.trim("name").alias("name")).filter("name <> ''")
    if ttl_ms is None:
        return named.dropDuplicates(["account", "name"])
    return named.groupBy("account").transformWithState(KnownIdeas(ttl_ms), "account long, name string", "Append", "ProcessingTime")


# -- changes and activity -----------------------------------------------------------------------------------------


def actors_of_changes(changes: DataFrame, activity: DataFrame, within: str = "10 minutes", late: str = "2 minutes") -> DataFrame:
    """Changes (sequence, file_id, changed_at) with the activity (event_id, file_id, actor, acted_at) on the same file ``within`` that time of them.

    Of two streams as of two tables the same pairs. Either side's state holds rows only until the watermark has passed
    them by ``within``; rows later than ``late`` are dropped, and Spark counts them. A key of the state is a file's span of
    four times ``within``, so a row meets what is near it and not all that its file has. A change is in one span, an
    activity in each that its reach touches: within reach of an end it is kept, and if late counted, in two.
    """
    reach = F.expr(f"INTERVAL {within}")
    span = lambda at: F.floor(F.unix_micros(at) / (4 * (F.unix_micros(F.timestamp_seconds(F.lit(0)) + reach) - F.unix_micros(F.timestamp_seconds(F.lit(0)))))).cast("long")
    c = changes.select("sequence", F.col("file_id").alias("of"), "changed_at", span(F.col("changed_at")).alias("of_span")).withWatermark("changed_at", late)
    a = activity.select("event_id", F.col("file_id").alias("on"), "actor", "acted_at").withWatermark("acted_at", late)
    a = a.withColumn("on_span", F.explode(F.sequence(span(F.col("acted_at") - reach), span(F.col("acted_at") + reach))))
    near = (F.col("acted_at") >= F.col("changed_at") - reach) & (F.col("acted_at") <= F.col("changed_at") + reach)
    return c.join(a, (F.col("of") == F.col("on")) & (F.col("of_span") == F.col("on_span")) & near).select("sequence", F.col("of").alias("file_id"), "changed_at", "event_id", "actor", "acted_at")


def dropped_late(progress: list[dict]) -> int:
    """Rows that came too late, over all batches of a run."""
    return sum(o["numRowsDroppedByWatermark"] for p in progress for o in p["stateOperators"])


def most_state(progress: list[dict]) -> int:
    """The most rows that the state had after a batch."""
    return max((sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in progress), default=0)
