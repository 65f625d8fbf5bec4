"""Streams with state by key over the event log and the orders, each against the answer of a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltstone.plans.registry import Tables, query
from siltstone.sources.scratch import Scratch
from siltstone.streaming import keyed


def streamed(scratch: Scratch, rows: DataFrame, name: str) -> DataFrame:
    """Rows as a stream that has them all to give."""
    saved = scratch.save(rows, name)
    return rows.sparkSession.readStream.schema(saved.schema).parquet(f"{scratch.root}/{name}")


def result(scratch: Scratch, stream: DataFrame, name: str) -> DataFrame:
    keyed.run_to_end(stream, f"{scratch.root}/{name}", f"{scratch.root}/{name}-checkpoint")
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{scratch.root}/{name}")


EVENTS = "e AS (SELECT event_id, user_id AS actor, CAST(json_extract(props, '$.k') AS BIGINT) AS file_id, event_type, ts FROM events)"


def events_of(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.col("user_id").alias("actor"), F.get_json_object("props", "$.k").cast("long").alias("file_id"), "event_type", F.col("ts").cast("timestamp").alias("ts"))


@query(f"""WITH {EVENTS}, days AS (SELECT actor % 10 AS account, file_id, CAST(ts AS DATE) AS day, bool_or(event_type <> 'error') AS ok FROM e WHERE CAST(ts AS DATE) < (SELECT CAST(max(ts) - INTERVAL 2 MINUTE AS DATE) FROM events) GROUP BY ALL),
  f AS (SELECT account, file_id, min(day) AS first_seen FROM days WHERE NOT ok GROUP BY ALL)
  SELECT account, file_id, CASE WHEN arg_max(ok, day) THEN 'resolved' ELSE 'open' END AS status, first_seen, max(day) AS last_seen FROM days JOIN f USING (account, file_id) WHERE day >= first_seen GROUP BY ALL""")
def restricted_stream(t: Tables) -> DataFrame:
    """Errors as files that cannot be read, by account: the worklist of all days that the watermark has passed."""
    scratch, e = Scratch(t.events.sparkSession), events_of(t)
    seen = e.select((F.col("actor") % 10).alias("account"), "file_id", (F.col("event_type") != "error").alias("ok"), "ts")
    return keyed.worklist(result(scratch, keyed.restricted_stream(streamed(scratch, seen, "sightings")), "steps"))


@query("SELECT o_custkey AS account, o_orderpriority AS name FROM orders GROUP BY ALL")
def new_ideas_stream(t: Tables) -> DataFrame:
    scratch = Scratch(t.orders.sparkSession)
    ideas = t.orders.select(F.col("o_custkey").alias("account"), F.col("o_orderpriority").alias("name"))
    return result(scratch, keyed.new_ideas(streamed(scratch, ideas, "ideas")), "new")


@query(f"""WITH {EVENTS} SELECT c.event_id AS sequence, c.file_id, a.event_id, a.actor FROM e c JOIN e a ON c.file_id = a.file_id AND c.event_type IN ('signup', 'purchase') AND a.event_type NOT IN ('signup', 'purchase')
  AND a.ts BETWEEN c.ts - INTERVAL 10 MINUTE AND c.ts + INTERVAL 10 MINUTE""")
def change_actors_stream(t: Tables) -> DataFrame:
    """Changes of files joined with what was done to them within ten minutes, as two streams."""
    scratch, e = Scratch(t.events.sparkSession), events_of(t)
    is_change = F.col("event_type").isin("signup", "purchase")
    changes = streamed(scratch, e.filter(is_change).select(F.col("event_id").alias("sequence"), "file_id", F.col("ts").alias("changed_at")), "changes")
    acts = streamed(scratch, e.filter(~is_change).select("event_id", "file_id", "actor", F.col("ts").alias("acted_at")), "acts")
    return result(scratch, keyed.actors_of_changes(changes, acts), "met").select("sequence", "file_id", "event_id", "actor")
