"""Activity log: events; ``props.k`` is the file, signup an edit, purchase a creation, error a deletion."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltstone.operators import activity as A
from siltstone.plans.registry import Tables, query


def events_of(t: Tables) -> DataFrame:
    kinds = F.create_map(*map(F.lit, ("signup", "edit", "purchase", "create", "error", "delete")))
    return t.events.select("event_id", "ts", F.get_json_object("props", "$.k").cast("int").alias("file_id"), F.col("user_id").alias("actor"), F.coalesce(F.element_at(kinds, F.col("event_type")), F.lit("other")).alias("action"), "value")


SQL = """e AS (SELECT event_id, ts, CAST(json_extract_string(props, '$.k') AS INT) AS file_id, user_id AS actor,
  CASE event_type WHEN 'signup' THEN 'edit' WHEN 'purchase' THEN 'create' WHEN 'error' THEN 'delete' ELSE 'other' END AS action, value FROM events)"""
EDITS = f"{SQL}, edits AS (SELECT * FROM e WHERE action IN ('edit', 'create'))"


@query(f"WITH {SQL} SELECT CAST(ts AS DATE) AS day, count(DISTINCT CASE WHEN action <> 'delete' THEN file_id END) AS files, count(*) FILTER (WHERE action = 'delete') AS deletes FROM e GROUP BY 1")
def fold_daily_files(t: Tables) -> DataFrame:
    return A.daily_files(events_of(t))


@query(f"WITH {EDITS} SELECT file_id, actor, count(*) AS edits FROM edits WHERE actor IS NOT NULL GROUP BY ALL")
def edit_tally(t: Tables) -> DataFrame:
    return A.edit_tally(events_of(t))


@query(f"WITH {EDITS} SELECT file_id, CASE WHEN actor % 3 = 0 THEN 'person' || (actor % 7) || '@example.org' ELSE CAST(actor AS VARCHAR) END AS who, count(*) AS edits FROM edits GROUP BY ALL")
def edit_tally_by_email(t: Tables) -> DataFrame:
    tally = A.edit_tally(events_of(t)).withColumn("actor", F.col("actor").cast("string"))
    people = t.events.filter("user_id % 3 = 0").select(F.col("user_id").cast("string").alias("actor"), F.concat(F.lit("person"), (F.col("user_id") % 7).cast("string"), F.lit("@example.org")).alias("email")).distinct()
    return A.tally_by_email(tally, people)


@query(f"""WITH {EDITS} SELECT file_id, count(*) AS edits, CAST(min(ts) AS DATE) AS first_seen, CAST(max(ts) AS DATE) AS last_seen, arg_max(actor, (ts, event_id)) AS last_actor
  FROM edits GROUP BY file_id ORDER BY edits DESC, file_id LIMIT 20""")
def top_edited(t: Tables) -> DataFrame:
    return A.most_edited(events_of(t), 20).withColumns({c: F.to_date(c) for c in ("first_seen", "last_seen")})


@query(f"WITH {SQL} SELECT action, count(*) AS n, count(DISTINCT file_id) AS files FROM e GROUP BY action")
def action_breakdown(t: Tables) -> DataFrame:
    return A.by_action(events_of(t))


@query(f"""WITH {SQL}, w AS (SELECT CAST(floor(date_diff('day', DATE '2023-12-20', CAST(ts AS DATE)) / 30.0) AS BIGINT) AS window_no, actor FROM e)
  SELECT window_no, count(*) AS events, count(DISTINCT actor) AS actors, CAST(DATE '2023-12-20' + CAST(window_no * 30 AS INT) AS DATE) AS starts FROM w WHERE window_no >= 0 GROUP BY window_no""")
def tumbling_30d(t: Tables) -> DataFrame:
    return A.tumbling(events_of(t), "2023-12-20", 30)


@query(f"WITH {SQL} SELECT count(*) AS n, count(DISTINCT file_id) AS files, min(event_id) AS first_event, max(event_id) AS last_event FROM e WHERE ts > TIMESTAMP '2024-01-08 00:00:00' AND ts <= TIMESTAMP '2024-01-15 00:00:00'")
def activity_window(t: Tables) -> DataFrame:
    inside = A.window(events_of(t), F.lit("2024-01-08 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    return inside.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("file_id").alias("files"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"))


@query("""SELECT CAST(greatest(o_orderdate, last_ship) AS DATE) AS day, count(*) AS files, min(o_orderkey) AS first_file
  FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey GROUP BY 1""")
def effective_day(t: Tables) -> DataFrame:
    shipped = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("created_time"))
    return A.effective_days(t.orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.col("o_orderkey").alias("file_id"), F.col("o_orderdate").alias("modified_time"), "created_time"))


@query(f"WITH {SQL} SELECT min(d) AS next_day, count(DISTINCT d) AS days_left FROM (SELECT CAST(ts AS DATE) AS d FROM e) WHERE d > DATE '2024-01-20'")
def next_active_day(t: Tables) -> DataFrame:
    return A.next_active_day(events_of(t).select(F.to_date("ts").alias("day")), "2024-01-20")


@query("""SELECT DISTINCT CAST(user_id AS VARCHAR) AS actor, CASE WHEN user_id % 3 = 0 THEN 'p' || user_id ELSE CAST(user_id AS VARCHAR) END AS who, user_id % 3 <> 0 AS miss FROM events""")
def resolve_actors(t: Tables) -> DataFrame:
    actors = t.events.select(F.col("user_id").cast("string").alias("actor"))
    cache = t.events.filter("user_id % 3 = 0").select(F.col("user_id").cast("string").alias("actor"), F.concat(F.lit("p"), F.col("user_id").cast("string")).alias("email")).distinct()
    return A.resolved_actors(actors, cache)


@query(f"WITH {EDITS} SELECT CAST(ts AS DATE) AS day, file_id, actor, count(*) AS edits FROM edits GROUP BY ALL")
def forward_stream(t: Tables) -> DataFrame:
    from siltstone.streaming.forward import run_forward

    return run_forward(t.spark, f"{t.sf_dir}/events.parquet")
