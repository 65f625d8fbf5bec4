"""Activity events: windows, folding, tallies. An event has file_id, ts, action, actor and, once exploded, one target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def window(events: DataFrame, after: Column, until: Column, ts: str = "ts") -> DataFrame:
    """Events in (after, until]."""
    return events.filter((F.col(ts) > after) & (F.col(ts) <= until))


def exploded(raw: DataFrame) -> DataFrame:
    """One row per action and target of raw activities (ts, actor, actions array<string>, targets array<string>)."""
    return raw.withColumn("action", F.explode("actions")).withColumn("target", F.explode("targets")).withColumn("file_id", F.regexp_replace("target", "^items/", "")).withColumn("action", action_kind(F.col("action"))).drop("actions", "targets", "target")


#: The kinds of action that are told apart; all else is other.
ACTIONS = ("edit", "create", "delete", "move", "rename", "restore")


def action_kind(action: Column) -> Column:
    return F.when(F.lower(action).isin(*ACTIONS), F.lower(action)).otherwise("other")


def daily_files(events: DataFrame) -> DataFrame:
    """Per day: distinct files touched by anything but deletion, and the number of deletions."""
    kept = F.when(F.col("action") != "delete", F.col("file_id"))
    return events.groupBy(F.to_date("ts").alias("day")).agg(F.countDistinct(kept).alias("files"), F.count_if(F.col("action") == "delete").alias("deletes"))


def edit_tally(events: DataFrame) -> DataFrame:
    """Edits and creations per file and actor; an event without an actor is not counted."""
    counted = events.filter(F.col("action").isin("edit", "create") & F.col("actor").isNotNull())
    return counted.groupBy("file_id", "actor").agg(F.count(F.lit(1)).alias("edits"))


def tally_by_email(tally: DataFrame, people: DataFrame) -> DataFrame:
    """The tally with actors replaced by their e-mail where ``people`` (actor, email) knows one, summed again."""
    mapped = tally.join(people, "actor", "left").withColumn("who", F.coalesce("email", "actor"))
    return mapped.groupBy("file_id", "who").agg(F.sum("edits").alias("edits"))


def most_edited(events: DataFrame, k: int) -> DataFrame:
    """The k files with most edits, with first and last time and last actor; ties by file."""
    counted = events.filter(F.col("action").isin("edit", "create"))
    per_file = counted.groupBy("file_id").agg(F.count(F.lit(1)).alias("edits"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.max_by("actor", F.struct("ts", "event_id")).alias("last_actor"))
    return per_file.orderBy(F.desc("edits"), "file_id").limit(k)


def by_action(events: DataFrame) -> DataFrame:
    return events.groupBy("action").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("file_id").alias("files"))


def tumbling(events: DataFrame, start: str, days: int) -> DataFrame:
    """Counts per window of ``days`` days from ``start`` on; events before it are left out."""
    number = F.floor(F.datediff(F.to_date("ts"), F.lit(start).cast("date")) / days)
    counts = events.filter(F.to_date("ts") >= F.lit(start).cast("date")).groupBy(number.alias("window_no")).agg(F.count(F.lit(1)).alias("events"), F.countDistinct("actor").alias("actors"))
    return counts.withColumn("starts", F.date_add(F.lit(start).cast("date"), (F.col("window_no") * days).cast("int")))


def effective_days(files: DataFrame) -> DataFrame:
    """Files per day of their last touch, the later of modification and creation; files with neither drop out."""
    day = F.to_date(F.greatest("modified_time", "created_time"))
    return files.withColumn("day", day).filter(F.col("day").isNotNull()).groupBy("day").agg(F.count(F.lit(1)).alias("files"), F.min("file_id").alias("first_file"))


def next_active_day(days: DataFrame, cursor: str) -> DataFrame:
    """The first day after the cursor, and how many follow; null and 0 if none does."""
    later = F.when(F.col("day") > F.lit(cursor).cast("date"), F.col("day"))
    return days.agg(F.min(later).alias("next_day"), F.countDistinct(later).alias("days_left"))


def resolved_actors(actors: DataFrame, cache: DataFrame) -> DataFrame:
    """Every actor with the e-mail that the cache has, else itself, and whether it has to be looked up."""
    return actors.select("actor").distinct().join(cache, "actor", "left").select("actor", F.coalesce("email", "actor").alias("who"), F.col("email").isNull().alias("miss"))
