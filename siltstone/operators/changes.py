"""Proposed changes and the change log: validation, no-ops, duplicates, notes, expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.text import CANDIDATE, is_candidate
from siltstone.functions.validate import typed, unchanged, validated


def judged(proposals: DataFrame) -> DataFrame:
    """``proposals`` (entity, field, current, raw) with ``ok``, ``value``, ``reason`` and ``noop``."""
    checked = proposals.withColumn("_v", validated(F.col("entity"), F.col("field"), F.col("raw")))
    noop = F.col("_v.ok") & unchanged(F.col("entity"), F.col("field"), F.col("current"), F.col("_v.value"))
    return checked.select(*proposals.columns, F.col("_v.ok").alias("ok"), F.col("_v.value").alias("value"), F.col("_v.reason").alias("reason"), noop.alias("noop"))


def rescued(judgements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Field changes that are valid and change something, and notes made of the invalid ones."""
    changes = judgements.filter("ok AND NOT noop")
    note = F.concat(F.lit("Proposed "), F.col("field"), F.lit(": "), F.coalesce("raw", F.lit("(none)")), F.lit(" ("), F.col("reason"), F.lit(")"))
    return changes, judgements.filter("NOT ok").withColumn("note", note)


def change_rows(changes: DataFrame) -> DataFrame:
    """Audit rows with the new and previous value in the column of its type."""
    previous = [c.alias(f"previous_{n}") for c, n in zip(typed(F.col("field"), F.col("current")), ("text", "uuid", "date"))]
    return changes.select("entity", "entity_id", F.col("field").alias("property"), *typed(F.col("field"), F.col("value")), *previous)


def not_pending(proposals: DataFrame, pending: DataFrame, keys: list[str], as_of: Column) -> DataFrame:
    """Proposals without a live pending one of equal keys and value; nulls equal nulls."""
    live = pending.filter((F.col("state") == "pending") & (F.col("expires_at") > as_of)).select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return proposals.join(live, same, "left_anti")


def with_expiry(proposals: DataFrame, as_of: Column, days: int) -> DataFrame:
    return proposals.withColumn("expires_at", as_of + F.make_dt_interval(F.lit(days)))


def known_facts(notes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Confirmed facts and candidates (entity_id, fact) of bodies of bullet lines, each once."""
    lines = notes.select("entity_id", F.explode(F.split("body", "\n")).alias("line")).filter(F.startswith(F.trim("line"), F.lit("- ")))
    fact = lines.select("entity_id", F.trim(F.substr(F.trim("line"), F.lit(3))).alias("fact")).filter("fact <> ''").distinct()
    open_ = is_candidate(F.col("fact"))
    return fact.filter(~open_), fact.filter(open_).withColumn("fact", F.regexp_replace("fact", CANDIDATE, ""))


def change_kinds(changes: DataFrame) -> DataFrame:
    """Counts of changes (before, after: arrays) that left the elements alone, kept their number, added or took some."""
    from siltstone.functions.text import same_elements

    noop, grew, shrank = same_elements(F.col("before"), F.col("after")), F.size("after") > F.size("before"), F.size("after") < F.size("before")
    return changes.agg(F.count_if(noop).alias("noop"), F.count_if(~noop & ~grew & ~shrank).alias("same_size"), F.count_if(~noop & grew).alias("grew"), F.count_if(~noop & shrank).alias("shrank"))


def restricted_worklist(work: DataFrame, seen: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """The new worklist, and the observations to emit: one for each file (account, file_id, ok) seen as restricted for the first time.

    Later sightings only move ``last_seen``; a success resolves.
    """
    now = seen.groupBy("account", "file_id").agg(F.bool_or("ok").alias("ok"))
    both = work.join(now, ["account", "file_id"], "full_outer")
    status = F.when(F.col("ok"), "resolved").when(F.col("ok").isNotNull(), "open").otherwise(F.col("status"))
    first = F.coalesce("first_seen", as_of)
    updated = both.filter(F.col("status").isNotNull() | ~F.col("ok")).select("account", "file_id", status.alias("status"), first.alias("first_seen"), F.when(F.col("ok").isNotNull(), as_of).otherwise(F.col("last_seen")).alias("last_seen"))
    return updated, both.filter("status IS NULL AND NOT ok").select("account", "file_id")


def new_entity_rows(found: DataFrame, entity: str) -> DataFrame:
    """Proposals for entities found (group_id, name, note, fields map<string,string>): the name, each valid field, and a note if there is one."""
    fields = found.select("group_id", F.explode("fields").alias("property", "raw")).withColumn("_v", validated(F.lit(entity), F.col("property"), F.col("raw")))
    valid = fields.filter("_v.ok AND _v.value IS NOT NULL").select("group_id", "property", F.col("_v.value").alias("value"))
    named = found.select("group_id", F.lit("name").alias("property"), F.col("name").alias("value"))
    noted = found.filter("note IS NOT NULL AND note <> ''").select("group_id", F.lit("note").alias("property"), F.col("note").alias("value"))
    return named.unionByName(valid).unionByName(noted)
