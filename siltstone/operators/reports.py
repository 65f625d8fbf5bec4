"""Reports and hand-overs: pending work, buckets, log de-duplication, poll outcomes, drain loop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions import json


def pending_by_account(proposals: DataFrame) -> DataFrame:
    """Accounts by their number of pending proposals, the most first."""
    return proposals.filter("state = 'pending'").groupBy("account_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "account_id")


def buckets(observations: DataFrame) -> DataFrame:
    """Buckets of observations (bucket, file_id) by their number, the most first, with distinct files and the first of them."""
    per_file = observations.groupBy("bucket", "file_id").agg(F.count(F.lit(1)).alias("n"))
    counts = per_file.groupBy("bucket").agg(F.sum("n").alias("observations"), F.count(F.lit(1)).alias("files"), F.min("file_id").alias("first_file"))
    return counts.orderBy(F.desc("observations"), "bucket")


def without_columns(rows: DataFrame, *columns: str) -> DataFrame:
    """All columns but those named, so that the scan never reads them."""
    return rows.drop(*columns)


def with_token(rows: DataFrame, column: str = "review_token") -> DataFrame:
    """``rows`` with a random token each; write the result before it is read twice."""
    return rows.withColumn(column, F.expr("replace(uuid(), '-', '')"))


def source_ids(*lists: Column) -> Column:
    """The ids of several arrays, each once, in the order of their first mention."""
    return F.array_distinct(F.concat(*(F.coalesce(x, F.array().cast("array<string>")) for x in lists)))


def unlogged(diagnostics: DataFrame, log: DataFrame, path: str = "$.key") -> DataFrame:
    """Diagnostics (key, ...) whose key no log row's payload (JSON) holds yet."""
    seen = log.select(json.text_at(json.parsed(F.col("payload")), path).alias("_key")).filter("_key IS NOT NULL").distinct()
    return diagnostics.join(seen, F.col("key") == F.col("_key"), "left_anti")


def state_columns(rows: DataFrame, texts: list[str], dates: list[str]) -> DataFrame:
    """Rows as nullable strings: texts with empty ones null, dates as YYYY-MM-DD."""
    return rows.select(*(F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in texts), *(F.date_format(c, "yyyy-MM-dd").alias(c) for c in dates))


def poll_outcome(token: Column, expired: Column, failed: Column, in_scope: Column, in_flight: Column) -> Column:
    """What a poll for changes comes to, the first that holds."""
    return (
        F.when(token.isNull() | (token == "") | expired, "bootstrap_required")
        .when(failed, "failed")
        .when(in_scope == 0, "no_changes")
        .when(in_flight, "skipped_in_flight")
        .otherwise("dispatched")
    )


def polled(state: DataFrame, outcomes: DataFrame, as_of: Column) -> DataFrame:
    """``state`` (id, token, last_outcome, polled_at) after polls (id, outcome, new_token).

    The token moves on when changes were seen or there were none, also while a run is in flight, which picks them up. After a
    failure it stays, so the next poll sees the same changes; a lost one is cleared. States without a poll stay as they are.
    """
    told = state.join(outcomes.select(F.col("id").alias("_id"), "outcome", "new_token"), F.col("id") == F.col("_id"), "left")
    hit, on = F.col("_id").isNotNull(), F.col("outcome").isin("no_changes", "dispatched", "skipped_in_flight")
    return told.select("id", F.when(on, F.col("new_token")).when(F.col("outcome") == "bootstrap_required", None).otherwise(F.col("token")).alias("token"), F.when(hit, F.col("outcome")).otherwise(F.col("last_outcome")).alias("last_outcome"), F.when(hit, as_of).otherwise(F.col("polled_at")).alias("polled_at"))


def drain(claim: Callable[[], dict | None], work: Callable[[dict], None], fail: Callable[[dict, Exception], None], most: int = 100) -> int:
    """Claims rows one by one and works on them until none is left or ``most`` have been; a failure is handed on."""
    done = 0
    while done < most and (row := claim()) is not None:
        try:
            work(row)
        except Exception as e:  # the row's failure is its result
            fail(row, e)
        done += 1
    return done
