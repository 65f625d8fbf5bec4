"""Queue rows and other rows with a state, as transformations from one table to the next; the clock is a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

STALE_MINUTES, ATTEMPTS, BASE_SECONDS, MOST_SECONDS = 15, 3, 60, 3600


def minutes_ago(as_of: Column, minutes: int) -> Column:
    return as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


def backoff(attempts: Column, base: int = BASE_SECONDS, most: int = MOST_SECONDS) -> Column:
    """Seconds to wait after so many attempts: doubled each time, up to ``most``."""
    return F.least(F.lit(float(base)) * F.pow(F.lit(2.0), attempts - 1), F.lit(float(most))).cast("int")


def jittered(seconds: Column, chance: Column) -> Column:
    """0.5 to 1.5 times the wait, for a chance in [0, 1) that the caller draws."""
    return seconds * (0.5 + chance)


def eligible(queue: DataFrame, as_of: Column) -> DataFrame:
    return queue.filter((F.col("status") == "pending") & (F.col("next_attempt_at").isNull() | (F.col("next_attempt_at") <= as_of)))


def next_claim(queue: DataFrame, as_of: Column) -> DataFrame:
    """The row to work on next: the oldest that may run, ties by id. One writer only may claim."""
    return eligible(queue, as_of).orderBy("requested_at", "id").limit(1)


def claimed(queue: DataFrame, ids: DataFrame, as_of: Column) -> DataFrame:
    mine = queue.join(ids.select(F.col("id").alias("_id")), F.col("id") == F.col("_id"), "left")
    hit = F.col("_id").isNotNull()
    return mine.select(*(
        F.when(hit, F.lit("running")).otherwise(F.col(c)).alias(c) if c == "status" else F.when(hit, as_of).otherwise(F.col(c)).alias(c) if c in ("started_at", "last_heartbeat_at")
        else F.when(hit, F.col(c) + 1).otherwise(F.col(c)).alias(c) if c == "attempts" else F.col(c) for c in queue.columns
    ))


def is_stale(as_of: Column) -> Column:
    """Running, and silent for too long; without a heartbeat the start counts."""
    return (F.col("status") == "running") & (F.coalesce("last_heartbeat_at", "started_at") < minutes_ago(as_of, STALE_MINUTES))


def reclaimed(queue: DataFrame, as_of: Column) -> DataFrame:
    return queue.withColumn("status", F.when(is_stale(as_of), "pending").otherwise(F.col("status")))


def next_wait(queue: DataFrame, as_of: Column) -> DataFrame:
    """One row: seconds until a pending row that waits may run; null if none waits."""
    later = queue.filter((F.col("status") == "pending") & (F.col("next_attempt_at") > as_of))
    return later.agg((F.unix_seconds(F.min("next_attempt_at").cast("timestamp")) - F.unix_seconds(as_of.cast("timestamp"))).alias("seconds"))


def failed_once_more(queue: DataFrame, failures: DataFrame, as_of: Column) -> DataFrame:
    """``queue`` after failures (id, error, transient): put back with a wait, or failed for good after the last attempt."""
    joined = queue.join(failures.select(F.col("id").alias("_id"), "error", "transient"), F.col("id") == F.col("_id"), "left")
    hit = F.col("_id").isNotNull()
    again = hit & F.col("transient") & (F.col("attempts") < ATTEMPTS)
    wait = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), backoff(F.greatest(F.col("attempts"), F.lit(1))))
    return joined.select(*(
        F.when(again, "pending").when(hit, "failed").otherwise(F.col(c)).alias(c) if c == "status" else F.when(again, as_of + wait).otherwise(F.col(c)).alias(c) if c == "next_attempt_at"
        else F.when(hit, F.col("error")).otherwise(F.col(c)).alias(c) if c == "error_message" else F.col(c) for c in queue.columns
    ))


def finished(queue: DataFrame, done: DataFrame, as_of: Column) -> DataFrame:
    """``queue`` after completions (id, files_processed); the error message is cleared."""
    joined = queue.join(done.select(F.col("id").alias("_id"), F.col("files_processed").alias("_files")), F.col("id") == F.col("_id"), "left")
    hit = F.col("_id").isNotNull()
    new = {"status": F.lit("completed"), "completed_at": as_of, "files_processed": F.col("_files"), "error_message": F.lit(None)}
    return joined.select(*(F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in queue.columns))


def reaped(runs: DataFrame, as_of: Column) -> DataFrame:
    """Runs that have been running for more than 24 hours or paused for more than 60 minutes fail."""
    gone = ((F.col("status") == "running") & (F.col("started_at") < minutes_ago(as_of, 24 * 60))) | ((F.col("status") == "paused") & (F.col("paused_at") < minutes_ago(as_of, 60)))
    return runs.withColumn("status", F.when(gone, "failed").otherwise(F.col("status")))


def swept(proposals: DataFrame, as_of: Column) -> DataFrame:
    return proposals.withColumn("state", F.when((F.col("state") == "pending") & (F.col("expires_at") < as_of), "expired").otherwise(F.col("state")))


def not_in_flight(requests: DataFrame, queue: DataFrame, key: str = "account_id") -> DataFrame:
    return requests.join(queue.filter(F.col("status").isin("pending", "running")).select(key), key, "left_anti")


def exit_code(queue: DataFrame) -> DataFrame:
    """One row: 1 if a run failed or was put back, else 0."""
    bad = (F.col("status") == "failed") | ((F.col("status") == "pending") & (F.col("attempts") > 0))
    return queue.agg(F.when(F.coalesce(F.bool_or(bad), F.lit(False)), 1).otherwise(0).alias("exit_code"))


#: Signs of a failure that may pass.
SOCKET_CODES = ("ECONNRESET", "ETIMEDOUT", "ECONNREFUSED", "ENETUNREACH", "EAI_AGAIN", "EPIPE")
DATABASE_CODES = ("P1001", "P1002", "P1008", "P1017", "P2024", "P2034")
RATE_LIMIT_REASONS = ("userRateLimitExceeded", "rateLimitExceeded", "quotaExceeded")
MODEL_TEXTS = r"(?i)fetch failed|econnreset|etimedout|econnrefused|socket hang up|deadline exceeded"
SOCKET_TEXTS = r"(?i)socket hang up|network socket disconnected"
STALLS = ("request-timeout", "body-timeout")


def is_transient(error: Column) -> Column:
    """Whether struct(kind, status, code, message, reasons) tells of a failure that may pass.

    ``kind`` is ``truncated`` or ``timeout`` for a model's answer, ``api`` for an HTTP error of the model, a stall of the
    transport (``STALLS``), or anything else. A code of digits is an HTTP status and goes before ``status``. An answer cut off
    never passes; 408 passes only for the model, 403 only for a rate limit among ``reasons``.
    """
    kind, message = F.coalesce(error["kind"], F.lit("")), F.coalesce(error["message"], F.lit(""))
    status = F.coalesce(F.when(error["code"].rlike(r"^\d+$"), error["code"].try_cast("int")), error["status"])
    of_model = F.when(kind == "api", (error["status"] == 408) | (error["status"] == 429) | error["status"].between(500, 599)).otherwise(message.rlike(MODEL_TEXTS))
    limited = (status == 429) | ((status == 403) & F.arrays_overlap(error["reasons"], F.array(*map(F.lit, RATE_LIMIT_REASONS))))
    of_transport = kind.isin(*STALLS) | status.between(500, 599) | error["code"].isin(*SOCKET_CODES, *DATABASE_CODES) | message.rlike(SOCKET_TEXTS)
    signs = [F.coalesce(sign, F.lit(False)) for sign in (kind == "timeout", of_model, limited, of_transport)]
    return (kind != "truncated") & (signs[0] | signs[1] | signs[2] | signs[3])
