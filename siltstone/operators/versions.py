"""An append-only index of file versions: the latest row per key, what changed, and what has to be read again.

A version has ``file_id``, ``name``, ``path``, ``mime_type``, ``modified_time``, ``content_hash``, ``was_extracted``,
``skip_reason``, ``run_id``, ``scanned_at`` and a unique ``id`` that breaks ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.text import content_hash

#: Reasons of rows that record no reading of the content.
REFRESH = "index_refresh"
TRANSPARENT = ("content_unchanged", "trashed", REFRESH)


def latest(versions: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key with the largest ``order``; later columns of it break ties.

    One hash aggregation that combines before the shuffle: a hot key is one row per task, and nothing is sorted.
    """
    rest = [c for c in versions.columns if c not in keys]
    top = versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_top"))
    return top.select(*keys, *(F.col(f"_top.{c}").alias(c) for c in rest)).select(*versions.columns)


def not_transparent(reason: Column, reasons: tuple[str, ...] = TRANSPARENT) -> Column:
    """Rows that do count; a null reason counts."""
    return reason.isNull() | ~reason.isin(*reasons)


def last_extracted(versions: DataFrame, cutoff: Column, reasons: tuple[str, ...] = TRANSPARENT) -> DataFrame:
    """The last known content per file: look through transparent rows, take the newest, and only then ask of it.

    If the newest was not extracted, has no hash or is not older than ``cutoff``, the file has no known content; an
    older row does not stand in.
    """
    newest = latest(versions.filter(not_transparent(F.col("skip_reason"), reasons)), ["file_id"], ["scanned_at", "id"])
    return newest.filter(F.col("was_extracted") & F.col("content_hash").isNotNull() & (F.col("scanned_at") < cutoff))


def refresh_reason(listing: DataFrame, newest: DataFrame, same_run_path: DataFrame | None = None) -> DataFrame:
    """``listing`` with ``reason``: why a listed file needs a new row, the first of five that holds; null for none.

    ``same_run_path`` (file_id, account_path) stands in for the path of the newest row in the test for moves.
    """
    was = newest.select("file_id", *(F.col(c).alias(f"was_{c}") for c in ("name", "path", "mime_type", "modified_time")), F.lit(True).alias("indexed"))
    joined = listing.join(was, "file_id", "left")
    path = F.col("was_path")
    if same_run_path is not None:
        joined = joined.join(same_run_path.select("file_id", "account_path"), "file_id", "left")
        path = F.coalesce("account_path", "was_path")
    reason = (
        F.when(F.col("indexed").isNull(), "unindexed")
        .when(~F.col("was_name").eqNullSafe(F.col("name")), "renamed")
        .when(~path.eqNullSafe(F.col("path")), "moved")
        .when(~F.col("was_modified_time").eqNullSafe(F.col("modified_time")), "modified")
        .when(~F.col("was_mime_type").eqNullSafe(F.col("mime_type")), "mime_changed")
    )
    return joined.withColumn("reason", reason).select(*listing.columns, "reason")


def refresh_counts(reasons: DataFrame) -> DataFrame:
    return reasons.groupBy(F.coalesce("reason", F.lit("unchanged")).alias("reason")).agg(F.count(F.lit(1)).alias("files"))


def delta_check(listing: DataFrame, versions: DataFrame) -> DataFrame:
    """``listing`` with ``extract`` and ``reason``, by modification times; rows of refreshes are no readings."""
    counted = versions.filter(not_transparent(F.col("skip_reason"), (REFRESH,)))
    newest = latest(counted, ["file_id"], ["scanned_at", "id"]).select("file_id", F.col("modified_time").alias("was_modified"), F.lit(True).alias("seen"))
    now, was = F.col("modified_time"), F.col("was_modified")
    reason = F.when(now.isNull(), "no_modified_time").when(F.col("seen").isNull(), "first_seen").when(now <= was, "delta_unchanged").otherwise("modified_since_last")
    return listing.join(newest, "file_id", "left").withColumn("reason", reason).withColumn("extract", F.col("reason") != "delta_unchanged").select(*listing.columns, "extract", "reason")


def content_gate(read: DataFrame, known: DataFrame) -> DataFrame:
    """``read`` (file_id, text, zone, restricted) with ``content_hash`` and ``skip``.

    A file is skipped if its content and zone hash as before, unless it was restricted.
    """
    hashed = read.withColumn("content_hash", content_hash("v2", F.col("zone"), F.md5(F.col("text").cast("binary"))))
    before = known.select("file_id", F.col("content_hash").alias("was_hash"))
    skip = F.coalesce((F.col("was_hash") == F.col("content_hash")) & ~F.col("restricted"), F.lit(False))
    return hashed.join(before, "file_id", "left").withColumn("skip", skip).drop("was_hash")


def duplicate_content(files: DataFrame) -> DataFrame:
    """Hashes (md5 of ``text``) that more than one file has, with the number of files and of their zones."""
    grouped = files.groupBy(F.md5(F.col("text").cast("binary")).alias("digest"))
    return grouped.agg(F.countDistinct("file_id").alias("files"), F.countDistinct("zone").alias("zones")).filter("files > 1")


def fingerprint(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A hash of each key's rows that does not depend on their order: a sum over hashes of rows, and their number.

    Nothing is collected, so a key may have any number of rows.
    """
    one = F.conv(F.substring(F.sha2(F.to_json(F.struct(*columns)), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return rows.groupBy(*keys).agg(F.sum(one).alias("_sum"), F.count(F.lit(1)).alias("n")).select(*keys, F.sha2(F.concat_ws(":", "_sum", "n"), 256).alias("fingerprint"))


def outcome_columns(outcomes: DataFrame) -> DataFrame:
    """``outcomes`` (kind, reason) with ``was_extracted`` and ``skip_reason`` of the version to write."""
    kind = F.col("kind")
    reason = F.when(kind == "ok", None).when(kind == "skip", F.col("reason")).when(kind == "restricted", "restricted").otherwise("error")
    return outcomes.withColumn("was_extracted", kind == "ok").withColumn("skip_reason", reason)


def log_category(reason: Column) -> Column:
    return F.when(reason == "too_large", "too_large").when(reason == "unsupported_mime", "unsupported_mime").otherwise("other")
