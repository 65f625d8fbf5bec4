"""Versioned index: orders are versions of files (customers); later orders are newer versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltstone.operators import versions as V
from siltstone.plans.registry import Tables, query
from siltstone.sources.layout import Laid

CUT = "1996-01-01"


def versions_of(t: Tables) -> DataFrame:
    """Orders as versions: priority as name and skip reason, status as path, year as type."""
    return t.orders.select(
        F.col("o_custkey").alias("file_id"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("path"),
        F.year("o_orderdate").alias("mime_type"), F.to_date("o_orderdate").alias("modified_time"), F.to_date("o_orderdate").alias("scanned_at"), F.col("o_orderkey").alias("run_id"),
        F.when(F.col("o_orderkey") % 5 != 0, F.md5(F.col("o_orderkey").cast("string").cast("binary"))).alias("content_hash"), (F.col("o_orderstatus") != "P").alias("was_extracted"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("skip_reason"),
    )


SQL = """v AS (SELECT o_custkey AS file_id, o_orderkey AS id, o_orderpriority AS name, o_orderstatus AS path, year(o_orderdate) AS mime_type, CAST(o_orderdate AS DATE) AS modified_time,
  CAST(o_orderdate AS DATE) AS scanned_at, o_orderkey AS run_id, CASE WHEN o_orderkey % 5 <> 0 THEN md5(CAST(o_orderkey AS VARCHAR)) END AS content_hash, o_orderstatus <> 'P' AS was_extracted,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS skip_reason FROM orders)"""


@query(f"WITH {SQL} SELECT DISTINCT ON (file_id) file_id, id, name, path, scanned_at FROM v ORDER BY file_id, scanned_at DESC, id DESC")
def latest_snapshot(t: Tables) -> DataFrame:
    return V.latest(versions_of(t).select("file_id", "id", "name", "path", "scanned_at"), ["file_id"], ["scanned_at", "id"])


@query(f"""WITH {SQL}, top AS (SELECT DISTINCT ON (file_id) * FROM v WHERE skip_reason IS NULL OR skip_reason NOT IN ('1-URGENT', '2-HIGH') ORDER BY file_id, scanned_at DESC, id DESC)
  SELECT file_id, id, content_hash FROM top WHERE was_extracted AND content_hash IS NOT NULL AND scanned_at < DATE '1998-01-01'""")
def latest_with_veto(t: Tables) -> DataFrame:
    known = V.last_extracted(versions_of(t), F.lit("1998-01-01").cast("date"), ("1-URGENT", "2-HIGH"))
    return known.select("file_id", "id", "content_hash")


def listing_of(t: Tables) -> DataFrame:
    """What is listed now: each customer's newest order from the cut on."""
    return V.latest(versions_of(t).filter(F.col("scanned_at") >= F.lit(CUT).cast("date")), ["file_id"], ["scanned_at", "id"])


SPLIT = f"""{SQL}, listing AS (SELECT DISTINCT ON (file_id) * FROM v WHERE scanned_at >= DATE '{CUT}' ORDER BY file_id, scanned_at DESC, id DESC),
  old AS (SELECT DISTINCT ON (file_id) * FROM v WHERE scanned_at < DATE '{CUT}' ORDER BY file_id, scanned_at DESC, id DESC)"""
REASON = """CASE WHEN o.file_id IS NULL THEN 'unindexed' WHEN o.name IS DISTINCT FROM l.name THEN 'renamed' WHEN o.path IS DISTINCT FROM l.path THEN 'moved'
  WHEN o.modified_time IS DISTINCT FROM l.modified_time THEN 'modified' WHEN o.mime_type IS DISTINCT FROM l.mime_type THEN 'mime_changed' END"""


@query(f"WITH {SPLIT} SELECT l.file_id, l.id, {REASON} AS reason FROM listing l LEFT JOIN old o USING (file_id)")
def refresh_reason(t: Tables) -> DataFrame:
    old = V.latest(versions_of(t).filter(F.col("scanned_at") < F.lit(CUT).cast("date")), ["file_id"], ["scanned_at", "id"])
    return V.refresh_reason(listing_of(t), old).select("file_id", "id", "reason")


@query(f"WITH {SPLIT} SELECT coalesce({REASON}, 'unchanged') AS reason, count(*) AS files FROM listing l LEFT JOIN old o USING (file_id) GROUP BY 1")
def refresh_counts(t: Tables) -> DataFrame:
    old = V.latest(versions_of(t).filter(F.col("scanned_at") < F.lit(CUT).cast("date")), ["file_id"], ["scanned_at", "id"])
    return V.refresh_counts(V.refresh_reason(listing_of(t), old))


@query("""WITH pairs AS (SELECT l_orderkey AS run_id, l_suppkey AS file_id, l_linenumber, l_quantity, l_shipdate, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F')
  SELECT run_id, file_id, CAST(max(l_shipdate) AS DATE) AS last_ship, count(*) AS n FROM pairs GROUP BY run_id, file_id""")
def same_run_path(t: Tables) -> DataFrame:
    pairs = t.lineitem.join(t.orders.filter("o_orderstatus = 'F'").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return pairs.groupBy(F.col("l_orderkey").alias("run_id"), F.col("l_suppkey").alias("file_id")).agg(F.to_date(F.max("l_shipdate")).alias("last_ship"), F.count(F.lit(1)).alias("n"))


@query(f"""WITH {SPLIT}, seen AS (SELECT DISTINCT ON (file_id) * FROM v WHERE scanned_at < DATE '{CUT}' AND (skip_reason IS NULL OR skip_reason <> 'index_refresh') ORDER BY file_id, scanned_at DESC, id DESC),
  judged AS (SELECT l.file_id, CASE WHEN l.modified_time IS NULL THEN 'no_modified_time' WHEN o.file_id IS NULL THEN 'first_seen' WHEN l.modified_time <= o.modified_time THEN 'delta_unchanged' ELSE 'modified_since_last' END AS reason
  FROM listing l LEFT JOIN seen o USING (file_id)) SELECT file_id, reason <> 'delta_unchanged' AS extract, reason FROM judged""")
def delta_check(t: Tables) -> DataFrame:
    old = versions_of(t).filter(F.col("scanned_at") < F.lit(CUT).cast("date"))
    return V.delta_check(listing_of(t), old).select("file_id", "extract", "reason")


@query("""WITH h AS (SELECT doc_id AS file_id, 'v2:' || sha256(to_json([lang, md5(text)])) AS content_hash, doc_id % 7 = 0 AS restricted FROM documents),
  known AS (SELECT file_id, CASE WHEN file_id % 4 = 0 THEN 'v2:x' ELSE content_hash END AS was FROM h WHERE file_id % 2 = 0)
  SELECT h.file_id, h.content_hash, coalesce(was = content_hash AND NOT restricted, false) AS skip FROM h LEFT JOIN known USING (file_id)""")
def content_gate(t: Tables) -> DataFrame:
    read = t.documents.select(F.col("doc_id").alias("file_id"), "text", F.col("lang").alias("zone"), (F.col("doc_id") % 7 == 0).alias("restricted"))
    before = V.content_gate(read, t.spark.createDataFrame([], "file_id long, content_hash string")).filter("file_id % 2 = 0")
    known = before.select("file_id", F.when(F.col("file_id") % 4 == 0, "v2:x").otherwise(F.col("content_hash")).alias("content_hash"))
    return V.content_gate(read, known).select("file_id", "content_hash", "skip")


@query("SELECT md5(text) AS digest, count(DISTINCT doc_id) AS files, count(DISTINCT lang) AS zones FROM documents GROUP BY 1 HAVING count(DISTINCT doc_id) > 1")
def duplicate_content(t: Tables) -> DataFrame:
    return V.duplicate_content(t.documents.select(F.col("doc_id").alias("file_id"), F.col("lang").alias("zone"), "text"))


@query("""SELECT coalesce(kind, '?') AS kind, was_extracted, skip_reason, category, count(*) AS n FROM (
  SELECT event_type AS kind, event_type = 'view' AS was_extracted, CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN 'too_large' WHEN 'signup' THEN 'restricted' ELSE 'error' END AS skip_reason,
  CASE event_type WHEN 'click' THEN 'too_large' ELSE 'other' END AS category FROM events) GROUP BY ALL""")
def outcome_rows(t: Tables) -> DataFrame:
    kinds = F.create_map(*map(F.lit, ("view", "ok", "click", "skip", "signup", "restricted")))
    outcomes = t.events.select(F.col("event_type").alias("was"), F.coalesce(F.element_at(kinds, F.col("event_type")), F.lit("error")).alias("kind"), F.when(F.col("event_type") == "click", "too_large").alias("reason"))
    rows = V.outcome_columns(outcomes).withColumn("category", V.log_category(F.coalesce("reason", F.lit(""))))
    return rows.groupBy(F.col("was").alias("kind"), "was_extracted", "skip_reason", "category").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_custkey AS file_id, sha256(CAST(sum(CAST(('0x' || substr(sha256('{"id":' || o_orderkey || ',"path":"' || o_orderstatus || '"}'), 1, 15)) AS HUGEINT)) AS VARCHAR) || ':' || count(*)) AS fingerprint
  FROM orders GROUP BY o_custkey""")
def structure_fingerprint(t: Tables) -> DataFrame:
    return V.fingerprint(versions_of(t), ["file_id"], ["id", "path"])


@query("""WITH o AS (SELECT o_custkey, arg_max({'k': o_orderkey, 'p': o_orderpriority}, (CAST(o_orderdate AS DATE), o_orderkey)) AS x, count(*) AS n FROM orders GROUP BY 1)
  SELECT c_custkey, c_mktsegment, x.k AS last_order, x.p AS priority, n FROM customer JOIN o ON o_custkey = c_custkey""")
def laid_out_latest(t: Tables) -> DataFrame:
    """The latest order of each customer and how many there are, from two tables in buckets of customers; only writing them shuffles."""
    laid = Laid(t.orders.sparkSession)
    orders = laid.save(t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("day")), ["c_custkey"], "orders")
    customers = laid.save(t.customer.select("c_custkey", "c_mktsegment"), ["c_custkey"], "customers")
    top = orders.groupBy("c_custkey").agg(F.max_by(F.struct("o_orderkey", "o_orderpriority"), F.struct("day", "o_orderkey")).alias("x"), F.count(F.lit(1)).alias("n"))
    return customers.join(top, "c_custkey").select("c_custkey", "c_mktsegment", F.col("x.o_orderkey").alias("last_order"), F.col("x.o_orderpriority").alias("priority"), "n")
