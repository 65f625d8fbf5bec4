"""Listings, completer steps, zones, walks and failures on the driver's tables, each against its SQL."""

from __future__ import annotations

import json
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from siltstone.functions import text as X
from siltstone.functions.validate import validated
from siltstone.operators import activity as A, changes as C, hierarchy as T, lifecycle as L, matching as M, reports as P, resolution as R, scores as S
from siltstone.plans.registry import Tables, query
from siltstone.plans.trees import FOLDERS, TREE, folders_of, tree_of
from siltstone.sources import feed, listing, sinks
from siltstone.sources.completer import complete, prompts_of, read_replies
from siltstone.sources.extraction import MAX_BYTES, SPACE, extract, paragraphs_text, sheets_text, skip_reason, slides_text
from siltstone.sources.scratch import Scratch
from siltstone.sources.tablelog import TableLog
from siltstone.streaming import state

NOW = "1997-06-15"


def day(text: str):
    return F.lit(text).cast("date")


# -- listings -----------------------------------------------------------------------------------------------------

ENTRIES = f"""{FOLDERS}, e AS (SELECT id, name, 'folder' AS mime_type, parent_id, FALSE AS trashed, CAST(0 AS BIGINT) AS size, NULL AS created, 0 AS position FROM f
  UNION ALL SELECT 'o' || o_orderkey, o_orderpriority, 'text/plain', 'c' || o_custkey, o_orderstatus = 'P', CAST(floor(o_totalprice) AS BIGINT), o_orderdate, o_orderkey FROM orders)"""


def entries_of(t: Tables) -> DataFrame:
    folders = folders_of(t).select("id", "name", F.lit(listing.FOLDER).alias("mime_type"), "parent_id", F.lit(False).alias("trashed"), F.lit(0).cast("long").alias("size"), F.lit(None).cast("timestamp_ntz").alias("created_time"), F.lit(0).cast("long").alias("position"))
    key = F.col("o_orderkey").cast("string")
    files = t.orders.select(
        F.concat(F.lit("o"), key).alias("id"), F.col("o_orderpriority").alias("name"), F.lit("text/plain").alias("mime_type"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("parent_id"),
        (F.col("o_orderstatus") == "P").alias("trashed"), F.floor("o_totalprice").cast("long").alias("size"), F.col("o_orderdate").cast("timestamp_ntz").alias("created_time"), F.col("o_orderkey").alias("position"),
    )
    return folders.unionByName(files)


@query(f"WITH {ENTRIES} SELECT id, name FROM e WHERE parent_id = 'c1' AND NOT trashed")
def folder_children(t: Tables) -> DataFrame:
    return listing.children(entries_of(t), "c1").select("id", "name")


@query(f"WITH {ENTRIES} SELECT id, name FROM e WHERE parent_id = 'n2' AND mime_type = 'folder'")
def folder_subfolders(t: Tables) -> DataFrame:
    return listing.subfolders(entries_of(t), "n2")


@query(f"WITH {ENTRIES} SELECT id, parent_id FROM e WHERE mime_type = 'folder'")
def folder_sweep(t: Tables) -> DataFrame:
    return listing.all_folders(entries_of(t)).select("id", "parent_id")


@query(f"WITH {ENTRIES} SELECT id, parent_id, size FROM e WHERE mime_type <> 'folder' AND NOT trashed AND size > 50000 AND parent_id IN (SELECT id FROM f WHERE parent_id LIKE 'n%1')")
def file_sweep(t: Tables) -> DataFrame:
    within = folders_of(t).filter("parent_id LIKE 'n%1'").select("id")
    return listing.files_below(entries_of(t), within, F.col("size") > 50000).select("id", "parent_id", "size")


@query(f"WITH {ENTRIES} SELECT id, name AS path FROM e WHERE mime_type <> 'folder' AND NOT trashed ORDER BY created NULLS FIRST, position, id LIMIT 25")
def oldest_files(t: Tables) -> DataFrame:
    return listing.oldest_files(entries_of(t), 25).select("id", "path")


@query(f"WITH {ENTRIES} SELECT id, name FROM e WHERE id IN (SELECT 'o' || l_orderkey FROM lineitem WHERE l_quantity >= 50) OR id = 'c3'")
def by_ids(t: Tables) -> DataFrame:
    ids = t.lineitem.filter("l_quantity >= 50").select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("id"))
    return listing.by_ids(entries_of(t), ids.unionByName(ids.sparkSession.createDataFrame([("c3",), ("nobody",)], "id string"))).select("id", "name")


@query("SELECT CASE WHEN c_custkey % 3 = 0 THEN 'drive_root' WHEN c_custkey % 3 = 1 THEN 'inside_drive' ELSE 'personal' END AS kind, count(*) AS n FROM customer GROUP BY 1")
def root_kinds(t: Tables) -> DataFrame:
    k = F.col("c_custkey") % 3
    return t.customer.select(listing.root_kind(F.col("c_name"), F.when(k == 0, F.col("c_name")).when(k == 1, "drive")).alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_type, count(*) AS n, max(event_id) AS token FROM events WHERE event_id > 500 GROUP BY 1")
def change_feed(t: Tables) -> DataFrame:
    new, _ = listing.changes_since(t.events.withColumnRenamed("event_id", "sequence"), 500, 0)
    return new.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("sequence").alias("token"))


@query(f"WITH RECURSIVE {TREE} SELECT c_custkey, coalesce(reach = 'in', false) AS inside FROM customer LEFT JOIN tree ON id = 'c' || c_custkey")
def inside_root(t: Tables) -> DataFrame:
    ids = t.customer.select("c_custkey", F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"))
    return listing.inside_root(ids, tree_of(t), "root").select("c_custkey", "inside")


# -- trees --------------------------------------------------------------------------------------------------------

CHAIN = """s AS (SELECT s_suppkey AS k, row_number() OVER (ORDER BY s_suppkey) AS place FROM supplier),
  c AS (SELECT 's' || place AS id, CASE WHEN place = 1 THEN 'root' ELSE 's' || (place - 1) END AS parent_id, place FROM s)"""


@query(f"WITH {CHAIN} SELECT id, 'in' AS reach, CASE WHEN place <= 101 THEN CAST(place AS INT) END AS depth FROM c UNION ALL SELECT 'loop' || n_nationkey, 'orphan', NULL FROM nation")
def deep_chain(t: Tables) -> DataFrame:
    """Suppliers as one chain of folders, however many there are, and nations as one loop."""
    chain = t.supplier.select("s_suppkey").distinct()
    chain = chain.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.when(F.col("s_suppkey") == 1, "root").otherwise(F.concat(F.lit("s"), (F.col("s_suppkey") - 1).cast("string"))).alias("parent_id"))
    first = t.supplier.agg(F.min("s_suppkey")).first()[0]
    if first != 1:  # suppliers that are numbered from 0
        shifted = (F.regexp_replace("id", "^s", "").cast("long") + 1 - first).cast("long")
        chain = chain.select(F.concat(F.lit("s"), shifted.cast("string")).alias("id"), F.when(shifted == 1, "root").otherwise(F.concat(F.lit("s"), (shifted - 1).cast("string"))).alias("parent_id"))
    loop = t.nation.select(F.concat(F.lit("loop"), F.col("n_nationkey").cast("string")).alias("id"), F.concat(F.lit("loop"), ((F.col("n_nationkey") + 1) % 25).cast("string")).alias("parent_id"))
    both = chain.unionByName(loop).withColumn("name", F.col("id"))
    return T.resolve(both, "root").select("id", "reach", "depth")


@query(f"""WITH RECURSIVE {TREE}, x AS (SELECT o_orderkey, coalesce(reach, 'orphan') AS reach, o_orderkey % 10 = 0 AS two FROM orders LEFT JOIN tree ON id = 'c' || o_custkey)
  SELECT count(*) FILTER (WHERE reach = 'in') AS in_scope, count(*) FILTER (WHERE reach = 'out') AS out_of_scope, count(*) FILTER (WHERE reach = 'orphan') AS orphans, count(*) FILTER (WHERE two) AS multi_parent, CAST(0 AS BIGINT) AS depth_cap FROM x""")
def file_map_stats(t: Tables) -> DataFrame:
    customer = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    files = t.orders.select(F.col("o_orderkey").cast("string").alias("id"), customer.alias("parent_id"), F.when(F.col("o_orderkey") % 10 == 0, F.array(customer, F.lit("n1"))).otherwise(F.array(customer)).alias("parents"))
    return T.map_stats(files, tree_of(t), "root", "drive", "files")


@query(f"WITH RECURSIVE {TREE} SELECT o_orderkey, 'Work / ' || path || ' / ' || o_orderpriority AS path FROM orders JOIN tree ON id = 'c' || o_custkey WHERE reach = 'in'")
def subtree_files(t: Tables) -> DataFrame:
    files = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("name"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("parent_id"))
    return T.subtree_files(files, tree_of(t), "root", "Work").select("o_orderkey", "path")


OWNED = f"""{TREE}, lab AS (SELECT id AS folder_id, CASE CAST(substr(id, 2) AS INT) % 3 WHEN 0 THEN 'existing' WHEN 1 THEN 'new' ELSE 'other' END AS label, 'k' || id AS campaign_id, 'name ' || id AS campaign_name FROM f WHERE id LIKE 'n%'),
  pc AS (SELECT id AS folder_id, 'p' || id AS piece_id, 'K' || id AS campaign_id FROM tree WHERE reach = 'in' AND id LIKE 'c%' AND CAST(substr(id, 2) AS INT) % 10 = 0),
  own AS (SELECT folder_id, 'existing' AS status, campaign_id, piece_id FROM pc UNION ALL SELECT folder_id, label, campaign_id, NULL FROM lab WHERE label <> 'other' AND folder_id NOT IN (SELECT folder_id FROM pc)),
  chain AS (SELECT id, unnest(ids) AS folder_id, generate_subscripts(ids, 1) AS place FROM tree WHERE reach = 'in'),
  best AS (SELECT id, arg_max({{'s': status, 'k': campaign_id, 'p': piece_id}}, place) AS o FROM chain JOIN own USING (folder_id) GROUP BY id)"""


def owned(t: Tables, rows: DataFrame) -> DataFrame:
    folders = folders_of(t)
    number = F.substr("id", F.lit(2)).cast("int")
    labels = folders.filter("id LIKE 'n%'").select(F.col("id").alias("folder_id"), F.when(number % 3 == 0, "existing").when(number % 3 == 1, "new").otherwise("other").alias("label"), F.concat(F.lit("k"), "id").alias("campaign_id"), F.concat(F.lit("name "), "id").alias("campaign_name"))
    pieces = folders.filter("id LIKE 'c%'").filter(number % 10 == 0).select(F.col("id").alias("folder_id"), F.concat(F.lit("p"), "id").alias("piece_id"), F.col("name").alias("piece_name"), F.concat(F.lit("K"), "id").alias("campaign_id"), F.lit("of pieces").alias("campaign_name"))
    return T.attributed(rows, tree_of(t), labels, pieces)


@query(f"WITH RECURSIVE {OWNED} SELECT o_orderkey, CASE WHEN o IS NULL THEN 'account' ELSE 'campaign' END AS owner_type, o.k AS campaign_id, o.s AS status, o.p AS piece_id FROM orders LEFT JOIN best ON id = 'c' || o_custkey")
def attribution(t: Tables) -> DataFrame:
    files = t.orders.select("o_orderkey", F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("parent_id"))
    return owned(t, files).select("o_orderkey", "owner_type", "campaign_id", "status", "piece_id")


@query(f"""WITH RECURSIVE {OWNED}, x AS (SELECT o_orderkey, o.k AS k, o.s AS s, o.p AS p, CASE o_orderkey % 4 WHEN 0 THEN coalesce('Spring ' || o.k, 'KNOWN ONE') WHEN 1 THEN 'elsewhere at all' WHEN 2 THEN '' END AS tag FROM orders LEFT JOIN best ON id = 'c' || o_custkey)
  SELECT CASE WHEN k IS NULL THEN CASE WHEN tag = 'KNOWN ONE' THEN 'existing:one' WHEN tag <> '' THEN 'account' END WHEN tag = 'elsewhere at all' THEN NULL WHEN p IS NOT NULL THEN 'piece' WHEN s = 'existing' THEN 'existing' ELSE 'new' END AS bucket,
    CASE WHEN k IS NULL THEN CASE WHEN tag = 'KNOWN ONE' THEN 'tag-exact' WHEN tag <> '' THEN 'unknown_to_account' ELSE 'discard' END WHEN tag = 'elsewhere at all' THEN 'foreign' WHEN p IS NOT NULL THEN 'piece' ELSE 'zone' END AS via, count(*) AS n FROM x GROUP BY ALL""")
def zone_routing(t: Tables) -> DataFrame:
    files = t.orders.select("o_orderkey", F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("parent_id"))
    placed = owned(t, files).withColumn("folder_id", F.col("owner_folder"))
    k = F.col("o_orderkey") % 4
    obs = placed.withColumn("tag", F.when(k == 0, F.coalesce(F.concat(F.lit("Spring "), "campaign_id"), F.lit("KNOWN ONE"))).when(k == 1, "elsewhere at all").when(k == 2, ""))
    obs = Scratch(obs.sparkSession).save(obs.select("o_orderkey", "tag", "owner_type", "folder_id", "campaign_id", "campaign_name", "status", "piece_id"), "observations")
    families = obs.filter("campaign_id IS NOT NULL").select("campaign_id").distinct().withColumn("names", F.array(F.lit("Autumn"), F.concat(F.lit("spring "), "campaign_id")))
    known = t.nation.sparkSession.createDataFrame([("Known One", 0)], "name string, position int")
    directory = R.name_directory(known.select("name", F.lit("existing").alias("kind"), F.lit("one").alias("target")))
    tags = obs.select(F.trim("tag").alias("name")).filter("name <> ''").distinct()
    found = R.zoned(obs, families, M.match_names(tags, known), directory)
    kind = F.when(F.col("via").isin("zone", "piece"), F.regexp_extract("bucket", "^[a-z]+", 0)).otherwise(F.col("bucket"))
    return found.groupBy(kind.alias("bucket"), "via").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderpriority AS name, min(o_orderkey) AS first FROM orders WHERE o_orderpriority LIKE '%HIGH%' GROUP BY 1")
def shallowest_match(t: Tables) -> DataFrame:
    folders = t.orders.groupBy(F.col("o_orderpriority").alias("name")).agg(F.min("o_orderkey").alias("first")).select("name", "first", F.lit(1).alias("depth"), F.col("name").alias("path"))
    return T.shallowest(folders, "high").select("name", "first")


# -- failures, polls, walks, charges ------------------------------------------------------------------------------

ERRORS = """x AS (SELECT o_orderkey, CAST(400 + o_orderkey % 200 AS INT) AS status, ['truncated', 'timeout', 'api', 'request-timeout', NULL, NULL, NULL][1 + o_orderkey % 7] AS kind,
  ['ECONNRESET', 'ENOTFOUND', 'ENETUNREACH', 'P1001', 'P2002', '429', '503', NULL, NULL, NULL, NULL][1 + o_orderkey % 11] AS code,
  ['Fetch failed', 'overloaded', 'Deadline exceeded', 'socket hang up', 'rate limit', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL][1 + o_orderkey % 13] AS message, o_orderkey % 5 = 0 AS limited FROM orders),
  y AS (SELECT *, coalesce(TRY_CAST(code AS INT), status) AS s FROM x)"""


@query(f"""WITH {ERRORS}, z AS (SELECT *, kind IS DISTINCT FROM 'truncated' AND coalesce(kind IN ('timeout', 'request-timeout') OR (kind = 'api' AND (status IN (408, 429) OR status >= 500))
    OR (kind IS DISTINCT FROM 'api' AND message IN ('Fetch failed', 'Deadline exceeded', 'socket hang up')) OR message = 'socket hang up' OR s = 429 OR (s = 403 AND limited) OR s >= 500 OR code IN ('ECONNRESET', 'ENETUNREACH', 'P1001'), false) AS transient FROM y)
  SELECT transient, kind, code, count(*) AS n FROM z GROUP BY ALL""")
def transient_failures(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    pick = lambda *values: F.get(F.array(*(F.lit(v).cast("string") for v in values)), (key % len(values)).cast("int"))
    kind, code = pick("truncated", "timeout", "api", "request-timeout", None, None, None), pick("ECONNRESET", "ENOTFOUND", "ENETUNREACH", "P1001", "P2002", "429", "503", None, None, None, None)
    message = pick("Fetch failed", "overloaded", "Deadline exceeded", "socket hang up", "rate limit", *[None] * 8)
    reasons = F.when(key % 5 == 0, F.array(F.lit("quotaExceeded"))).otherwise(F.array(F.lit("forbidden")))
    error = F.struct(kind.alias("kind"), (400 + key % 200).cast("int").alias("status"), code.alias("code"), message.alias("message"), reasons.alias("reasons"))
    return t.orders.select(L.is_transient(error).alias("transient"), kind.alias("kind"), code.alias("code")).groupBy("transient", "kind", "code").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT count(*) FILTER (WHERE event_type = 'error' AND user_id % 3 = 0) AS stage3, count(*) FILTER (WHERE event_type = 'error' AND user_id % 3 = 1) AS transient, count(*) FILTER (WHERE event_type = 'error' AND user_id % 3 = 2) AS snapshot,
    count(*) FILTER (WHERE event_type = 'error' AND user_id % 3 < 2) = 0 AS advance FROM events""")
def commit_gate(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") != "error", "ok").otherwise(F.element_at(F.array(*map(F.lit, ("stage3", "transient", "snapshot"))), (F.col("user_id") % 3 + 1).cast("int")))
    return state.gate(t.events.select(kind.alias("kind")), snapshot_limit=1 << 40).drop("causes")


@query(f"""WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 4 > 0 THEN CAST('199' || (c_custkey % 8) || '-06-15' AS DATE) END AS cursor FROM customer), o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders),
  n AS (SELECT c_custkey, cursor, min(day) FILTER (WHERE cursor IS NULL OR day > cursor) AS next FROM c LEFT JOIN o ON o_custkey = c_custkey GROUP BY ALL)
  SELECT c_custkey AS account, coalesce(next, cursor) AS cursor, next IS NULL AS completed FROM n""")
def day_walk_step(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    cursors = t.customer.select(k.alias("account"), F.when(k % 4 > 0, F.to_date(F.concat(F.lit("199"), (k % 8).cast("string"), F.lit("-06-15")))).alias("cursor"))
    return state.advanced(t.orders.select(F.col("o_custkey").alias("account"), F.to_date("o_orderdate").alias("day")), cursors)


@query("SELECT (rn - 1) // 1000 AS chunk, count(*) AS n, min(o_orderkey) AS first FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) GROUP BY 1")
def sync_chunks(t: Tables) -> DataFrame:
    return state.chunked(t.orders.select("o_orderkey"), ["o_orderkey"], 1000).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first"))


@query("""SELECT s_suppkey AS id, CASE WHEN s_suppkey % 5 IN (0, 1, 2) THEN 'next' WHEN s_suppkey % 5 = 3 THEN NULL ELSE 'old' END AS token, ['no_changes', 'dispatched', 'skipped_in_flight', 'bootstrap_required', 'failed'][1 + s_suppkey % 5] AS last_outcome FROM supplier""")
def poll_transition(t: Tables) -> DataFrame:
    outcome = F.get(F.array(*map(F.lit, ("no_changes", "dispatched", "skipped_in_flight", "bootstrap_required", "failed"))), (F.col("s_suppkey") % 5).cast("int"))
    before = t.supplier.select(F.col("s_suppkey").alias("id"), F.lit("old").alias("token"), F.lit(None).cast("string").alias("last_outcome"), F.lit(None).cast("date").alias("polled_at"))
    return P.polled(before, t.supplier.select(F.col("s_suppkey").alias("id"), outcome.alias("outcome"), F.lit("next").alias("new_token")), day(NOW)).drop("polled_at")


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN 'flash' ELSE 'other' END AS family, CASE WHEN l_partkey % 5 > 0 THEN l_partkey END AS p, CASE WHEN l_partkey % 3 > 0 THEN l_suppkey END AS o, CASE WHEN l_partkey % 2 > 0 THEN l_suppkey * 2 END AS th, CASE WHEN l_partkey % 7 > 0 THEN l_partkey + l_suppkey * 4 END AS tot FROM lineitem),
  y AS (SELECT *, p IS NULL OR (o IS NULL AND tot IS NULL) AS unknown, greatest(coalesce(o, 0) + coalesce(th, 0), coalesce(tot - p, 0)) AS side FROM x)
  SELECT l_linenumber, unknown, count(*) AS n, round(sum(CASE WHEN unknown THEN 1.5 ELSE CASE family WHEN 'flash' THEN (p * 0.3 + side * 2.5) / 1e6 ELSE (p * 1.25 + side * 10.0) / 1e6 END END), 6) AS usd FROM y GROUP BY ALL""")
def call_charges(t: Tables) -> DataFrame:
    p, s, n = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    prompt, output, total = F.when(p % 5 > 0, p), F.when(p % 3 > 0, s), F.when(p % 7 > 0, p + s * 4)
    usd = S.charge(F.when(n % 2 == 0, "flash").otherwise("other"), prompt, output, F.when(p % 2 > 0, s * 2), total, F.lit(1.5))
    unknown = prompt.isNull() | (output.isNull() & total.isNull())
    return t.lineitem.select("l_linenumber", unknown.alias("unknown"), usd.alias("usd")).groupBy("l_linenumber", "unknown").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("usd"), 6).alias("usd"))


@query("SELECT doc_id, round((ceil(octet_length(encode(text)) / 3.0) * 0.3 + 1000 * 2.5) / 1e6, 9) AS usd FROM documents WHERE text IS NOT NULL")
def worst_charges(t: Tables) -> DataFrame:
    return t.documents.filter("text IS NOT NULL").select("doc_id", F.round(S.worst_cost(F.lit("flash"), F.col("text"), F.lit(1000)), 9).alias("usd"))


# -- texts --------------------------------------------------------------------------------------------------------


@query(r"SELECT doc_id, md5(trim(regexp_replace(lower(strip_accents(text)), '[^\p{L}\p{N}]+', ' ', 'g'))) AS code FROM documents WHERE text IS NOT NULL")
def unaccented_texts(t: Tables) -> DataFrame:
    return t.documents.filter("text IS NOT NULL").select("doc_id", F.md5(X.unaccented(F.col("text")).cast("binary")).alias("code"))


@query(r"""SELECT doc_id, nullif(regexp_replace(regexp_replace(text, '(?m)^##([ \t])', '#-\1', 'g'), '\A[\t\n\v\f\r ]+|[\t\n\v\f\r ]+\z', '', 'g'), '') AS body FROM documents""")
def section_bodies(t: Tables) -> DataFrame:
    """Each whole text as a section between others; a heading of the section's own level within it is written one level apart."""
    body = F.regexp_replace(F.coalesce("text", F.lit("")), r"(?m)^##([ \t])", "#-$1")
    stored = F.concat(F.lit("edited\n\n## Context\n"), body, F.lit("\n\n## Transient\n- x\n"))
    return t.documents.select("doc_id", X.section(stored, "Context").alias("body"))


@query("""WITH x AS (SELECT ['a.b@c.co', '.a@b.co', 'a..b@c.co', 'a@b', 'a b@c.co', 'o''k+x@sub.dom.org', '@b.co', 'a.@b.co'][1 + c_custkey % 8] AS raw FROM customer)
  SELECT raw, raw IN ('a.b@c.co', 'o''k+x@sub.dom.org') AS ok, count(*) AS n FROM x GROUP BY ALL""")
def email_fields(t: Tables) -> DataFrame:
    raw = F.get(F.array(*map(F.lit, ("a.b@c.co", ".a@b.co", "a..b@c.co", "a@b", "a b@c.co", "o'k+x@sub.dom.org", "@b.co", "a.@b.co"))), (F.col("c_custkey") % 8).cast("int"))
    checked = t.customer.select(raw.alias("raw"), validated(F.lit("account"), F.lit("primary_contact_email"), raw).alias("v"))
    return checked.groupBy("raw", F.col("v.ok").alias("ok")).agg(F.count(F.lit(1)).alias("n"))


class FirstWords:
    """A stand-in that answers from the prompt: the deck is a pitch if the text asks anything, its first word is the account."""

    def complete(self, step: str, prompt: str) -> str:
        body = prompt.removeprefix("## text\n")
        words = [w for w in body.replace("\n", " ").split(" ") if w]
        return json.dumps({"deck_type": "pitch" if "?" in body else "other", "account": words[:1], "campaign": words[1:3]})


@query("""WITH x AS (SELECT conv_id, turn, text, list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda w: w <> '') AS w FROM conversations WHERE text IS NOT NULL)
  SELECT conv_id || '-' || turn AS id, CASE WHEN contains(text, '?') THEN 'pitch' ELSE 'other' END AS deck_type, w[1] AS account, CAST(len(w[2:3]) AS INT) AS n_campaign FROM x""")
def interpreted_turns(t: Tables) -> DataFrame:
    """Turns of conversations through prompt, completer and typed reply."""
    rows = t.conversations.filter("text IS NOT NULL").select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), F.lit(None).cast("string").alias("vocabulary"), "text")
    read = read_replies(complete(prompts_of(rows, "interpret"), FirstWords()), "interpret")
    return read.select("id", "deck_type", F.try_element_at("account", F.lit(1)).alias("account"), F.size("campaign").alias("n_campaign"))


@query(f"""SELECT page_id, CASE WHEN page_id % 9 = 0 THEN 'unsupported_mime' WHEN page_id % 9 = 1 THEN 'folder' WHEN page_id % 9 = 2 THEN 'shortcut_unverified_size' WHEN page_id % 9 = 3 AND octet_length(encode(html)) * 100000 > {MAX_BYTES} THEN 'too_large' END AS reason FROM pages""")
def skip_reasons(t: Tables) -> DataFrame:
    k = F.col("page_id") % 9
    pdf = F.lit("application/pdf")
    files = t.pages.select(
        "page_id", F.when(k == 0, "application/zip").when(k == 2, "application/vnd.google-apps.shortcut").when(k == 3, pdf).otherwise("text/html").alias("mime_type"), (F.octet_length("html").cast("long") * 100000).alias("bytes"),
        (k == 1).alias("is_folder"), F.when(k == 2, F.struct(F.lit("x").alias("id"), pdf.alias("mime_type"))).alias("shortcut"),
    ).withColumn("size", F.when(k == 3, F.col("bytes")).otherwise(F.lit(10)))
    return files.select("page_id", skip_reason(MAX_BYTES).alias("reason"))


@query("SELECT p_partkey, array_to_string(list_sort([p_brand, p_type]), '|') AS ids FROM part")
def source_unions(t: Tables) -> DataFrame:
    both = P.source_ids(F.array("p_brand"), F.array("p_type", "p_brand"), F.lit(None).cast("array<string>"))
    return t.part.select("p_partkey", F.array_join(F.array_sort(both), "|").alias("ids"))


# -- resolution ---------------------------------------------------------------------------------------------------


@query("SELECT a.s_suppkey AS id, count(*) AS partners, CAST(1 AS BIGINT) AS most_across FROM supplier a JOIN supplier b ON a.s_suppkey <> b.s_suppkey GROUP BY 1")
def window_coverage(t: Tables) -> DataFrame:
    """Every two suppliers share a window of eight, those of different blocks exactly one."""
    roster = R.placed(t.supplier.select(F.col("s_suppkey").alias("id")), 0)
    return R.coverage(roster, 8, roster.count()).filter("partners > 0")


def same_nation(members: pd.DataFrame) -> pd.DataFrame:
    """A detector that puts together what has the same nation, in each of many windows."""
    nation, every = pd.factorize(members["nation"])
    key = members["window"].to_numpy() * len(every) + nation
    order = np.argsort(np.where(nation < 0, -1, key), kind="stable")
    order = order[(nation < 0).sum() :]
    key = key[order]
    head = np.r_[True, key[1:] != key[:-1]][: len(key)]
    run = np.cumsum(head) - 1
    kept = np.bincount(run)[run] > 1 if len(run) else head
    return pd.DataFrame({"window": members["window"].to_numpy()[order][kept], "position": run[kept], "id": members["id"].to_numpy()[order][kept], "confidence": 0.9})


@query("""WITH n AS (SELECT s_nationkey, min(CAST(s_suppkey AS VARCHAR)) AS component, count(*) AS members FROM supplier GROUP BY 1 HAVING count(*) > 1)
  SELECT CAST(s_suppkey AS VARCHAR) AS node, component, 0.9 AS confidence FROM supplier JOIN n USING (s_nationkey)""")
def clustered_roster(t: Tables) -> DataFrame:
    """Suppliers of a nation as one entity, found in windows of eight by two passes of votes."""
    roster = t.supplier.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_nationkey").alias("nation"), F.lit(None).cast("string").alias("folder_id"), F.lit(None).cast("string").alias("markdown"), F.lit(0).alias("created_at"))
    return R.clustered(roster, same_nation, 8, many=True)


@query("""WITH g AS (SELECT o_orderkey, o_custkey AS user_id, CASE WHEN o_orderkey % 10 < 5 THEN 0 ELSE o_orderkey % 10 END AS entity, o_orderkey % 10 BETWEEN 1 AND 4 AS moved FROM orders)
  SELECT entity, count(DISTINCT CASE WHEN entity = 0 THEN CAST(user_id AS VARCHAR) ELSE 'o' || o_orderkey END) AS n, min(o_orderkey) AS first FROM g GROUP BY 1""")
def redirect_collapse(t: Tables) -> DataFrame:
    """Grants of entities 1 to 4 move to entity 0, where a user keeps one."""
    moves = t.nation.filter("n_nationkey BETWEEN 1 AND 4").select(F.col("n_nationkey").cast("long").alias("variant"), F.lit(0).cast("long").alias("canonical"))
    grants = t.orders.select("o_orderkey", F.col("o_custkey").alias("user_id"), (F.col("o_orderkey") % 10).alias("entity"), F.lit(0).alias("n"))
    once = R.redirected_once(grants.drop("n"), moves, "entity", ["user_id"], [F.col("o_orderkey")])
    first = R.redirected(grants, moves, "entity").groupBy("entity").agg(F.min("o_orderkey").alias("first"))
    return once.groupBy("entity").agg(F.count(F.lit(1)).alias("n")).join(first, "entity").select("entity", "n", "first")


@query("""SELECT n_nationkey AS folder_id, CASE WHEN n_nationkey % 4 = 0 THEN 'existing' WHEN n_nationkey % 4 = 1 THEN 'existing' WHEN n_nationkey % 4 = 2 THEN 'new' ELSE 'other' END AS label,
    CASE WHEN n_nationkey % 4 = 0 THEN 'own' || n_nationkey WHEN n_nationkey % 4 = 1 THEN 'own0' END AS campaign_id FROM nation""")
def repaired_labels(t: Tables) -> DataFrame:
    """Folders of campaigns win, ids that exist stay, ids that do not are demoted to new."""
    k, s = F.col("n_nationkey") % 4, F.col("n_nationkey").cast("string")
    labels = t.nation.select(F.col("n_nationkey").alias("folder_id"), F.when(k == 3, "other").when(k == 0, "new").otherwise("existing").alias("label"), F.when(k == 1, "own0").when(k == 2, "gone").alias("campaign_id"))
    campaigns = t.nation.filter(k == 0).select(F.col("n_nationkey").alias("folder_id"), F.concat(F.lit("own"), s).alias("campaign_id"))
    return R.repaired_labels(labels, labels.select("folder_id"), campaigns)


@query("SELECT c_custkey AS parent_id, o_orderkey AS piece_id, o_orderpriority AS bullet FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority NOT LIKE '1%'")
def absorbed_bullets(t: Tables) -> DataFrame:
    pieces = t.orders.select(F.col("o_custkey").alias("parent_id"), F.col("o_orderkey").alias("piece_id"), F.array("o_orderpriority", "o_orderstatus").alias("bullets"))
    parents = t.customer.select(F.col("c_custkey").alias("parent_id"), F.lit("- 1-URGENT\n- x").alias("body"))
    return R.absorbed(pieces, parents)


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'over' ELSE c_mktsegment END AS v FROM customer UNION ALL SELECT -c_custkey, 'over' FROM customer WHERE c_custkey % 3 = 0""")
def overlay(t: Tables) -> DataFrame:
    rows = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("v"))
    over = t.customer.filter("c_custkey % 3 = 0").select(F.explode(F.array(F.col("c_custkey"), -F.col("c_custkey"))).alias("id"), F.lit("over").alias("v"))
    return R.with_override(rows, over, ["id"])


@query("""WITH r AS (SELECT p_partkey AS id, [p_brand, p_type] AS k FROM part), b AS (SELECT p_partkey AS id, ['x', p_brand] AS k FROM part WHERE p_partkey % 2 = 0)
  SELECT r.id, CAST(len(list_filter(b.k, lambda x: NOT list_contains(r.k, x))) AS INT) AS lost, CAST(len(list_filter(r.k, lambda x: NOT list_contains(b.k, x))) AS INT) AS added FROM r JOIN b USING (id)""")
def changed_keys(t: Tables) -> DataFrame:
    records = t.part.select(F.col("p_partkey").alias("id"), F.array("p_brand", "p_type").alias("keys"))
    base = t.part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("id"), F.array(F.lit("x"), "p_brand").alias("keys"))
    return S.keys_changed(records, base).select("id", F.size("lost").alias("lost"), F.size("added").alias("added"))


# -- change log ---------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_orderstatus <> 'F' AS is_text, o_orderstatus = 'F' AS is_date FROM orders")
def typed_changes(t: Tables) -> DataFrame:
    dated = F.col("o_orderstatus") == "F"
    changes = t.orders.select(F.lit("campaign").alias("entity"), F.col("o_orderkey").alias("entity_id"), F.when(dated, "live_at").otherwise("status").alias("field"), F.when(dated, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("live").alias("value"), F.lit(None).cast("string").alias("current"))
    return C.change_rows(changes).select(F.col("entity_id").alias("o_orderkey"), F.col("value_text").isNotNull().alias("is_text"), F.col("value_date").isNotNull().alias("is_date"))


@query("SELECT CASE WHEN event_type = 'error' THEN 'status' ELSE 'budget' END AS field, count(*) AS n FROM events WHERE event_type = 'error' OR user_id % 2 = 0 GROUP BY 1")
def rescued_notes(t: Tables) -> DataFrame:
    """Invalid changes become notes: unknown states, and budgets that are no positive number."""
    error = F.col("event_type") == "error"
    raw = F.when(error, "unheard of").when(F.col("user_id") % 2 == 0, "-1").otherwise("5")
    proposals = t.events.select(F.lit("campaign").alias("entity"), F.when(error, "status").otherwise("budget").alias("field"), F.lit(None).cast("string").alias("current"), raw.alias("raw"))
    return C.rescued(C.judged(proposals))[1].filter("note LIKE 'Proposed %'").groupBy("field").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH s AS (SELECT l_orderkey AS account, l_partkey AS file_id, bool_or(l_returnflag = 'R') AS ok FROM lineitem GROUP BY ALL), w AS (SELECT l_orderkey AS account, l_partkey AS file_id FROM lineitem WHERE l_linenumber = 1 GROUP BY ALL)
  SELECT CASE WHEN s.ok THEN 'resolved' ELSE 'open' END AS status, w.account IS NULL AS is_new, count(*) AS n FROM s LEFT JOIN w USING (account, file_id) WHERE w.account IS NOT NULL OR NOT s.ok GROUP BY ALL""")
def restricted_files(t: Tables) -> DataFrame:
    seen = t.lineitem.select(F.col("l_orderkey").alias("account"), F.col("l_partkey").alias("file_id"), (F.col("l_returnflag") == "R").alias("ok"))
    work = t.lineitem.filter("l_linenumber = 1").select(F.col("l_orderkey").alias("account"), F.col("l_partkey").alias("file_id")).distinct().select("account", "file_id", F.lit("open").alias("status"), day("1990-01-01").alias("first_seen"), day("1990-01-01").alias("last_seen"))
    updated, _ = C.restricted_worklist(work, seen, day(NOW))
    return updated.groupBy("status", (F.col("first_seen") == day(NOW)).alias("is_new")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT s_suppkey AS group_id, 'name' AS property FROM supplier UNION ALL SELECT s_suppkey, 'status' FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, 'note' FROM supplier WHERE s_suppkey % 3 = 0""")
def new_entities(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    fields = F.create_map(F.lit("status"), F.when(k % 2 == 0, "live").otherwise("unheard of"), F.lit("budget"), F.lit("-1"))
    found = t.supplier.select(k.alias("group_id"), F.col("s_name").alias("name"), F.when(k % 3 == 0, "n").alias("note"), fields.alias("fields"))
    return C.new_entity_rows(found, "campaign").select("group_id", "property")


@query("""WITH l AS (SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM documents)
  SELECT doc_id, count(DISTINCT line) AS facts FROM l WHERE line <> '' AND line NOT LIKE '[new campaign candidate "%' GROUP BY 1""")
def known_facts(t: Tables) -> DataFrame:
    """All lines of all documents as bullets of facts, each once."""
    body = F.array_join(F.transform(F.split("text", "\n"), lambda x: F.concat(F.lit("- "), x)), "\n")
    return C.known_facts(t.documents.select(F.col("doc_id").alias("entity_id"), body.alias("body")))[0].groupBy(F.col("entity_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("facts"))


# -- data sources -------------------------------------------------------------------------------------------------


def exported(t: Tables) -> str:
    """The entries and a feed of changes, an event each, where a connector finds them."""
    scratch = Scratch(t.orders.sparkSession)
    entries = entries_of(t).select(*feed.ENTRY_FIELDS.names)
    feed.write_ordered(entries, "id", f"{scratch.root}/entries")
    file = F.concat(F.lit("o"), (1 + F.get_json_object("props", "$.k").cast("long")).cast("string"))
    feed.write_ordered(t.events.select(F.col("event_id").alias("sequence"), F.col("event_type").alias("kind"), file.alias("id")).join(entries.drop("position"), "id", "left").withColumn("position", F.lit(0).cast("long")).select(*feed.CHANGE_FIELDS.names), "sequence", f"{scratch.root}/changes")
    return scratch.root


@query(f"WITH {ENTRIES} SELECT id, name, size FROM e WHERE parent_id IN ('c1', 'c2', 'n2', 'root')")
def listing_source(t: Tables) -> DataFrame:
    """Four folders through the listing as a data source, which takes the filter."""
    spark = feed.register(t.orders.sparkSession)
    return spark.read.format("siltstone_listing").option("path", exported(t)).load().filter(F.col("parent_id").isin("c1", "c2", "n2", "root")).select("id", "name", "size")


@query("SELECT event_type AS kind, count(*) AS n, count(DISTINCT event_id) AS tokens FROM events WHERE event_id > 0 GROUP BY 1")
def changes_source(t: Tables) -> DataFrame:
    """The change feed as a stream, in two runs of one checkpoint; the second finds nothing new."""
    spark, root = feed.register(t.orders.sparkSession), exported(t)
    for _ in range(2):
        changes = spark.readStream.format("siltstone_changes").option("path", root).load()
        changes.writeStream.format("parquet").option("path", f"{root}/seen").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/seen").groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("sequence").alias("tokens"))


# -- extraction and the table log ---------------------------------------------------------------------------------

TRIMMED = "trim(text, " + " || ".join(f"chr({ord(c)})" for c in SPACE) + ")"


@query(f"""WITH x AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'text/plain' WHEN 1 THEN 'text/markdown' ELSE 'doc' END AS mime, coalesce(text, '') AS text, {TRIMMED.replace('text', "coalesce(text, '')")} AS body FROM documents)
  SELECT doc_id, CASE WHEN mime = 'doc' AND length(text) > 5000 THEN 'too_many_chars' WHEN body = '' THEN 'empty' END AS reason, CASE WHEN body <> '' AND NOT (mime = 'doc' AND length(text) > 5000) THEN md5(body) END AS content_hash FROM x""")
def extracted_documents(t: Tables) -> DataFrame:
    """Documents as files of three kinds, the native ones with a limit of 5,000 characters: reasons, and hashes of the trimmed texts."""
    from siltstone.sources.extraction import MIME

    kind = F.when(F.col("doc_id") % 3 == 0, "text/plain").when(F.col("doc_id") % 3 == 1, "text/markdown").otherwise(MIME["doc"])
    content = F.coalesce("text", F.lit("")).cast("binary")
    files = t.documents.select(F.col("doc_id").cast("string").alias("id"), kind.alias("mime_type"), F.octet_length(content).cast("long").alias("size"), F.lit(False).alias("is_folder"), F.lit(None).cast("struct<id:string,mime_type:string>").alias("shortcut"), content.alias("content"))
    found = extract(files, MAX_BYTES, native_chars=5000, readers={MIME["doc"]: lambda c: c.decode("utf-8", "replace")})
    return found.select(F.col("id").cast("long").alias("doc_id"), "reason", F.md5(F.col("text").cast("binary")).alias("content_hash"))


ORDER_STATES = ("F", "O", "P")


def replayed(t: Tables) -> TableLog:
    """The orders, as they are closed, open and pending, as three updates of one table: the latest order of each customer."""
    log = TableLog(t.orders.sparkSession, Scratch(t.orders.sparkSession).root)
    for step, kind in enumerate(ORDER_STATES):
        rows = t.orders.filter(F.col("o_orderstatus") == kind).select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
        log.upsert("orders", rows, ["o_custkey"], ["day", "o_orderkey"], 8, once=("replay", step))
        log.upsert("orders", rows, ["o_custkey"], ["day", "o_orderkey"], 8, once=("replay", step))  # a step that comes again changes nothing
    return log


@query("SELECT o_custkey, arg_max(o_orderkey, (CAST(o_orderdate AS DATE), o_orderkey)) AS o_orderkey, CAST(max(o_orderdate) AS DATE) AS day FROM orders GROUP BY 1")
def replayed_updates(t: Tables) -> DataFrame:
    return replayed(t).read("orders")


@query("""WITH v AS (SELECT * FROM (VALUES (1, 'F'), (2, 'O'), (3, 'P')) x(version, status)), o AS (SELECT version, o_custkey, arg_max(o_orderkey, (CAST(o_orderdate AS DATE), o_orderkey)) AS k FROM orders JOIN v ON o_orderstatus <= status GROUP BY ALL)
  SELECT version, count(*) AS customers, CAST(sum(k) AS BIGINT) AS keys FROM o GROUP BY 1""")
def table_versions(t: Tables) -> DataFrame:
    """What the table of ``replayed_updates`` held after each update."""
    log = replayed(t)
    each = [log.read("orders", v).agg(F.lit(v).alias("version"), F.count(F.lit(1)).alias("customers"), F.sum("o_orderkey").alias("keys")) for v in log.versions()]
    return reduce(DataFrame.unionByName, each)


# -- codecs, messages and notes -----------------------------------------------------------------------------------


@query("""WITH e AS (SELECT ts, user_id, CASE event_type WHEN 'purchase' THEN 'Edit' WHEN 'signup' THEN 'CREATE' ELSE event_type END AS a, json_extract_string(props, '$.k') AS k FROM events),
  x AS (SELECT ts, user_id, unnest([a, 'Rename']) AS a, k FROM e), y AS (SELECT ts, user_id, a, unnest(['items/' || k, 'other/' || k]) AS target FROM x)
  SELECT CAST(ts AS DATE) AS day, CASE WHEN lower(a) IN ('edit', 'create', 'rename') THEN lower(a) ELSE 'other' END AS action, regexp_replace(target, '^items/', '') AS file_id, count(*) AS n, count(DISTINCT user_id) AS actors FROM y GROUP BY ALL""")
def exploded_activity(t: Tables) -> DataFrame:
    """Each event as an activity of two actions on two targets."""
    k = F.get_json_object("props", "$.k")
    action = F.when(F.col("event_type") == "purchase", "Edit").when(F.col("event_type") == "signup", "CREATE").otherwise(F.col("event_type"))
    raw = t.events.select("ts", F.col("user_id").alias("actor"), F.array(action, F.lit("Rename")).alias("actions"), F.array(F.concat(F.lit("items/"), k), F.concat(F.lit("other/"), k)).alias("targets"))
    return A.exploded(raw).groupBy(F.to_date("ts").alias("day"), "action", "file_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("actor").alias("actors"))


@query("SELECT DISTINCT CAST(ts AS DATE) AS day, CAST(json_extract(props, '$.k') AS BIGINT) AS file_id, 2 * CAST(json_extract(props, '$.k') AS BIGINT) AS size FROM events")
def day_codec(t: Tables) -> DataFrame:
    """The files of each day, stored each once with lists of ids by day, and read back."""
    file = F.get_json_object("props", "$.k").cast("long")
    files, days = sinks.encode_days(t.events.select(F.to_date("ts").alias("day"), file.alias("file_id"), (2 * file).alias("size")).distinct())
    return sinks.decode_days(files, days).select("day", "file_id", "size")


@query("""WITH p AS (SELECT 'r' || o_custkey || '@x.co' AS reviewer, CASE o_orderstatus WHEN 'F' THEN 'field_change' WHEN 'O' THEN 'additional_update' ELSE 'new_entity' END AS kind, o_orderpriority AS g FROM orders),
  c AS (SELECT reviewer, count(*) FILTER (kind = 'field_change') AS field_change, count(*) FILTER (kind = 'additional_update') AS additional_update, count(*) FILTER (kind = 'new_entity') AS new_entity, count(DISTINCT CASE WHEN kind = 'new_entity' THEN g END) AS groups FROM p GROUP BY 1)
  SELECT reviewer AS "to", concat_ws(chr(10), CASE WHEN field_change > 0 THEN field_change || ' field change' END, CASE WHEN additional_update > 0 THEN additional_update || ' additional update' END, CASE WHEN new_entity > 0 THEN new_entity || ' new entity' END) AS body, groups FROM c""")
def digest_messages(t: Tables) -> DataFrame:
    """Orders as proposals that their customer reviews."""
    kind = F.when(F.col("o_orderstatus") == "F", "field_change").when(F.col("o_orderstatus") == "O", "additional_update").otherwise("new_entity")
    rows = t.orders.select(F.concat(F.lit("r"), F.col("o_custkey").cast("string"), F.lit("@x.co")).alias("reviewer_email"), kind.alias("kind"), F.col("o_orderpriority").alias("group_id"))
    return sinks.digests(rows).select("to", "body", "groups")


@query("""WITH n AS (SELECT p_partkey, p_name, p_brand, CASE WHEN p_size > 25 THEN '[new campaign candidate "' || p_name || '"] ' || p_type ELSE p_type END AS note FROM part)
  SELECT p_partkey, note LIKE '[new campaign candidate "%' AS marked, CASE WHEN note LIKE '[new campaign candidate "%' THEN substr(note, length(p_name) + 29) END AS own, CAST(NULL AS VARCHAR) AS others FROM n""")
def marked_notes(t: Tables) -> DataFrame:
    """Types of large parts as notes on a candidate that is named like the part; the mark of another name stays."""
    note = F.when(F.col("p_size") > 25, F.concat(X.candidate_marker(F.col("p_name")), F.lit(" "), "p_type")).otherwise(F.col("p_type"))
    return t.part.select("p_partkey", X.is_candidate(note).alias("marked"), X.strip_candidate(note, F.col("p_name")).alias("own"), X.strip_candidate(note, F.col("p_brand")).alias("others"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def chatty_replies(t: Tables) -> DataFrame:
    """The properties of events as replies in a fence, after other words, or bare."""
    text = F.when(F.col("value") > 100, F.concat(F.lit("Here it is:\n```json\n"), "props", F.lit("\n```\nDone."))).when(F.col("value") > 50, F.concat(F.lit("So: "), "props", F.lit("."))).otherwise(F.col("props"))
    return t.events.select("event_id", F.get_json_object(X.json_body(text), "$.k").cast("long").alias("k"))


@query("""WITH l AS (SELECT l_orderkey, string_agg(l_partkey || chr(9) || l_suppkey, chr(10) ORDER BY l_partkey, l_suppkey) AS rows_ FROM lineitem GROUP BY 1)
  SELECT o_orderkey, md5(o_orderpriority || chr(10) || rows_) AS document, md5(CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority || chr(10) || '[Notes]' || chr(10) || o_orderstatus || chr(10) || chr(10) END || rows_) AS slides,
    md5('# ' || o_orderpriority || chr(10) || rows_ || chr(10) || chr(10) || '# again' || chr(10) || rows_) AS sheets FROM orders JOIN l ON l_orderkey = o_orderkey""")
def flattened_orders(t: Tables) -> DataFrame:
    """Orders as documents of a paragraph and a table, as slides of which pending ones are hidden, and as sheets."""
    table = F.array_sort(F.collect_list(F.struct("l_partkey", "l_suppkey")))
    lines = t.lineitem.groupBy("l_orderkey").agg(F.transform(table, lambda x: F.array(x["l_partkey"].cast("string"), x["l_suppkey"].cast("string"))).alias("rows"))
    o = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    none = F.lit(None).cast("array<array<string>>")
    blocks = F.array(F.struct(F.lit("paragraph").alias("kind"), F.col("o_orderpriority").alias("text"), none.alias("rows")), F.struct(F.lit("table").alias("kind"), F.lit(None).cast("string").alias("text"), "rows"))
    text = F.array_join(F.transform("rows", lambda r: F.array_join(r, "\t")), "\n")
    slides = F.array(F.struct((F.col("o_orderstatus") == "P").alias("hidden"), F.col("o_orderpriority").alias("body"), F.col("o_orderstatus").alias("notes")), F.struct(F.lit(None).cast("boolean").alias("hidden"), text.alias("body"), F.lit(" ").alias("notes")))
    sheets = F.array(F.struct(F.col("o_orderpriority").alias("title"), "rows"), F.struct(F.lit("again").alias("title"), "rows"))
    code = lambda c: F.md5(c.cast("binary"))
    return o.select("o_orderkey", code(paragraphs_text(blocks)).alias("document"), code(slides_text(slides)).alias("slides"), code(sheets_text(sheets)).alias("sheets"))
