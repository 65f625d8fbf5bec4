"""Matching, resolution, change log, lifecycle and scores on stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltstone.functions import json as J
from siltstone.functions.text import job_number
from siltstone.operators import changes as C, lifecycle as L, matching as M, reports as P, resolution as R, scores as S
from siltstone.plans.registry import Tables, query
from siltstone.sources.scratch import Scratch

NOW = "1997-06-15"


def now():
    return F.lit(NOW + " 00:00:00").cast("timestamp_ntz")


NORM = "lower(regexp_replace(trim(name), '\\s+', ' ', 'g'))"


def known_names(t: Tables) -> DataFrame:
    return t.part.groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("position"))


def emitted_names(t: Tables) -> DataFrame:
    """Part names with one character left out, by the part's key; upper case for every third."""
    at = F.col("p_partkey") % F.length("p_name") + 1
    short = F.concat(F.substr("p_name", F.lit(1), (at - 1).cast("int")), F.substr("p_name", (at + 1).cast("int"), F.length("p_name")))
    return t.part.select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).otherwise(short).alias("name"))


@query(f"""WITH e AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE substr(p_name, 1, p_partkey % length(p_name)) || substr(p_name, p_partkey % length(p_name) + 2) END AS name FROM part),
  k AS (SELECT p_name AS matched, min(p_partkey) AS position, lower(p_name) AS k FROM part GROUP BY 1), x AS (SELECT p_partkey, name, {NORM} AS e FROM e),
  p AS (SELECT p_partkey, matched, position, e = k AS same, 1 - levenshtein(e, k) / greatest(length(e), length(k)) AS sim FROM x, k),
  b AS (SELECT p_partkey, arg_max((matched, same, sim), (same, round(sim, 9), -position)) AS best FROM p WHERE sim >= 0.85 GROUP BY 1)
  SELECT x.p_partkey, best[1] AS matched, CASE WHEN best[2] THEN 'exact' WHEN best IS NOT NULL THEN 'levenshtein' END AS via, round(best[3], 6) AS similarity FROM x LEFT JOIN b USING (p_partkey)""")
def fuzzy_match(t: Tables) -> DataFrame:
    found = M.match_names(emitted_names(t), known_names(t))
    return found.select("p_partkey", "matched", "via", F.round("similarity", 6).alias("similarity"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'ACME' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') END AS job FROM part")
def job_numbers(t: Tables) -> DataFrame:
    code = F.concat(F.lit("Spring ["), F.when(F.col("p_partkey") % 2 == 0, "ACME").otherwise("acme"), F.lpad(F.col("p_partkey").cast("string"), 6, "0"), F.lit("] film"))
    return t.part.select("p_partkey", job_number(code).alias("job"))


@query("SELECT n, CAST(n AS BIGINT) * (n - 1) / 2 AS pairs, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS twice_across FROM (SELECT count(*) AS n FROM nation)")
def pair_coverage(t: Tables) -> DataFrame:
    n = t.nation.count()
    roster = t.nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_nationkey").alias("place"))
    met = R.paired(roster, 8, n)
    across = met.join(roster.select(F.col("id").alias("a"), F.floor(F.col("place") / 4).alias("x")), "a").join(roster.select(F.col("id").alias("b"), F.floor(F.col("place") / 4).alias("y")), "b")
    counts = across.agg(F.count(F.lit(1)).alias("met"), F.count_if((F.col("x") != F.col("y")) & (F.col("windows") > 1)).alias("twice_across"))
    return counts.select(F.lit(n).cast("long").alias("n"), (F.lit(n) * (n - 1) / 2).alias("pairs"), (F.lit(n * (n - 1) // 2) - F.col("met")).cast("long").alias("missing"), "twice_across")


LINKS = """d AS (SELECT doc_id, md5(text) AS h, md5(string_split(text, chr(10))[1]) AS first_line FROM documents WHERE length(text) > 0),
  e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM d a JOIN d b ON a.doc_id < b.doc_id AND (a.h = b.h OR a.first_line = b.first_line)), pairs AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e)"""


@query(f"WITH RECURSIVE {LINKS}, r(node, top) AS (SELECT a, a FROM pairs UNION SELECT r.node, x.b FROM r JOIN pairs x ON x.a = r.top) SELECT node, min(top) AS component FROM r GROUP BY node")
def vote_components(t: Tables) -> DataFrame:
    docs = t.documents.filter(F.length("text") > 0)
    keyed = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("k")).unionByName(docs.select("doc_id", F.concat(F.lit("1"), F.md5(F.split("text", "\n")[0].cast("binary"))).alias("k")))
    centre = keyed.groupBy("k").agg(F.min("doc_id").alias("b"))
    pairs = keyed.join(centre, "k").filter("doc_id > b").select(F.col("doc_id").alias("a"), "b", F.lit(2).alias("votes"), F.lit(0.9).alias("confidence"))
    return R.vote_components(pairs).select("node", "component")


@query("""WITH c AS (SELECT 'c' || (p_partkey % 400) AS canonical, 'c' || (p_partkey * 7 % 400) AS variant, 0.5 + (p_size % 50) / 100.0 AS confidence FROM part)
  SELECT least(canonical, variant) AS a, greatest(canonical, variant) AS b, count(*) AS votes, round(max(confidence), 4) AS confidence FROM c GROUP BY ALL""")
def vote_tally(t: Tables) -> DataFrame:
    name = lambda c: F.concat(F.lit("c"), c.cast("string"))
    clusters = t.part.select(name(F.col("p_partkey") % 400).alias("canonical"), F.array(name(F.col("p_partkey") * 7 % 400)).alias("kept"), (0.5 + (F.col("p_size") % 50) / 100.0).alias("confidence"), F.lit(None).cast("string").alias("dropped"))
    return R.votes(clusters).withColumn("confidence", F.round(F.col("confidence").cast("double"), 4))


@query("""SELECT o_custkey AS cluster, CAST(year(o_orderdate) AS INT) AS year, count(*) AS members, min(o_orderkey) AS first FROM orders GROUP BY 1, 2 HAVING count(*) >= 2""")
def year_gate(t: Tables) -> DataFrame:
    members = t.orders.select(F.col("o_custkey").alias("cluster"), F.col("o_orderkey").alias("id"), F.concat(F.lit("Work / "), F.year("o_orderdate").cast("string"), F.lit(" / x")).alias("path"))
    return R.year_gate(members)


@query("""WITH y AS (SELECT o_custkey AS cluster, count(*) AS members, count(DISTINCT year(o_orderdate)) AS years, bool_or(o_orderpriority = '1-URGENT') AS failed FROM orders GROUP BY 1)
  SELECT CASE WHEN failed THEN 'failed' WHEN members < 2 THEN 'single' WHEN years > 1 THEN 'split_by_year' WHEN years = 0 THEN 'year_unknown' ELSE 'merged' END AS outcome, count(*) AS n FROM y GROUP BY 1""")
def merge_outcomes(t: Tables) -> DataFrame:
    clusters = t.orders.groupBy(F.col("o_custkey").alias("cluster")).agg(F.count(F.lit(1)).alias("members"), F.countDistinct(F.year("o_orderdate")).alias("years"), F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("failed"))
    return R.merge_outcomes(clusters).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_custkey AS cluster, arg_min(o_orderkey, (o_orderstatus <> 'F', o_orderpriority = '5-LOW', o_orderdate, o_orderkey)) AS canonical, count(*) AS members FROM orders GROUP BY 1""")
def canonical_pick(t: Tables) -> DataFrame:
    members = t.orders.select(F.col("o_custkey").alias("cluster"), F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", "f").alias("folder_id"), F.when(F.col("o_orderpriority") != "5-LOW", "m").alias("markdown"), F.col("o_orderdate").alias("created_at"))
    return R.canonical(members, ["cluster"])


@query("""SELECT o_custkey AS user_id, arg_min(o_orderkey, (-(CASE WHEN o_orderstatus = 'O' THEN 100 ELSE 0 END + CAST(left(o_orderpriority, 1) AS INT)), o_orderkey % 2 <> 0, o_orderkey)) AS grant_id, count(*) AS grants FROM orders GROUP BY 1""")
def grant_survivor(t: Tables) -> DataFrame:
    grants = t.orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("grant_id"), (F.col("o_orderstatus") == "O").alias("active"), F.left("o_orderpriority", F.lit(1)).cast("int").alias("role_rank"), (F.col("o_orderkey") % 2 == 0).alias("is_canonical"))
    return R.grant_survivors(grants)


@query("SELECT n_regionkey * 0 + CASE WHEN c_nationkey < 10 THEN 0 ELSE c_nationkey END AS nation, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def redirect_merge(t: Tables) -> DataFrame:
    moves = t.nation.filter("n_nationkey BETWEEN 1 AND 9").select(F.col("n_nationkey").alias("variant"), F.lit(0).alias("canonical"))
    return R.redirected(t.customer.select("c_custkey", "c_nationkey"), moves, "c_nationkey").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0) GROUP BY 1")
def scoped_wipe(t: Tables) -> DataFrame:
    gone = t.customer.filter("c_acctbal < 0").select("c_custkey")
    return R.without(t.orders, gone, "o_custkey").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'phantom:unknown ' || c_custkey % 3 WHEN c_custkey % 5 = 1 THEN 'existing:' || lower(c_mktsegment) WHEN c_custkey % 5 = 2 THEN 'existing:c9'
    WHEN c_custkey % 5 = 3 THEN 'new:folder' || c_nationkey END AS bucket, CASE c_custkey % 5 WHEN 0 THEN 'phantom' WHEN 1 THEN 'tag-exact' WHEN 2 THEN 'folder' WHEN 3 THEN 'folder' ELSE 'discard' END AS via FROM customer""")
def bucket_routing(t: Tables) -> DataFrame:
    k, s = F.col("c_custkey") % 5, F.col("c_nationkey").cast("string")
    obs = t.customer.select(
        "c_custkey", F.when(k == 0, F.concat(F.lit("Unknown "), (F.col("c_custkey") % 3).cast("string"))).when(k == 1, F.concat(F.lit(" "), F.col("c_mktsegment"))).when(k == 2, " ").alias("tag"),
        F.when(k == 4, "account").otherwise("campaign").alias("owner_type"), F.concat(F.lit("folder"), s).alias("folder_id"), F.when(k == 2, "c9").alias("campaign_id"), F.when(k == 2, "existing").otherwise("new").alias("status"),
    )
    segments = t.customer.groupBy(F.col("c_mktsegment").alias("name")).agg(F.min("c_custkey").alias("position"))
    directory = R.name_directory(segments.select("name", F.lit("existing").alias("kind"), F.lower("name").alias("target")))
    tags = obs.select(F.trim("tag").alias("name")).filter("name <> ''").distinct()
    return R.routed(obs, M.match_names(tags, segments), directory).select("c_custkey", "bucket", "via")


@query("""WITH p AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'status' WHEN 1 THEN 'budget' WHEN 2 THEN 'live_at' ELSE 'owner' END AS field,
    CASE event_id % 4 WHEN 0 THEN CASE WHEN event_type = 'view' THEN 'live' WHEN event_type = 'click' THEN '' ELSE event_type END WHEN 1 THEN CAST(user_id - 10 AS VARCHAR) WHEN 2 THEN CASE WHEN user_id % 2 = 0 THEN '2024-01-05' ELSE 'soon' END ELSE 'x' END AS raw FROM events)
  SELECT field, CASE field WHEN 'status' THEN raw IN ('live', '') WHEN 'budget' THEN CAST(raw AS INT) > 0 WHEN 'live_at' THEN raw <> 'soon' ELSE false END AS ok, count(*) AS n FROM p GROUP BY ALL""")
def validate_fields(t: Tables) -> DataFrame:
    k, kind = F.col("event_id") % 4, F.col("event_type")
    field = F.when(k == 0, "status").when(k == 1, "budget").when(k == 2, "live_at").otherwise("owner")
    raw = F.when(k == 0, F.when(kind == "view", "live").when(kind == "click", "").otherwise(kind)).when(k == 1, (F.col("user_id") - 10).cast("string")).when(k == 2, F.when(F.col("user_id") % 2 == 0, "2024-01-05").otherwise("soon")).otherwise("x")
    proposals = t.events.select(F.lit("campaign").alias("entity"), field.alias("field"), F.lit(None).cast("string").alias("current"), raw.alias("raw"))
    return C.judged(proposals).groupBy("field", "ok").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'industry' ELSE 'status' END AS field, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'active' END AS current,
    CASE WHEN c_custkey % 2 = 0 THEN ' ' || lower(c_mktsegment) ELSE CASE WHEN c_custkey % 3 = 0 THEN 'active' ELSE 'inactive' END END AS raw FROM customer)
  SELECT field, CASE field WHEN 'industry' THEN lower(trim(current)) = lower(trim(raw)) ELSE current = raw END AS noop, count(*) AS n FROM p GROUP BY ALL""")
def noop_filter(t: Tables) -> DataFrame:
    even = F.col("c_custkey") % 2 == 0
    raw = F.when(even, F.concat(F.lit(" "), F.lower("c_mktsegment"))).otherwise(F.when(F.col("c_custkey") % 3 == 0, "active").otherwise("inactive"))
    proposals = t.customer.select(F.lit("account").alias("entity"), F.when(even, "industry").otherwise("status").alias("field"), F.when(even, F.col("c_mktsegment")).otherwise("active").alias("current"), raw.alias("raw"))
    return C.judged(proposals).groupBy("field", "noop").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH pending AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P' AND o_orderdate + INTERVAL 400 DAY > TIMESTAMP '{NOW}')
  SELECT o_orderkey FROM orders o WHERE o_orderstatus = 'O' AND NOT EXISTS (SELECT 1 FROM pending p WHERE p.o_custkey = o.o_custkey AND p.o_orderpriority = o.o_orderpriority)""")
def duplicate_guard(t: Tables) -> DataFrame:
    pending = C.with_expiry(t.orders.filter("o_orderstatus = 'P'"), F.col("o_orderdate"), 400).withColumn("state", F.lit("pending"))
    return C.not_pending(t.orders.filter("o_orderstatus = 'O'"), pending, ["o_custkey", "o_orderpriority"], now()).select("o_orderkey")


@query("SELECT c_custkey AS account_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus IN ('P', 'O') AND o_custkey IS NOT NULL)")
def in_flight_skip(t: Tables) -> DataFrame:
    queue = t.orders.select(F.col("o_custkey").alias("account_id"), F.element_at(F.create_map(*map(F.lit, ("P", "pending", "O", "running", "F", "completed"))), F.col("o_orderstatus")).alias("status"))
    return L.not_in_flight(t.customer.select(F.col("c_custkey").alias("account_id")), queue)


@query(f"SELECT CASE WHEN o_orderstatus = 'O' AND o_orderdate + INTERVAL 30 DAY < TIMESTAMP '{NOW}' THEN 'expired' WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'applied' END AS state, count(*) AS n FROM orders GROUP BY 1")
def expiry_sweep(t: Tables) -> DataFrame:
    proposals = C.with_expiry(t.orders, F.col("o_orderdate"), 30).withColumn("state", F.when(F.col("o_orderstatus") == "O", "pending").otherwise("applied"))
    return L.swept(proposals, now()).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


QUEUE = f"""q AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'O' THEN 'running' ELSE 'completed' END AS status, o_orderdate AS requested_at, o_orderdate AS started_at,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 1000 DAY END AS last_heartbeat_at, CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL 500 DAY END AS next_attempt_at, CAST(o_orderkey % 4 AS INT) AS attempts FROM orders)"""


def queue_of(t: Tables) -> DataFrame:
    status = F.element_at(F.create_map(*map(F.lit, ("P", "pending", "O", "running", "F", "completed"))), F.col("o_orderstatus"))
    later = lambda days: F.col("o_orderdate") + F.make_dt_interval(F.lit(days))
    return t.orders.select(F.col("o_orderkey").alias("id"), status.alias("status"), F.col("o_orderdate").alias("requested_at"), F.col("o_orderdate").alias("started_at"), F.when(F.col("o_orderkey") % 3 == 0, later(1000)).alias("last_heartbeat_at"), F.when(F.col("o_orderkey") % 2 == 0, later(500)).alias("next_attempt_at"), (F.col("o_orderkey") % 4).cast("int").alias("attempts"))


@query(f"WITH {QUEUE} SELECT CASE WHEN status = 'running' AND coalesce(last_heartbeat_at, started_at) < TIMESTAMP '{NOW}' - INTERVAL 15 MINUTE THEN 'pending' ELSE status END AS status, count(*) AS n FROM q GROUP BY 1")
def stale_reclaim(t: Tables) -> DataFrame:
    return L.reclaimed(queue_of(t), now()).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {QUEUE} SELECT id, CAST(requested_at AS DATE) AS requested FROM q WHERE status = 'pending' AND (next_attempt_at IS NULL OR next_attempt_at <= TIMESTAMP '{NOW}') ORDER BY requested_at, id LIMIT 1")
def fifo_claim(t: Tables) -> DataFrame:
    return L.next_claim(queue_of(t), now()).select("id", F.to_date("requested_at").alias("requested"))


@query(f"WITH {QUEUE} SELECT CAST(epoch(min(next_attempt_at)) - epoch(TIMESTAMP '{NOW}') AS BIGINT) AS seconds FROM q WHERE status = 'pending' AND next_attempt_at > TIMESTAMP '{NOW}'")
def next_wait(t: Tables) -> DataFrame:
    return L.next_wait(queue_of(t), now())


@query(f"""WITH {QUEUE} SELECT CASE WHEN id % 5 = 0 AND id % 10 = 0 AND attempts < 3 THEN 'pending' WHEN id % 5 = 0 THEN 'failed' ELSE status END AS status,
  sum(CASE WHEN id % 10 = 0 AND attempts < 3 THEN CAST(least(60 * pow(2, greatest(attempts, 1) - 1), 3600) AS INT) ELSE 0 END) AS waits, count(*) AS n FROM q GROUP BY 1""")
def retry_or_fail(t: Tables) -> DataFrame:
    queue = queue_of(t).withColumn("next_attempt_at", F.lit(None).cast("timestamp_ntz")).withColumn("error_message", F.lit(None).cast("string"))
    failures = queue.filter("id % 5 = 0").select("id", F.lit("e").alias("error"), (F.col("id") % 10 == 0).alias("transient"))
    after = L.failed_once_more(queue, failures, now())
    wait = F.coalesce(F.unix_seconds(F.col("next_attempt_at").cast("timestamp")) - F.unix_seconds(now().cast("timestamp")), F.lit(0))
    return after.groupBy("status").agg(F.sum(wait).alias("waits"), F.count(F.lit(1)).alias("n"))


@query(f"""SELECT CASE WHEN o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '{NOW}' - INTERVAL 24 HOUR THEN 'failed' WHEN o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '{NOW}' - INTERVAL 60 MINUTE THEN 'failed'
  WHEN o_orderstatus = 'O' THEN 'running' WHEN o_orderstatus = 'P' THEN 'paused' ELSE 'done' END AS status, count(*) AS n FROM orders GROUP BY 1""")
def reaper(t: Tables) -> DataFrame:
    status = F.element_at(F.create_map(*map(F.lit, ("P", "paused", "O", "running", "F", "done"))), F.col("o_orderstatus"))
    runs = t.orders.select(status.alias("status"), F.col("o_orderdate").alias("started_at"), F.col("o_orderdate").alias("paused_at"))
    return L.reaped(runs, now()).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {QUEUE} SELECT CAST(CASE WHEN bool_or(status = 'pending' AND attempts > 0) THEN 1 ELSE 0 END AS INT) AS exit_code FROM q")
def exit_gate(t: Tables) -> DataFrame:
    return L.exit_code(queue_of(t))


@query("SELECT quality AS gold, toxic AS predicted, count(*) AS n FROM labels GROUP BY ALL")
def confusion(t: Tables) -> DataFrame:
    return S.confusion(t.labels, "quality", "toxic")


@query("""WITH c AS (SELECT lang, count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS tp, count(*) FILTER (WHERE quality <> 1 AND toxic = 0) AS fp, count(*) FILTER (WHERE quality = 1 AND toxic <> 0) AS fn FROM labels JOIN documents USING (doc_id) GROUP BY lang)
  SELECT lang, tp, fp, fn, round(tp / nullif(tp + fp, 0), 9) AS precision, round(tp / nullif(tp + fn, 0), 9) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 9) AS f1 FROM c""")
def prf1(t: Tables) -> DataFrame:
    pairs = t.labels.join(t.documents.select("doc_id", "lang"), "doc_id")
    scored = S.prf1(pairs, F.col("quality") == 1, F.col("toxic") == 0, F.col("lang"))
    return scored.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query("SELECT event_type AS tag, count(*) AS calls, sum(user_id) AS prompt_tokens, sum(event_id) AS output_tokens FROM events GROUP BY 1")
def token_totals(t: Tables) -> DataFrame:
    return S.token_totals(t.events.select(F.col("event_type").alias("tag"), F.col("user_id").alias("prompt_tokens"), F.col("event_id").alias("output_tokens")))


@query("SELECT l_returnflag AS phase, sum(l_linenumber) AS amount, round(sum(l_linenumber) / sum(sum(l_linenumber)) OVER (), 9) AS share FROM lineitem GROUP BY 1")
def phase_shares(t: Tables) -> DataFrame:
    return S.shares(t.lineitem.select(F.col("l_returnflag").alias("phase"), "l_linenumber"), "phase", "l_linenumber").withColumn("share", F.round("share", 9))


@query("""WITH r AS (SELECT l_returnflag AS kind, l_linestatus AS arm, l_orderkey AS record, max(l_linenumber) AS label, CAST(sum(l_quantity) AS DOUBLE) AS value FROM lineitem GROUP BY ALL)
  SELECT r.kind, r.arm, count(*) AS records, round(avg(r.value), 6) AS mean_value, count(*) FILTER (WHERE r.label = b.label) AS agreed, round(avg(r.value - b.value), 6) AS mean_difference
  FROM r LEFT JOIN (SELECT * FROM r WHERE arm = 'F') b ON r.kind = b.kind AND r.record = b.record GROUP BY ALL""")
def paired_comparison(t: Tables) -> DataFrame:
    results = t.lineitem.groupBy(F.col("l_returnflag").alias("kind"), F.col("l_linestatus").alias("arm"), F.col("l_orderkey").alias("record")).agg(F.max("l_linenumber").alias("label"), F.sum("l_quantity").alias("value"))
    return S.compared(results, "F").withColumns({c: F.round(c, 6) for c in ("mean_value", "mean_difference")})


@query("""WITH d AS (SELECT l_suppkey AS account, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS position,
    'k' || (l_suppkey % 40) AS cluster, l_linenumber = 1 AS creates, CASE WHEN l_partkey % 9 > 0 THEN l_partkey % 50 END AS key FROM lineitem),
  j AS (SELECT *, last_value(CASE WHEN creates THEN {'k': key} END IGNORE NULLS) OVER (PARTITION BY account, cluster ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS target,
    coalesce(sum(CASE WHEN creates THEN 1 ELSE 0 END) OVER (PARTITION BY account, key ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM d),
  c AS (SELECT account, count(*) AS decisions, count(*) FILTER (WHERE NOT creates AND key = target.k) AS correct, count(*) FILTER (WHERE NOT creates AND key <> target.k) AS false_merges,
    count(*) FILTER (WHERE NOT creates AND (key IS NULL OR target.k IS NULL)) AS unscored, count(*) FILTER (WHERE creates AND key IS NOT NULL AND earlier > 0) AS missed FROM j GROUP BY account)
  SELECT *, round(false_merges / nullif(correct + false_merges, 0), 9) AS false_merge_rate FROM c""")
def merge_scoring(t: Tables) -> DataFrame:
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    decisions = t.lineitem.select(
        F.col("l_suppkey").alias("account"), F.struct(*order).alias("position"), F.concat(F.lit("k"), (F.col("l_suppkey") % 40).cast("string")).alias("cluster"),
        F.when(F.col("l_linenumber") == 1, "create").otherwise("merge").alias("action"), F.when(F.col("l_partkey") % 9 > 0, F.col("l_partkey") % 50).alias("key"),
    )
    return S.merge_score(decisions).withColumn("false_merge_rate", F.round("false_merge_rate", 9))


SAID = "trim(regexp_replace(lower(strip_accents({0})), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))".format
GRAMS = "list_distinct(flatten(list_transform(list_filter({0}, lambda w: w <> ''), lambda w: list_transform(range(1, len(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))".format
RUNS = "CASE WHEN len({0}) >= 5 THEN list_distinct(list_transform(range(1, len({0}) - 3), lambda i: array_to_string({0}[i : i + 4], ' '))) ELSE [] END".format


@query(f"""WITH RECURSIVE x AS MATERIALIZED (SELECT e, {GRAMS('w')} AS a, {RUNS('w')} AS r FROM (SELECT doc_id AS e, list_filter(string_split({SAID('text')}, ' '), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL)),
  y AS MATERIALIZED (SELECT g, {GRAMS('w')} AS b, {RUNS('w')} AS s FROM (SELECT item_id AS g, list_filter(string_split({SAID('text')}, ' '), lambda w: w <> '') AS w FROM benchmark WHERE text IS NOT NULL)),
  c AS (SELECT e, g, len(list_intersect(a, b)) AS n, len(a) + len(b) AS every_, len(list_intersect(r, s)) AS held, len(s) AS runs FROM x, y),
  o AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY score DESC, e, g) AS i FROM (SELECT e, g, greatest(CASE WHEN every_ > n THEN n / (every_ - n) ELSE 0 END, CASE WHEN runs > 0 THEN held / runs ELSE 0 END) AS score FROM c) WHERE score >= 0.3),
  walk(i, es, gs, hit) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]), FALSE UNION ALL
    SELECT i, CASE WHEN free THEN list_append(es, e) ELSE es END, CASE WHEN free THEN list_append(gs, g) ELSE gs END, free FROM (SELECT o.i, es, gs, e, g, NOT list_contains(es, e) AND NOT list_contains(gs, g) AS free FROM walk JOIN o ON o.i = walk.i + 1)),
  h AS (SELECT e, g FROM walk JOIN o USING (i) WHERE hit)
  SELECT 'all' AS deck, e, g, score, hit, NOT hit AND e NOT IN (SELECT e FROM h) AND g IN (SELECT g FROM h) AS duplicate FROM o JOIN walk USING (i)""")
def greedy_assign(t: Tables) -> DataFrame:
    """Benchmark passages against all documents, by their whole texts: one-to-one, best first."""
    gold, found = t.benchmark.select(F.col("item_id").alias("g"), "text"), t.documents.select(F.col("doc_id").alias("e"), "text")
    return M.assign(M.passage_scores(found, gold, 0.3).withColumn("deck", F.lit("all")), 0.3)


@query("""WITH o AS (SELECT o_custkey AS account, o_orderkey AS position, o_orderpriority || ' ' || o_orderstatus AS name, o_orderpriority AS p, CAST(year(o_orderdate) AS VARCHAR) AS y FROM orders),
  f AS (SELECT *, min(position) OVER (PARTITION BY account, name) AS born, position = min(position) OVER (PARTITION BY account, name, y) AS fresh FROM o),
  b AS (SELECT account, name, CAST(row_number() OVER (PARTITION BY account ORDER BY min(position)) AS INT) AS idea_no FROM o GROUP BY account, name)
  SELECT account, position, idea_no, CASE WHEN position = born THEN 'create' WHEN fresh THEN 'update' ELSE 'noop' END AS action,
    array_to_string(list_concat([p], list(CASE WHEN fresh THEN y END) OVER (PARTITION BY account, name ORDER BY position)), '|') AS facets FROM f JOIN b USING (account, name)""")
def merge_loop(t: Tables) -> DataFrame:
    """Orders as ideas of a customer, named by priority and status: matched by name, in order."""
    ideas = t.orders.select(F.col("o_custkey").alias("account"), F.col("o_orderkey").alias("position"), F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("name"), F.array(F.col("o_orderpriority"), F.year("o_orderdate").cast("string")).alias("facets"))
    return R.merge_ideas(ideas, R.same_name).withColumn("facets", F.array_join("facets", "|"))


PIECES = """lines AS (SELECT l.*, CAST(o_custkey AS VARCHAR) AS account, o_orderdate FROM lineitem l JOIN orders ON o_orderkey = l_orderkey),
  f AS (SELECT account, row_number() OVER (PARTITION BY account ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS position, 'part ' || l_partkey AS name,
    CASE WHEN l_partkey % 7 = 0 THEN 'JOB' || (l_partkey + 1000) END AS job, CASE WHEN l_partkey % 5 = 0 THEN 'p' || l_partkey END AS match_id, CAST(l_partkey % 100 AS DOUBLE) / 100 AS confidence FROM lines),
  owner AS (SELECT l_partkey, arg_min(account, (o_orderdate, l_orderkey)) AS account FROM lines GROUP BY 1),
  k AS (SELECT account, 'p' || p_partkey AS piece_id, 'part ' || p_partkey AS name, CASE WHEN p_partkey % 11 = 0 THEN 'JOB' || (p_partkey + 1000) END AS job FROM part LEFT JOIN owner ON l_partkey = p_partkey),
  first AS (SELECT job, min({'a': account, 'p': position}).a AS account FROM f WHERE job IS NOT NULL GROUP BY 1),
  u AS (SELECT f.account, f.position, f.name, f.match_id, f.confidence, CASE WHEN coalesce(k.account, first.account) = f.account THEN f.job END AS job FROM f LEFT JOIN k USING (job) LEFT JOIN first USING (job)),
  fj AS (SELECT account, job, min(position) AS p FROM u WHERE job IS NOT NULL GROUP BY ALL), fn AS (SELECT account, name, min(position) AS p FROM u GROUP BY ALL),
  s AS (SELECT u.account, u.position, j.piece_id AS j, fj.p AS pj, m.piece_id AS m, n.piece_id AS n, fn.p AS pn FROM u LEFT JOIN k j ON j.account = u.account AND j.job = u.job LEFT JOIN fj ON fj.account = u.account AND fj.job = u.job
    LEFT JOIN k m ON m.account = u.account AND m.piece_id = u.match_id AND u.confidence >= 0.8 LEFT JOIN k n ON n.account = u.account AND n.name = u.name JOIN fn ON fn.account = u.account AND fn.name = u.name),
  r AS (SELECT account, position, CASE WHEN j IS NOT NULL OR pj < position THEN 'job_number' WHEN m IS NOT NULL THEN 'match' WHEN n IS NOT NULL OR pn < position THEN 'name' ELSE 'new' END AS via,
    CASE WHEN j IS NOT NULL THEN j WHEN pj < position THEN NULL WHEN m IS NOT NULL THEN m WHEN n IS NOT NULL THEN n WHEN pn < position THEN NULL ELSE 'new-' || account || '-' || position END AS piece_id, CASE WHEN j IS NULL AND pj < position THEN pj ELSE pn END AS up FROM s),
  w AS (SELECT account, position, via, piece_id, up FROM r UNION ALL SELECT w.account, w.position, w.via, r.piece_id, r.up FROM w JOIN r ON r.account = w.account AND r.position = w.up WHERE w.piece_id IS NULL)"""


@query(f"WITH RECURSIVE {PIECES} SELECT account, position, piece_id, via FROM w WHERE piece_id IS NOT NULL")
def derived_pieces(t: Tables) -> DataFrame:
    """Order lines as executions of the order's customer; parts as known pieces of the customer who ordered them first."""
    from pyspark.sql import Window

    part = F.col("l_partkey").cast("string")
    # lines that agree in these become equal rows, so what else the SQL orders by is not carried
    order = ["l_orderkey", "l_linenumber", "l_partkey"]
    lines = t.lineitem.select(*order).join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"), "l_orderkey")
    lines = Scratch(lines.sparkSession).save(lines, "lines")  # read for the rows and for the pieces
    found = lines.select(
        F.col("o_custkey").cast("string").alias("account"), F.row_number().over(Window.partitionBy("o_custkey").orderBy(*order)).cast("long").alias("position"), F.concat(F.lit("part "), part).alias("name"),
        F.when(F.col("l_partkey") % 7 == 0, F.concat(F.lit("JOB"), (F.col("l_partkey") + 1000).cast("string"))).alias("job_number"), F.when(F.col("l_partkey") % 5 == 0, F.concat(F.lit("p"), part)).alias("match_id"), ((F.col("l_partkey") % 100) / 100.0).cast("double").alias("confidence"),
    )
    first = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min_by("o_custkey", F.struct("o_orderdate", "l_orderkey")).cast("string").alias("account"))
    pieces = t.part.join(first, "p_partkey", "left").select("account", F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("piece_id"), F.concat(F.lit("part "), F.col("p_partkey").cast("string")).alias("name"), F.when(F.col("p_partkey") % 11 == 0, F.concat(F.lit("JOB"), (F.col("p_partkey") + 1000).cast("string"))).alias("job_number"))
    return R.derived_pieces(found, pieces)


@query()
def extract_texts(t: Tables) -> DataFrame:
    """Pages through the extraction dispatch: kinds, reasons and lengths."""
    from siltstone.sources.extraction import MAX_BYTES, extract

    files = t.pages.select(F.col("page_id").cast("string").alias("id"), F.when(F.col("page_id") % 9 == 0, "application/zip").otherwise("text/html").alias("mime_type"), F.octet_length("html").cast("long").alias("size"), F.lit(False).alias("is_folder"), F.lit(None).cast("struct<id:string,mime_type:string>").alias("shortcut"), F.col("html").cast("binary").alias("content"))
    return extract(files, max_bytes=MAX_BYTES).select("id", "kind", "reason", F.length("text").alias("n_chars"))


@query()
def completed_turns(t: Tables) -> DataFrame:
    """Conversations through the completer interface with its offline stand-in."""
    from siltstone.sources.completer import complete

    prompts = t.conversations.select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), F.lit("interpret").alias("step"), F.col("text").alias("prompt"))
    return complete(prompts)


@query("SELECT o_custkey AS account_id, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1")
def pending_by_account(t: Tables) -> DataFrame:
    return P.pending_by_account(t.orders.select(F.col("o_custkey").alias("account_id"), F.when(F.col("o_orderstatus") == "P", "pending").otherwise("applied").alias("state")))


@query("SELECT l_suppkey AS bucket, count(*) AS observations, count(DISTINCT l_partkey) AS files, min(l_partkey) AS first_file FROM lineitem GROUP BY 1")
def bucket_counts(t: Tables) -> DataFrame:
    return P.buckets(t.lineitem.select(F.col("l_suppkey").alias("bucket"), F.col("l_partkey").alias("file_id")))


@query("""SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM events WHERE json_extract_string(props, '$.k') = CAST(p_partkey AS VARCHAR) AND event_type = 'error')""")
def unlogged_diagnostics(t: Tables) -> DataFrame:
    diagnostics = t.part.select("p_partkey", F.col("p_partkey").cast("string").alias("key"))
    return P.unlogged(diagnostics, t.events.filter("event_type = 'error'").select(F.col("props").alias("payload")), "$.k").select("p_partkey")


@query("""SELECT CASE WHEN event_type = 'error' OR user_id % 11 = 0 THEN 'bootstrap_required' WHEN user_id % 7 = 0 THEN 'failed' WHEN value < 5 THEN 'no_changes' WHEN event_type = 'click' THEN 'skipped_in_flight' ELSE 'dispatched' END AS outcome, count(*) AS n FROM events GROUP BY 1""")
def poll_outcomes(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    outcome = P.poll_outcome(F.when(F.col("user_id") % 11 != 0, "t"), kind == "error", F.col("user_id") % 7 == 0, F.when(F.col("value") < 5, 0).otherwise(1), kind == "click")
    return t.events.select(outcome.alias("outcome")).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH k AS (SELECT 'c' || (p_partkey % 300) AS id, p_partkey, 1 AS rank, p_size AS v FROM part UNION ALL SELECT 'c' || (s_suppkey % 300), s_suppkey, 2, s_nationkey FROM supplier)
  SELECT id, arg_max(v, (rank, p_partkey)) AS v FROM k GROUP BY id""")
def collision_override(t: Tables) -> DataFrame:
    from siltstone.operators.versions import latest

    one = t.part.select(F.concat(F.lit("c"), (F.col("p_partkey") % 300).cast("string")).alias("id"), F.col("p_partkey").alias("key"), F.lit(1).alias("rank"), F.col("p_size").alias("v"))
    two = t.supplier.select(F.concat(F.lit("c"), (F.col("s_suppkey") % 300).cast("string")).alias("id"), F.col("s_suppkey").alias("key"), F.lit(2).alias("rank"), F.col("s_nationkey").alias("v"))
    return latest(one.unionByName(two), ["id"], ["rank", "key"]).select("id", "v")


@query("""SELECT doc_id, nullif(array_to_string(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9)) <> '' AND (length(x) % 3 <> 0 OR length(x) >= 90)), chr(10)), '') IS NOT NULL AS left_over,
  len(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9)) <> '' AND (length(x) % 3 <> 0 OR length(x) >= 90))) AS n FROM documents WHERE text IS NOT NULL""")
def expiry_prune(t: Tables) -> DataFrame:
    """Every third short line of a document is made to expire before the date asked for."""
    from siltstone.functions.text import unexpired

    expires = lambda x: F.when((F.length(x) % 3 == 0) & (F.length(x) < 90), F.concat(x, F.lit(" [expires: 2024-01-31]"))).when(F.length(x) % 2 == 0, F.concat(x, F.lit(" [expires: 2024-02-01]"))).otherwise(x)
    blank = lambda x: F.regexp_replace(x, "^[ \t]+$", "")
    body = F.array_join(F.transform(F.filter(F.split("text", "\n"), lambda x: blank(x) != ""), expires), "\n")
    left = t.documents.filter("text IS NOT NULL").select("doc_id", unexpired(body, F.lit("2024-02-01")).alias("left"))
    return left.select("doc_id", F.col("left").isNotNull().alias("left_over"), F.when(F.col("left").isNull(), 0).otherwise(F.size(F.split("left", "\n"))).cast("long").alias("n"))


WORDS = "flatten(list_transform(list_filter(string_split({0}, ' '), lambda w: w <> ''), lambda w: list_transform(range(1, len(w) + 2), lambda i: substr('  ' || w || ' ', i, 3))))"


@query(f"""WITH a AS (SELECT phrase, list_distinct({WORDS.format('phrase')}) AS own FROM (SELECT DISTINCT substr(p_name, 2) AS phrase FROM part)), b AS (SELECT text, {WORDS.format('lower(text)')} AS t FROM (SELECT DISTINCT p_type || ' ' || p_name AS text FROM part)),
  e AS (SELECT phrase, text, own, list_distinct(t[i : j]) AS x FROM a, b, range(1, 60) p(i), range(1, 60) q(j) WHERE i <= j AND j <= len(t)), s AS (SELECT phrase, text, len(list_intersect(own, x)) AS c, len(own) + len(x) AS every_ FROM e)
  SELECT phrase, text, round(max(c / (every_ - c)), 9) AS score FROM s GROUP BY ALL HAVING max(c / (every_ - c)) >= 0.6""")
def facet_matches(t: Tables) -> DataFrame:
    """Names of parts less their first letter, found in types and names by the best extent of trigrams."""
    phrases = t.part.select(F.substr("p_name", F.lit(2)).alias("q")).distinct().withColumn("phrase", F.col("q"))
    texts = t.part.select(F.concat_ws(" ", "p_type", "p_name").alias("id")).distinct().withColumn("text", F.col("id"))
    return M.word_matches(texts, phrases).select(F.col("q").alias("phrase"), F.col("id").alias("text"), F.round("score", 9).alias("score"))


KINDS = "CASE json_type({0}) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE CASE WHEN {0} IS NOT NULL THEN 'number' END END".format


@query(f"""WITH e AS (SELECT event_id, CAST('{{"payload":' || props || ',"tags":' || to_json(list_transform(range(event_id % 4), lambda i: event_type)) || ',"user":{{"id":' || user_id || '}},"odd":' || (event_id % 2 = 1) || ',"none":null,"name":"' || event_type || '"}}' AS JSON) AS j FROM events)
  SELECT event_id, json_extract_string(j, '$.payload.k') AS k, json_extract_string(j, '$.user') AS user_text, CAST(json_array_length(j, '$.tags') AS INT) AS n_tags, json_extract_string(j, '$.tags[0]') AS first_tag,
  {', '.join(f"{KINDS(f"json_extract(j, '$.{c}')")} AS {c}_kind" for c in ('payload', 'tags', 'odd', 'none', 'name', 'missing'))}, {KINDS("json_extract(j, '$.payload.k')")} AS k_kind FROM e""")
def json_documents(t: Tables) -> DataFrame:
    """Events as documents of all kinds of JSON values, asked by path, text, kind and length."""
    tags = F.to_json(F.array_repeat("event_type", (F.col("event_id") % 4).cast("int")))
    text = F.concat(F.lit('{"payload":'), "props", F.lit(',"tags":'), tags, F.lit(',"user":{"id":'), F.col("user_id").cast("string"), F.lit('},"odd":'), (F.col("event_id") % 2 == 1).cast("string"), F.lit(',"none":null,"name":"'), "event_type", F.lit('"}'))
    j = F.col("j")
    kinds = [J.kind(J.at(j, f"$.{c}")).alias(f"{c}_kind") for c in ("payload", "tags", "odd", "none", "name", "missing")]
    return t.events.select("event_id", J.parsed(text).alias("j")).select(
        "event_id", J.text_at(j, "$.payload.k").alias("k"), J.text_at(j, "$.user").alias("user_text"), J.array_length(J.at(j, "$.tags")).alias("n_tags"), J.text_at(j, "$.tags[0]").alias("first_tag"), *kinds, J.kind(J.at(j, "$.payload.k")).alias("k_kind")
    )
