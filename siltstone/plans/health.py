"""Health of the log: orders are ideas of a customer, their lines the changes; document lines are facets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltstone.functions.text import same_elements, union_ignoring_case
from siltstone.operators import health as H, matching as M
from siltstone.operators.changes import change_kinds as kinds_of_changes
from siltstone.plans.registry import Tables, query


def facets_of(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("id"), F.col("source").alias("account"), F.split("text", "\n").alias("facets"))


FACETS = "f AS (SELECT doc_id AS id, source AS account, string_split(text, chr(10)) AS facets FROM documents)"


@query("""SELECT count(*) AS customers, count(*) FILTER (WHERE n > 0) AS with_orders, count(*) FILTER (WHERE n IS NULL) AS without, count(DISTINCT c_mktsegment) AS segments,
  CAST(min(first_order) AS DATE) AS first_order, CAST(max(last_order) AS DATE) AS last_order
  FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey""")
def fill_rates(t: Tables) -> DataFrame:
    per = t.orders.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"))
    joined = t.customer.join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.agg(F.count(F.lit(1)).alias("customers"), F.count_if(F.col("n") > 0).alias("with_orders"), F.count_if(F.col("n").isNull()).alias("without"), F.countDistinct("c_mktsegment").alias("segments"), F.to_date(F.min("first_order")).alias("first_order"), F.to_date(F.max("last_order")).alias("last_order"))


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def missing_sources(t: Tables) -> DataFrame:
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey")
    return t.customer.select("c_custkey", "c_name").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_anti")


NAMES = "n AS (SELECT p_type AS block, p_name AS name, min(p_partkey) AS id FROM part GROUP BY 1, 2)"
GRAMS = f"""{NAMES}, w AS (SELECT block, id, unnest(string_split(trim(regexp_replace(lower(name), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')) AS word FROM n),
  g AS (SELECT DISTINCT block, id, substr('  ' || word || ' ', CAST(i AS BIGINT), 3) AS gram FROM w, range(1, 100) r(i) WHERE word <> '' AND i <= length(word) + 1),
  s AS (SELECT block, id, count(*) AS size FROM g GROUP BY ALL),
  p AS (SELECT a.block, a.id AS a, b.id AS b, count(*) AS shared FROM g a JOIN g b ON a.block = b.block AND a.gram = b.gram AND a.id < b.id GROUP BY ALL),
  q AS (SELECT p.block, a, b, shared, x.size + y.size - shared AS total FROM p JOIN s x ON x.block = p.block AND x.id = a JOIN s y ON y.block = p.block AND y.id = b)"""


def part_names(t: Tables) -> DataFrame:
    return t.part.groupBy(F.col("p_type").alias("block"), F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))


@query(f"WITH {GRAMS} SELECT block, a, b, shared, total FROM q WHERE shared >= 0.4 * total ORDER BY shared * 1.0 / total DESC, block, a, b LIMIT 200")
def near_dup_names(t: Tables) -> DataFrame:
    return M.similar_pairs(part_names(t), "block", 0.4).orderBy(F.desc(F.col("shared") * 1.0 / F.col("total")), "block", "a", "b").limit(200)


@query(f"WITH {GRAMS} SELECT block, count(*) FILTER (WHERE shared >= 0.4 * total) AS near, count(*) FILTER (WHERE shared >= 0.7 * total) AS very_near FROM q GROUP BY block HAVING count(*) FILTER (WHERE shared >= 0.4 * total) > 0")
def near_dup_counts(t: Tables) -> DataFrame:
    pairs = M.similar_pairs(part_names(t), "block", 0.4)
    return pairs.groupBy("block").agg(F.count(F.lit(1)).alias("near"), F.count_if(F.col("shared") >= 0.7 * F.col("total")).alias("very_near"))


@query(f"WITH {FACETS} SELECT CAST(len(facets) AS INT) AS bucket, count(*) AS n FROM f GROUP BY 1")
def facet_histogram(t: Tables) -> DataFrame:
    return H.histogram(facets_of(t), F.size("facets"))


@query(f"WITH {FACETS} SELECT quantile_disc(len(facets), 0.5) AS p50, quantile_disc(len(facets), 0.9) AS p90, quantile_disc(len(facets), 0.99) AS p99, max(len(facets)) AS longest FROM f")
def facet_percentiles(t: Tables) -> DataFrame:
    n = facets_of(t).select(F.size("facets").cast("long").alias("n"))
    at = [F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY n)").cast("long").alias(name) for p, name in ((0.5, "p50"), (0.9, "p90"), (0.99, "p99"))]
    return n.agg(*at, F.max("n").alias("longest"))


@query(f"""WITH {FACETS}, s AS (SELECT len(facets) AS n, len(list_distinct(list_transform(facets, lambda x: lower(trim(x))))) AS d FROM f)
  SELECT count(*) AS ideas, count(*) FILTER (WHERE d < n) AS with_repeats, CAST(sum(n - d) AS BIGINT) AS repeats FROM s""")
def facet_repeats(t: Tables) -> DataFrame:
    stats = H.facet_stats(facets_of(t))
    return stats.agg(F.count(F.lit(1)).alias("ideas"), F.count_if(F.col("n_distinct") < F.col("n_facets")).alias("with_repeats"), F.sum(F.col("n_facets") - F.col("n_distinct")).cast("long").alias("repeats"))


@query(f"""WITH {FACETS}, o AS (SELECT id, account, lower(trim(unnest(facets))) AS facet FROM f)
  SELECT md5(facet) AS facet, count(DISTINCT id) AS ideas, count(DISTINCT account) AS accounts FROM o WHERE facet <> '' GROUP BY o.facet HAVING count(DISTINCT id) > 1""")
def facet_shared(t: Tables) -> DataFrame:
    return H.shared_facets(facets_of(t)).withColumn("facet", F.md5(F.col("facet").cast("binary")))


BIRTHS = "b AS (SELECT o_orderkey AS id, count(*) FILTER (WHERE l_linenumber = 1) AS births, count(*) FILTER (WHERE l_linenumber > 1) AS rewrites FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)"


def births_of(t: Tables) -> DataFrame:
    changes = t.lineitem.select(F.col("l_orderkey").alias("idea_id"), F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")).alias("previous"))
    return H.births_and_rewrites(t.orders.select(F.col("o_orderkey").alias("id")), changes)


@query(f"WITH {BIRTHS} SELECT count(*) FILTER (WHERE births = 0) AS without_birth, count(*) FILTER (WHERE births = 1) AS one_birth, count(*) FILTER (WHERE births > 1) AS several FROM b")
def birth_integrity(t: Tables) -> DataFrame:
    return births_of(t).agg(F.count_if(F.col("births") == 0).alias("without_birth"), F.count_if(F.col("births") == 1).alias("one_birth"), F.count_if(F.col("births") > 1).alias("several"))


@query(f"WITH {BIRTHS} SELECT rewrites AS bucket, count(*) AS n FROM b GROUP BY 1")
def rewrites_hist(t: Tables) -> DataFrame:
    return H.histogram(births_of(t), F.col("rewrites"))


@query("""SELECT l_orderkey AS idea_id, count(*) AS rewrites, min(l_quantity) AS least FROM lineitem JOIN orders ON o_orderkey = l_orderkey AND l_linenumber > 1 AND l_returnflag IS NOT NULL
  GROUP BY 1 HAVING count(*) >= 10""")
def rewrites_10(t: Tables) -> DataFrame:
    lines = t.lineitem.filter("l_linenumber > 1 AND l_returnflag IS NOT NULL").join(t.orders.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.groupBy(F.col("l_orderkey").alias("idea_id")).agg(F.count(F.lit(1)).alias("rewrites"), F.min("l_quantity").alias("least")).filter("rewrites >= 10")


@query("""SELECT c_mktsegment AS account, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS versions, CAST(max(o_orderdate) AS DATE) AS newest FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def index_freshness(t: Tables) -> DataFrame:
    joined = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.groupBy(F.col("c_mktsegment").alias("account")).agg(F.countDistinct("c_custkey").alias("customers"), F.count("o_orderkey").alias("versions"), F.to_date(F.max("o_orderdate")).alias("newest"))


@query("SELECT o_orderkey AS run_id, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n_rows, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS returned FROM orders")
def rows_per_run(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r"))
    return t.orders.join(per, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.col("o_orderkey").alias("run_id"), F.coalesce("n", F.lit(0)).alias("n_rows"), F.coalesce("r", F.lit(0)).alias("returned"))


ORDER = "l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@query(f"""SELECT o_orderkey AS id, last_id, last_part, last_day FROM orders LEFT JOIN LATERAL (SELECT l_linenumber AS last_id, l_partkey AS last_part, CAST(l_shipdate AS DATE) AS last_day FROM lineitem
  WHERE l_orderkey = o_orderkey ORDER BY {", ".join(c + " DESC" for c in ORDER.split(", "))} LIMIT 1) ON true""")
def lineage_birth(t: Tables) -> DataFrame:
    changes = t.lineitem.select(F.col("l_orderkey").alias("idea_id"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("id"), F.col("l_shipdate").alias("changed_at"))
    last = H.last_change(t.orders.select(F.col("o_orderkey").alias("id")), changes)
    return last.select("id", F.col("last_id.l_linenumber").alias("last_id"), F.col("last_id.l_partkey").alias("last_part"), F.to_date("last_changed_at").alias("last_day"))


@query("""SELECT kind, count(*) AS n, count(*) FILTER (WHERE bal < 0) AS negative FROM (SELECT 'customer' AS kind, c_acctbal AS bal FROM customer UNION ALL SELECT 'supplier', s_acctbal FROM supplier
  UNION ALL SELECT 'nation', CAST(n_nationkey AS DOUBLE) FROM nation) GROUP BY kind""")
def root_census(t: Tables) -> DataFrame:
    kinds = [t.customer.select(F.lit("customer").alias("kind"), F.col("c_acctbal").alias("bal")), t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("bal")), t.nation.select(F.lit("nation").alias("kind"), F.col("n_nationkey").cast("double").alias("bal"))]
    every = kinds[0].unionByName(kinds[1]).unionByName(kinds[2])
    return every.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("bal") < 0).alias("negative"))


@query("""WITH p AS (SELECT doc_id AS id, string_split(text, chr(10)) AS a, list_reverse(string_split(text, chr(10))) AS b, doc_id % 2 = 0 AS longer FROM documents)
  SELECT id, list_sort(list_transform(a, lambda x: lower(trim(x)))) = list_sort(list_transform(CASE WHEN longer THEN list_append(b, 'x') ELSE b END, lambda x: lower(trim(x)))) AS same FROM p""")
def facets_equal(t: Tables) -> DataFrame:
    f = facets_of(t).withColumn("b", F.when(F.col("id") % 2 == 0, F.array_append(F.reverse("facets"), F.lit("x"))).otherwise(F.reverse("facets")))
    return f.select("id", same_elements(F.col("facets"), F.col("b")).alias("same"))


@query(f"""WITH {FACETS}, o AS (SELECT id, i, trim(facets[i]) AS x FROM f, range(1, 4000) r(i) WHERE i <= len(facets)), k AS (SELECT id, x, i, row_number() OVER (PARTITION BY id, lower(x) ORDER BY i) AS n FROM o WHERE x <> '')
  SELECT id, count(*) AS facets, md5(string_agg(x, '|' ORDER BY i)) AS digest FROM k WHERE n = 1 GROUP BY id""")
def facet_union(t: Tables) -> DataFrame:
    united = facets_of(t).select("id", union_ignoring_case(F.col("facets"), F.col("facets")).alias("u")).filter(F.size("u") > 0)
    return united.select("id", F.size("u").cast("long").alias("facets"), F.md5(F.array_join("u", "|").cast("binary")).alias("digest"))


@query("SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS week, count(*) AS births FROM lineitem WHERE l_linenumber = 1 AND l_shipdate >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 84 DAY GROUP BY 1")
def weekly_births(t: Tables) -> DataFrame:
    born = t.lineitem.filter("l_linenumber = 1").select("l_shipdate")
    last = t.lineitem.agg((F.max("l_shipdate") - F.expr("INTERVAL 84 DAYS")).alias("since"))
    return born.join(F.broadcast(last), F.col("l_shipdate") >= F.col("since")).groupBy(F.to_date(F.date_trunc("week", "l_shipdate")).alias("week")).agg(F.count(F.lit(1)).alias("births"))


@query("SELECT CAST(date_trunc('month', first) AS DATE) AS month, count(*) AS customers FROM (SELECT o_custkey, min(o_orderdate) AS first FROM orders GROUP BY 1) GROUP BY 1")
def monthly_first_seen(t: Tables) -> DataFrame:
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"))
    return first.groupBy(F.to_date(F.date_trunc("month", "first")).alias("month")).agg(F.count(F.lit(1)).alias("customers"))


@query("""WITH c AS (SELECT l_orderkey, list_sort(list(l_returnflag) FILTER (WHERE l_linenumber <= 2)) AS before, list_sort(list(l_returnflag) FILTER (WHERE l_linenumber >= 2)) AS after FROM lineitem GROUP BY 1),
  d AS (SELECT coalesce(before, []) AS b, coalesce(after, []) AS a FROM c)
  SELECT count(*) FILTER (WHERE a = b) AS noop, count(*) FILTER (WHERE a <> b AND len(a) = len(b)) AS same_size, count(*) FILTER (WHERE len(a) > len(b)) AS grew, count(*) FILTER (WHERE len(a) < len(b)) AS shrank FROM d""")
def change_kinds(t: Tables) -> DataFrame:
    flags = lambda cond: F.collect_list(F.when(cond, F.col("l_returnflag")))
    return kinds_of_changes(t.lineitem.groupBy("l_orderkey").agg(flags(F.col("l_linenumber") <= 2).alias("before"), flags(F.col("l_linenumber") >= 2).alias("after")))


@query("""SELECT conv_id, count(*) AS turns, md5(string_agg(role || ':' || text, '|' ORDER BY turn, role, text)) AS digest, max(turn) + 1 = count(*) AS gapless, arg_max(role, (turn, role, text)) AS last_role
  FROM conversations GROUP BY conv_id""")
def log_consistency(t: Tables) -> DataFrame:
    line = F.expr("listagg(role || ':' || text, '|') WITHIN GROUP (ORDER BY turn, role, text)")
    return t.conversations.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.md5(line.cast("binary")).alias("digest"), (F.max("turn") + 1 == F.count(F.lit(1))).alias("gapless"), F.max_by("role", F.struct("turn", "role", "text")).alias("last_role"))
