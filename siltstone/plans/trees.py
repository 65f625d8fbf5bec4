"""Hierarchies: regions, nations and customers as folders, with a missing parent and a loop added; paths of page addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltstone.functions.text import path_year
from siltstone.operators import hierarchy as T, intervals as V
from siltstone.plans.registry import Tables, query


def folders_of(t: Tables) -> DataFrame:
    s = lambda c: F.col(c).cast("string")
    regions = t.region.select(F.concat(F.lit("r"), s("r_regionkey")).alias("id"), F.col("r_name").alias("name"), F.when(F.col("r_regionkey") == 0, "drive").otherwise("root").alias("parent_id"))
    nations = t.nation.select(F.concat(F.lit("n"), s("n_nationkey")).alias("id"), F.col("n_name").alias("name"), F.when(F.col("n_nationkey") == 3, "gone").otherwise(F.concat(F.lit("r"), s("n_regionkey"))).alias("parent_id"))
    loop = F.when(F.col("c_custkey") == 5, "c7").when(F.col("c_custkey") == 7, "c5")
    customers = t.customer.select(F.concat(F.lit("c"), s("c_custkey")).alias("id"), F.col("c_name").alias("name"), F.coalesce(loop, F.concat(F.lit("n"), s("c_nationkey"))).alias("parent_id"))
    return regions.unionByName(nations).unionByName(customers)


FOLDERS = """f AS (SELECT 'r' || r_regionkey AS id, r_name AS name, CASE WHEN r_regionkey = 0 THEN 'drive' ELSE 'root' END AS parent_id FROM region
  UNION ALL SELECT 'n' || n_nationkey, n_name, CASE WHEN n_nationkey = 3 THEN 'gone' ELSE 'r' || n_regionkey END FROM nation
  UNION ALL SELECT 'c' || c_custkey, c_name, CASE c_custkey WHEN 5 THEN 'c7' WHEN 7 THEN 'c5' ELSE 'n' || c_nationkey END FROM customer)"""
TREE = f"""{FOLDERS}, walk AS (SELECT id, name, parent_id, 1 AS depth, [id] AS ids, name AS path, CASE parent_id WHEN 'root' THEN 'in' ELSE 'out' END AS reach FROM f WHERE parent_id IN ('root', 'drive')
  UNION ALL SELECT f.id, f.name, f.parent_id, w.depth + 1, list_append(w.ids, f.id), w.path || ' / ' || f.name, w.reach FROM f JOIN walk w ON f.parent_id = w.id WHERE w.depth <= 100),
  tree AS (SELECT f.id, f.parent_id, coalesce(reach, 'orphan') AS reach, depth, ids, path FROM f LEFT JOIN walk USING (id))"""


def tree_of(t: Tables) -> DataFrame:
    return T.resolve(folders_of(t), "root", "drive")


@query(f"WITH RECURSIVE {TREE} SELECT id, reach, CAST(depth AS INT) AS depth, path FROM tree")
def tree_paths(t: Tables) -> DataFrame:
    return tree_of(t).select("id", "reach", "depth", "path")


@query(f"""WITH RECURSIVE {TREE} SELECT count(*) FILTER (WHERE reach = 'in') AS n_in, count(*) FILTER (WHERE reach = 'out') AS n_out, count(*) FILTER (WHERE reach = 'orphan') AS n_orphan,
  CAST(0 AS BIGINT) AS n_beyond_cap, CAST(max(depth) AS INT) AS deepest FROM tree""")
def reach_counts(t: Tables) -> DataFrame:
    return T.reach_counts(tree_of(t))


@query(f"""WITH RECURSIVE {TREE}, e AS (SELECT unnest(ids) AS id FROM tree WHERE reach = 'in') SELECT id, CAST(depth AS INT) AS depth, count(*) - 1 AS below FROM e JOIN tree USING (id) GROUP BY ALL""")
def subtree_counts(t: Tables) -> DataFrame:
    return T.subtree_counts(tree_of(t))


@query(f"""WITH RECURSIVE {TREE}, chain AS (SELECT id, unnest(ids) AS folder_id, generate_subscripts(ids, 1) AS place FROM tree WHERE ids IS NOT NULL),
  o AS (SELECT id, arg_max('owner-' || folder_id, place) AS owner FROM chain WHERE folder_id LIKE 'n%2' OR folder_id IN ('c10', 'c11', 'r1') GROUP BY id) SELECT tree.id, owner FROM tree LEFT JOIN o USING (id)""")
def nearest_owner(t: Tables) -> DataFrame:
    folders = folders_of(t)
    owners = folders.filter("id LIKE 'n%2' OR id IN ('c10', 'c11', 'r1')").select(F.col("id").alias("folder_id"), F.concat(F.lit("owner-"), "id").alias("owner"))
    return T.nearest_owner(tree_of(t), owners).select("id", "owner")


@query(f"WITH RECURSIVE {TREE} SELECT c_custkey AS file_id FROM customer WHERE NOT EXISTS (SELECT 1 FROM tree WHERE reach = 'in' AND tree.id = 'n' || c_nationkey)")
def outside_map(t: Tables) -> DataFrame:
    files = t.customer.select(F.col("c_custkey").alias("file_id"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("parent_id"))
    return T.outside_map(files, tree_of(t).filter("reach = 'in'").select("id"), "root").select("file_id")


URLS = """u AS (SELECT DISTINCT list_filter(string_split(regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', ''), '/'), lambda x: x <> '') AS parts FROM pages),
  s AS (SELECT DISTINCT array_to_string(parts[1:i], '/') AS id, CASE WHEN i > 1 THEN array_to_string(parts[1:i-1], '/') ELSE 'root' END AS parent_id, parts[i] AS name, CAST(i AS INT) AS depth FROM u, range(1, 30) r(i) WHERE i <= len(parts))"""


def url_folders(t: Tables) -> DataFrame:
    path = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[?#].*$", "")
    return T.segments(t.pages, path).withColumn("parent_id", F.coalesce("parent_id", F.lit("root")))


@query(f"WITH {URLS} SELECT id, parent_id, name, depth, CASE WHEN regexp_matches(name, '^(19|20)[0-9][0-9]$') THEN CAST(name AS INT) END AS own_year FROM s")
def url_tree(t: Tables) -> DataFrame:
    tree = T.resolve(url_folders(t), "root")
    return tree.select("id", "parent_id", "name", "depth", path_year(F.col("name")).alias("own_year"))


@query(f"""WITH {URLS}, shown AS (SELECT id, depth FROM s WHERE depth <= 1), hidden AS (SELECT string_split(id, '/')[1] AS id, count(*) AS hidden FROM s WHERE depth > 1 GROUP BY 1)
  SELECT id, depth, coalesce(hidden, 0) AS hidden FROM shown LEFT JOIN hidden USING (id)""")
def depth_cap_hidden(t: Tables) -> DataFrame:
    return T.capped(T.resolve(url_folders(t), "root"), 1).select("id", "depth", "hidden")


@query(f"WITH {URLS} SELECT max(depth) + 1 AS cap FROM s WHERE name = 'en'")
def depth_cap(t: Tables) -> DataFrame:
    tree = T.resolve(url_folders(t), "root")
    return T.depth_cap_for(tree, tree.filter("name = 'en'").select(F.col("id").alias("folder_id")))


@query("""SELECT CAST(l_suppkey AS VARCHAR) AS parent_id, count(*) AS files FROM lineitem GROUP BY 1 HAVING count(*) FILTER (WHERE l_returnflag = 'N' AND l_quantity > 49) = 0""")
def binaries_only(t: Tables) -> DataFrame:
    return T.binaries_only(t.lineitem.select(F.col("l_suppkey").cast("string").alias("parent_id"), F.when((F.col("l_returnflag") == "N") & (F.col("l_quantity") > 49), "ok").otherwise("skip").alias("kind")))


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS down FROM orders) WHERE down <= 5")
def last_candidates(t: Tables) -> DataFrame:
    return T.ordered_within(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], 5).select("o_custkey", "o_orderkey", F.col("place").cast("long").alias("place"))


@query(f"""WITH RECURSIVE {TREE}, e AS (SELECT unnest(ids) AS id FROM tree WHERE reach = 'in') SELECT id, CAST(depth AS INT) AS depth, count(*) - 1 AS below FROM e JOIN tree USING (id) GROUP BY ALL""")
def interval_counts(t: Tables) -> DataFrame:
    """The counts of ``subtree_counts`` by entry and last entry."""
    return V.subtree_counts(V.intervals(folders_of(t), "root"))


@query(f"""WITH RECURSIVE {TREE}, e AS (SELECT id AS node, unnest(ids) AS id FROM tree WHERE reach = 'in'), o AS (SELECT 'c' || o_custkey AS node, count(*) AS n FROM orders GROUP BY 1)
  SELECT e.id, CAST(coalesce(sum(n), 0) AS BIGINT) AS n FROM e LEFT JOIN o USING (node) GROUP BY 1""")
def interval_files(t: Tables) -> DataFrame:
    """The orders of the customers below each folder, by running sums over entries."""
    files = t.orders.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("parent_id"))
    return V.counts_below(files, V.intervals(folders_of(t), "root"))


MOVED = FOLDERS.replace("f AS (", "f0 AS (", 1) + """, f AS (SELECT f0.id, CASE WHEN f0.id = 'n4' THEN 'renamed' ELSE name END AS name, CASE WHEN c_custkey IS NOT NULL THEN 'n2' ELSE parent_id END AS parent_id
  FROM f0 LEFT JOIN customer ON f0.id = 'c' || c_custkey AND c_mktsegment = 'MACHINERY' WHERE f0.id <> 'n5')""" + TREE[len(FOLDERS) :]


@query(f"WITH RECURSIVE {MOVED} SELECT id, reach, CAST(depth AS INT) AS depth, path FROM tree")
def tree_after_moves(t: Tables) -> DataFrame:
    """The tree of ``tree_paths`` after the customers of a segment have moved, a nation has got another name and one is gone."""
    tree, customers = tree_of(t), t.customer.filter("c_mktsegment = 'MACHINERY'")
    moved = customers.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("name"), F.lit("n2").alias("parent_id"))
    renamed = folders_of(t).filter("id = 'n4'").select("id", F.lit("renamed").alias("name"), "parent_id")
    rewritten = T.after_changes(tree, moved.unionByName(renamed), folders_of(t).filter("id = 'n5'").select("id"), "root", "drive")
    return T.merged(tree, rewritten).select("id", "reach", "depth", "path")
