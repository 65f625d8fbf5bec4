"""Folder trees from flat listings.

Chains of parents are followed by pointer doubling: each round joins the folders that are still under way to the table
and doubles the length of their chains, so a tree of any width and depth needs as many joins as its depth has binary
digits, and no recursion. Folders that have arrived are not written again. In each round some folder of any chain that
ends arrives, so when none does all that are left run into loops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltstone.sources.scratch import Scratch

#: Deepest folder that a tree shows.
DEPTH_CAP = 100


def first_listed(folders: DataFrame) -> DataFrame:
    """One row per id, the one listed first (column ``position``)."""
    rest = [c for c in folders.columns if c != "id"]
    one = folders.groupBy("id").agg(F.min_by(F.struct(*rest), F.struct("position", F.coalesce("parent_id", F.lit("")))).alias("_one"))
    return one.select("id", *(F.col(f"_one.{c}").alias(c) for c in rest))


def resolve(folders: DataFrame, root: str, drive_root: str | None = None, cap: int = DEPTH_CAP, scratch: Scratch | None = None) -> DataFrame:
    """Folders (id, name, parent_id) with ``reach``, ``depth``, ``ids``, ``path``.

    ``reach`` is ``in`` below ``root``, ``out`` below ``drive_root`` only, and ``orphan`` where a parent is missing or
    the chain loops. ``ids`` runs from the topmost folder found to the folder itself; ``path`` joins the names with
    `` / ``; ``depth`` is 1 right below the root. For orphans and folders deeper than cap + 1 all three are null.
    """
    scratch = scratch or Scratch(folders.sparkSession)
    none, up = F.array().cast("array<string>"), F.col("up")
    cut = lambda names: F.when(F.size("ids") <= cap + 1, F.col(names)).alias(names)  # noqa: E731  longer chains are followed, not shown
    reach = F.when(up == root, "in").when(up == F.lit(drive_root), "out").when(up.isNull(), "orphan")
    columns = ["id", "name", "parent_id", "up", "ids", "names", "reach"]
    state = scratch.save(folders.select("id", "name", "parent_id", F.col("parent_id").alias("up"), F.array("id").alias("ids"), F.array("name").alias("names")).withColumn("reach", reach), "tree-0")
    settled, going, left = state.filter("reach IS NOT NULL"), state.filter("reach IS NULL"), None
    turn = 0
    while (n := going.count()) and n != left:
        left, turn = n, turn + 1
        above = settled.unionByName(going).select(F.col("id").alias("at"), F.col("up").alias("up2"), F.col("ids").alias("ids2"), F.col("names").alias("names2"), F.col("reach").alias("reach2"))
        met = going.join(above, up == F.col("at"), "left")
        moved = met.select(
            "id", "name", "parent_id", F.col("up2").alias("up"), F.concat(F.when(F.col("at").isNull(), none).otherwise(F.col("ids2")), "ids").alias("ids"),
            F.concat(F.when(F.col("at").isNull(), none).otherwise(F.col("names2")), "names").alias("names"), F.when(F.col("at").isNull(), "orphan").otherwise(F.col("reach2")).alias("reach"),
        )
        moved = scratch.save(moved.select(*columns[:4], cut("ids"), cut("names"), "reach"), f"tree-{turn}")
        settled, going = settled.unionByName(moved.filter("reach IS NOT NULL")), moved.filter("reach IS NULL")
    state = settled.unionByName(going)
    reach = F.coalesce("reach", F.lit("orphan"))
    known = (reach != "orphan") & (F.size("ids") <= cap + 1)
    return state.select("id", "name", "parent_id", reach.alias("reach"), F.when(known, F.size("ids")).alias("depth"), F.when(known, F.col("ids")).alias("ids"), F.when(known, F.array_join("names", " / ")).alias("path"))


def reach_counts(tree: DataFrame, cap: int = DEPTH_CAP) -> DataFrame:
    beyond = (F.col("reach") != "orphan") & F.col("depth").isNull()
    return tree.agg(*(F.count_if(F.col("reach") == r).alias(f"n_{r}") for r in ("in", "out", "orphan")), F.count_if(beyond).alias("n_beyond_cap"), F.max("depth").alias("deepest"))


def map_stats(rows: DataFrame, tree: DataFrame, root: str, drive_root: str | None, kind: str, cap: int = DEPTH_CAP) -> DataFrame:
    """One row of counters for a listing ``rows`` (id, parent_id, parents) cut to the tree below ``root``.

    ``kind`` is ``folders`` or ``files``: folders are in scope down to one level below the cap, files only in folders down
    to it. ``multi_parent`` counts rows of the whole listing with more than one parent; the first counts. The root is not counted.
    """
    of = tree.select(F.col("id").alias("_id"), F.col("reach").alias("_reach"), F.col("depth").alias("_depth"))
    own = F.when(F.col("parent_id") == root, "in").when(F.col("parent_id") == F.lit(drive_root), "out")
    joined = rows.join(of, F.col("parent_id") == F.col("_id"), "left").withColumn("reach", F.coalesce(own, "_reach", F.lit("orphan")))
    shown = (F.col("reach") == "in") & ((F.col("parent_id") == root) | (F.col("_depth") <= cap))
    beyond = tree.filter(f"reach = 'in' AND depth > {cap}").agg(F.count(F.lit(1)).alias("depth_cap"))
    counted = joined.filter(F.col("id") != root) if kind == "folders" else joined
    sums = counted.agg(F.count_if(shown).alias("in_scope"), F.count_if(F.col("reach") == "out").alias("out_of_scope"), F.count_if(F.col("reach") == "orphan").alias("orphans"))
    several = rows.agg(F.count_if(F.size("parents") > 1).alias("multi_parent"))
    return sums.crossJoin(several).crossJoin(beyond)  # three tables of one row


def parent_paths(rows: DataFrame, tree: DataFrame, root: str, label: str, cap: int = DEPTH_CAP) -> DataFrame:
    """``rows`` (parent_id) with ``parent_path``, from ``label`` down; null for a parent outside the tree or deeper than the cap."""
    of = tree.filter(f"reach = 'in' AND depth <= {cap}").select(F.col("id").alias("_id"), F.concat(F.lit(label + " / "), "path").alias("_path"))
    path = F.when(F.col("parent_id") == root, F.lit(label)).otherwise(F.col("_path"))
    return rows.join(of, F.col("parent_id") == F.col("_id"), "left").select(*rows.columns, path.alias("parent_path"))


def subtree_files(files: DataFrame, tree: DataFrame, root: str, label: str, cap: int = DEPTH_CAP) -> DataFrame:
    """Files (name, parent_id, ...) below the root with their ``path``, the folder's and the name; ``map_stats`` counts the rest."""
    placed = parent_paths(files, tree, root, label, cap).filter("parent_path IS NOT NULL")
    return placed.withColumn("path", F.concat_ws(" / ", "parent_path", "name")).drop("parent_path")


def attributed(rows: DataFrame, tree: DataFrame, labels: DataFrame, pieces: DataFrame) -> DataFrame:
    """``rows`` (parent_id) with their owner: that of the nearest folder, from the parent up, that is a campaign's or a piece's.

    ``labels`` (folder_id, label, campaign_id, campaign_name) names folders; ``existing`` and ``new`` ones own what is below.
    ``pieces`` (folder_id, piece_id, piece_name, campaign_id, campaign_name) that lie in the tree take the place of labels.
    Adds owner_type, owner_folder, campaign_id, campaign_name, status, piece_id, piece_name; without an owner the account's.
    """
    chains = tree.filter("reach = 'in' AND ids IS NOT NULL").select("id", "ids")
    own = pieces.join(chains.select(F.col("id").alias("folder_id")), "folder_id", "left_semi").select("folder_id", F.lit("existing").alias("status"), "campaign_id", "campaign_name", "piece_id", "piece_name")
    named = labels.filter(F.col("label").isin("existing", "new")).join(own, "folder_id", "left_anti")
    owners = own.unionByName(named.select("folder_id", F.col("label").alias("status"), "campaign_id", "campaign_name", F.lit(None).cast(own.schema["piece_id"].dataType).alias("piece_id"), F.lit(None).cast("string").alias("piece_name")))
    wanted = chains.join(rows.select(F.col("parent_id").alias("id")).distinct(), "id", "left_semi")
    steps = wanted.select("id", F.posexplode("ids").alias("at", "folder_id"))
    found = steps.join(owners, "folder_id").groupBy("id").agg(F.max_by(F.struct("folder_id", "status", "campaign_id", "campaign_name", "piece_id", "piece_name"), "at").alias("_own"))
    joined = rows.join(found.withColumnRenamed("id", "_id"), F.col("parent_id") == F.col("_id"), "left")
    kind = F.when(F.col("_own").isNotNull(), "campaign").otherwise("account")
    return joined.select(*rows.columns, kind.alias("owner_type"), F.col("_own.folder_id").alias("owner_folder"), *(F.col(f"_own.{c}").alias(c) for c in ("campaign_id", "campaign_name", "status", "piece_id", "piece_name")))


def subtree_counts(tree: DataFrame) -> DataFrame:
    """For each folder below the root, the folders below it."""
    inside = tree.filter("reach = 'in' AND ids IS NOT NULL")
    over = inside.select(F.explode("ids").alias("id")).groupBy("id").agg((F.count(F.lit(1)) - 1).alias("below"))
    return inside.select("id", "depth").join(over, "id")


def nearest_owner(tree: DataFrame, owners: DataFrame) -> DataFrame:
    """``tree`` (id, ids) with ``owner``: that of the deepest folder on its chain, itself included, in ``owners`` (folder_id, owner)."""
    chain = tree.filter("ids IS NOT NULL").select("id", F.posexplode("ids").alias("at", "folder_id"))
    found = chain.join(owners, "folder_id").groupBy("id").agg(F.max_by("owner", "at").alias("owner"))
    return tree.join(found, "id", "left")


def depth_cap_for(tree: DataFrame, anchors: DataFrame) -> DataFrame:
    """One row: the depth of the deepest anchor (folder_id) plus 1; null without anchors."""
    return tree.join(anchors, tree.id == anchors.folder_id, "left_semi").agg((F.max("depth") + 1).alias("cap"))


def capped(tree: DataFrame, cap: int, anchors: DataFrame | None = None) -> DataFrame:
    """The folders down to ``cap``, and all anchors, with the number of folders that each of them hides.

    A folder that is not shown is hidden by its nearest shown ancestor.
    """
    inside = tree.filter("reach = 'in' AND ids IS NOT NULL")
    shown = inside.filter(F.col("depth") <= cap).select("id")
    if anchors is not None:
        shown = shown.unionByName(inside.join(anchors, inside.id == anchors.folder_id, "left_semi").select("id")).distinct()
    owners = shown.select(F.col("id").alias("folder_id"), F.col("id").alias("owner"))
    hidden = nearest_owner(inside.join(shown, "id", "left_anti"), owners).groupBy("owner").agg(F.count(F.lit(1)).alias("hidden")).withColumnRenamed("owner", "id")
    return inside.join(shown, "id", "left_semi").join(hidden, "id", "left").select("id", "depth", "path", F.coalesce("hidden", F.lit(0)).alias("hidden"))


def outside_map(files: DataFrame, tree: DataFrame, root: str) -> DataFrame:
    """Files whose parent is neither the root nor a folder of the tree."""
    return files.filter(F.col("parent_id").isNull() | (F.col("parent_id") != root)).join(tree, files.parent_id == tree.id, "left_anti")


def binaries_only(files: DataFrame) -> DataFrame:
    """Folders that hold skipped files and none with text (parent_id, kind), with their number of files."""
    per_folder = files.groupBy("parent_id").agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("kind") == "ok").alias("texts"))
    return per_folder.filter("texts = 0").drop("texts")


def segments(paths: DataFrame, path: Column) -> DataFrame:
    """The tree of all prefixes of slash-separated paths: (id, parent_id, name), parents first null."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    every = paths.select(parts.alias("parts")).distinct().withColumn("n", F.explode(F.sequence(F.lit(1), F.greatest(F.size("parts"), F.lit(1))))).filter(F.size("parts") > 0)
    prefix = lambda n: F.array_join(F.slice("parts", F.lit(1), n), "/")
    return every.select(prefix(F.col("n")).alias("id"), F.when(F.col("n") > 1, prefix(F.col("n") - 1)).alias("parent_id"), F.element_at("parts", F.col("n")).alias("name")).distinct()


def shallowest(folders: DataFrame, name: str) -> DataFrame:
    """The folder whose name contains ``name``, case aside, that lies highest; ties by path."""
    return folders.filter(F.contains(F.lower("name"), F.lit(name.lower()))).orderBy("depth", "path").limit(1)


def ordered_within(rows: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The last k rows of each key, in ascending order, numbered from 1."""
    down = F.row_number().over(Window.partitionBy(*keys).orderBy(*[c.desc() for c in order]))
    kept = rows.withColumn("_down", down).filter(F.col("_down") <= k)
    return kept.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_down")))).drop("_down")


def after_changes(tree: DataFrame, changes: DataFrame, gone: DataFrame, root: str, drive_root: str | None = None, cap: int = DEPTH_CAP, scratch: Scratch | None = None) -> DataFrame:
    """The rows of a tree that changes touch, resolved anew: all others stay as they are.

    ``tree`` is what ``resolve`` gave, ``changes`` (id, name, parent_id) has folders that are new, renamed or moved, and
    ``gone`` (id) those that are no more. Touched are these, what lies below them, and folders without a known chain,
    which may have found one. Only touched folders are joined with each other, by doubling, until their chains leave the
    touched part; the folder that they come to gives the rest. What is written follows the change, not the tree.
    Returns the columns of ``tree``; a row of a folder that is gone has a null ``reach``. ``merged`` puts both together.
    """
    scratch = scratch or Scratch(tree.sparkSession)
    marked = scratch.save(changes.select("id").unionByName(gone.select("id")).distinct(), "marked")
    over = tree.filter("ids IS NOT NULL").select("id", F.explode("ids").alias("_over")).join(marked.withColumnRenamed("id", "_over"), "_over", "left_semi")
    old = over.select("id").unionByName(tree.filter("ids IS NULL").select("id")).distinct()
    new = changes.select("id", F.col("name").alias("_name"), F.col("parent_id").alias("_parent"), F.lit(True).alias("_new"))
    kept = tree.select("id", "name", "parent_id").join(old, "id", "left_semi").join(new, "id", "full_outer")
    kept = kept.select("id", F.when(F.col("_new"), F.col("_name")).otherwise(F.col("name")).alias("name"), F.when(F.col("_new"), F.col("_parent")).otherwise(F.col("parent_id")).alias("parent_id"))
    touched = scratch.save(kept.join(gone.select("id"), "id", "left_anti"), "touched")
    columns = ["id", "name", "parent_id", "up", "ids", "names"]
    going = scratch.save(touched.select("id", "name", "parent_id", F.col("parent_id").alias("up"), F.array("id").alias("ids"), F.array("name").alias("names"), F.lit(False).alias("done")), "going-0")
    settled, left, turn = going.limit(0), None, 0
    while (n := going.count()) and n != left:
        left, turn = n, turn + 1
        ahead = settled.unionByName(going).select(F.col("id").alias("at"), F.col("up").alias("up2"), F.col("ids").alias("ids2"), F.col("names").alias("names2"), F.col("done").alias("done2"))
        met, out = going.join(ahead, F.col("up") == F.col("at"), "left"), F.col("at").isNull()
        longer = lambda a, b: F.when(out, F.col(b)).otherwise(F.concat(a, b)).alias(b)
        moved = met.select("id", "name", "parent_id", F.when(out, F.col("up")).otherwise(F.col("up2")).alias("up"), longer("ids2", "ids"), longer("names2", "names"), F.coalesce("done2", F.lit(True)).alias("done"))
        moved = scratch.save(moved.select(*columns, "done"), f"going-{turn}")
        settled, going = settled.unionByName(moved.filter("done")), moved.filter("NOT done")
    above = tree.join(old, "id", "left_anti").select(F.col("id").alias("_id"), F.col("reach").alias("_reach"), F.col("ids").alias("_ids"), F.col("path").alias("_path"))
    placed = settled.unionByName(going.withColumn("up", F.lit(None).cast("string"))).join(above, F.col("up") == F.col("_id"), "left")
    reach = F.when(F.col("up") == root, "in").when(F.col("up") == F.lit(drive_root), "out").otherwise(F.coalesce("_reach", F.lit("orphan")))
    ids = F.concat(F.coalesce("_ids", F.array().cast("array<string>")), "ids")
    shown = (reach != "orphan") & (F.size(ids) <= cap + 1)
    path = F.concat_ws(" / ", "_path", F.array_join("names", " / "))
    found = placed.select("id", "name", "parent_id", reach.alias("reach"), F.when(shown, F.size(ids)).alias("depth"), F.when(shown, ids).alias("ids"), F.when(shown, path).alias("path"))
    lost = tree.join(gone.select("id").distinct(), "id", "left_semi").select("id", *(F.lit(None).cast(tree.schema[c].dataType).alias(c) for c in ("name", "parent_id", "reach", "depth", "ids", "path")))
    return scratch.save(found.unionByName(lost), "rewritten")


def merged(tree: DataFrame, rewritten: DataFrame) -> DataFrame:
    """``tree`` with the rows of ``after_changes`` in the place of its own."""
    return tree.join(rewritten.select("id"), "id", "left_anti").unionByName(rewritten.filter("reach IS NOT NULL").select(*tree.columns))
