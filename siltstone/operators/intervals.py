"""Trees as intervals: each folder has the number of its entry and of the last entry below it, so "below" is a range test.

A walk round the tree enters each folder, then what is below it, and leaves it. Each step of the walk knows the next one
from the folder's first child, next sibling and parent alone, so the walk is a linked list, whose steps are counted
from its end by pointer doubling: as many joins as the walk has binary digits, over rows of a few numbers, at any depth.
No folder has a list of those above it. Steps that run in a loop never end; when a round ends none, all left are such.

Siblings are put in order by a hash and their id, so a folder with any number of children is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from siltstone.sources.scratch import Scratch

#: Parts that the children of one folder are linked in; numbers that one task adds up.
PARTS, SPAN = 256, 1 << 16


def siblings(folders: DataFrame) -> DataFrame:
    """``folders`` (id, parent_id) with ``next``, the sibling after it, or null, and ``first``, whether it is the first."""
    placed = folders.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(PARTS)))
    order = Window.partitionBy("parent_id", "part").orderBy("id")
    own = placed.withColumn("next", F.lead("id").over(order)).withColumn("first", F.lag("id").over(order).isNull())
    heads = own.filter("first").select("parent_id", "part", "id")
    along = Window.partitionBy("parent_id").orderBy("part")  # at most PARTS rows of a folder
    heads = heads.withColumn("after", F.lead("id").over(along)).withColumn("leads", F.lag("id").over(along).isNull())
    of = heads.select(F.col("parent_id").alias("_parent"), F.col("part").alias("_part"), "after", "leads")
    linked = own.join(of, (F.col("parent_id") == F.col("_parent")) & (F.col("part") == F.col("_part")))
    return linked.select("id", "parent_id", F.coalesce("next", "after").alias("next"), (F.col("first") & F.col("leads")).alias("first"))


def intervals(folders: DataFrame, root: str, scratch: Scratch | None = None) -> DataFrame:
    """Rows (id, parent_id, entry, last, depth) of the folders (id, parent_id) below ``root``: what is below one has an entry in (entry, last].

    Entries run from 1 without a gap; ``depth`` is 1 right below the root. Folders whose chain does not end at the root,
    because a parent is missing or null or the chain loops, have no row. Ids are unique; a row of the root's own id is left out.
    """
    scratch = scratch or Scratch(folders.sparkSession)
    nodes = folders.select("id", "parent_id").filter((F.col("id") != root) & F.col("parent_id").isNotNull())
    linked = scratch.save(siblings(nodes), "siblings")
    child = linked.filter("first").select(F.col("parent_id").alias("of"), F.col("id").alias("child"))
    met = linked.join(child, F.col("id") == F.col("of"), "left")
    # a step is a folder and whether it is left; what follows it, and what it adds to entries and depth from there to the end
    enter = met.select("id", F.lit(False).alias("left"), F.coalesce("child", "id").alias("to"), F.col("child").isNull().alias("to_left"), F.lit(1).cast("long").alias("entries"), F.lit(1).cast("long").alias("depth"))
    leave = met.select("id", F.lit(True).alias("left"), F.coalesce("next", "parent_id").alias("to"), F.col("next").isNull().alias("to_left"), F.lit(0).cast("long").alias("entries"), F.lit(-1).cast("long").alias("depth"))
    own = F.when(F.col("to_left") & (F.col("to") == root), True)  # the walk is over when the root is left
    state = scratch.save(enter.unionByName(leave).withColumn("done", own), "walk-0")
    settled, going, left, turn = state.filter("done"), state.filter("done IS NULL"), None, 0
    while (n := going.count()) and n != left:
        left, turn = n, turn + 1
        ahead = settled.unionByName(going).select(F.col("id").alias("_id"), F.col("left").alias("_left"), F.col("to").alias("to2"), F.col("to_left").alias("to_left2"), F.col("entries").alias("entries2"), F.col("depth").alias("depth2"), F.col("done").alias("done2"))
        moved = going.join(ahead, (F.col("to") == F.col("_id")) & (F.col("to_left") == F.col("_left")))  # steps to a parent that is missing end here
        moved = moved.select("id", "left", F.col("to2").alias("to"), F.col("to_left2").alias("to_left"), (F.col("entries") + F.col("entries2")).alias("entries"), (F.col("depth") + F.col("depth2")).alias("depth"), F.col("done2").alias("done"))
        moved = scratch.save(moved, f"walk-{turn}")
        settled, going = settled.unionByName(moved.filter("done")), moved.filter("done IS NULL")
    both = settled.groupBy("id").agg(*(F.max(F.when(F.col("left") == side, F.col("entries"))).alias(name) for side, name in ((False, "on_entry"), (True, "on_leave"))), F.max(F.when(~F.col("left"), F.col("depth"))).alias("d"))
    both = scratch.save(both, "entries")
    total = both.agg(F.max("on_entry")).first()[0] or 0
    placed = nodes.join(both.filter("on_entry IS NOT NULL"), "id")
    entry = F.lit(total) - F.col("on_entry") + 1
    return placed.select("id", "parent_id", entry.alias("entry"), (entry + F.col("on_entry") - F.col("on_leave") - 1).alias("last"), (1 - F.col("d")).cast("int").alias("depth"))


def subtree_counts(tree: DataFrame) -> DataFrame:
    """For each folder, the folders below it: nothing has to be joined."""
    return tree.select("id", "depth", (F.col("last") - F.col("entry")).alias("below"))


def below(rows: DataFrame, tree: DataFrame, folder: str) -> DataFrame:
    """The rows (parent_id, ...) that lie anywhere below ``folder``, by one interval."""
    top = tree.filter(F.col("id") == folder).select(F.col("entry").alias("_from"), F.col("last").alias("_to"))  # one row
    inside = tree.join(F.broadcast(top), F.col("entry").between(F.col("_from"), F.col("_to"))).select(F.col("id").alias("_parent"))
    return rows.join(inside, F.col("parent_id") == F.col("_parent"), "left_semi")


def counts_below(rows: DataFrame, tree: DataFrame) -> DataFrame:
    """For each folder the rows (parent_id) right in it or anywhere below it: (id, n), the difference of two running sums.

    Running sums go by spans of ``SPAN`` entries, each in a task, and over the sums of spans, a row each.
    """
    own = rows.groupBy(F.col("parent_id").alias("_parent")).agg(F.count(F.lit(1)).alias("own"))
    each = tree.join(own, F.col("id") == F.col("_parent"), "left").select("id", "entry", "last", F.coalesce("own", F.lit(0)).alias("own"), F.floor(F.col("entry") / SPAN).alias("span"))
    each = Scratch(tree.sparkSession).save(each, "each")
    before = F.coalesce(F.sum("sum").over(Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = each.groupBy("span").agg(F.sum("own").alias("sum")).select(F.col("span").alias("_span"), before.alias("before"))
    within = F.sum("own").over(Window.partitionBy("span").orderBy("entry"))
    upto = each.withColumn("within", within).join(spans, F.col("span") == F.col("_span")).select("id", "entry", "last", "own", (F.col("before") + F.col("within")).alias("upto"))
    at_last = upto.select(F.col("entry").alias("_last"), F.col("upto").alias("upto_last"))
    return upto.join(at_last, F.col("last") == F.col("_last")).select("id", (F.col("upto_last") - F.col("upto") + F.col("own")).alias("n"))
