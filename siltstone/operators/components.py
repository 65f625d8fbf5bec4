"""Connected components of an undirected graph, by star contraction over DataFrames.

Each round every node adopts the smallest label among its own and its neighbours', then labels are replaced by their
own labels (pointer jumping), and edges are rewritten between labels until none is left. Rounds grow with the logarithm
of the longest path. Labels and edges are written to scratch tables each round, so lineage stays short and a lost
executor costs one round. Neighbour minima are aggregated before the shuffle, so there a hub with any number of edges is
one row per task. Rewriting is a join on the labels, where a hub's edges share a key: they are rows of two numbers, and
the engine splits a partition that is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltstone.sources.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch | None = None, name: str = "cc", most_rounds: int = 60) -> DataFrame:
    """Rows (node, component) for all nodes of ``edges`` (columns a, b): the smallest node that can be reached.

    Self-loops and repeated edges do no harm; edges with a null end are left out; an empty graph gives no rows.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    edges = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    live = scratch.save(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-e0")
    steps: list[DataFrame] = []
    for i in range(most_rounds):
        if live.isEmpty():
            break
        # each label that has a smaller neighbour hooks onto the smallest one: a forest, as labels only fall
        hooks = live.groupBy("a").agg(F.min("b").alias("b"))
        for j in range(2):  # two jumps along the hooks
            up = hooks.select(F.col("a").alias("b"), F.col("b").alias("top"))
            hooks = hooks.join(up, "b", "left").select("a", F.coalesce("top", "b").alias("b"))
            hooks = scratch.save(hooks, f"{name}-h{i}-{j}")
        steps.append(hooks)
        one = hooks.select(F.col("a").alias("old"), F.col("b").alias("new"))
        moved = live.join(one, live.a == one.old, "left").select(F.coalesce("new", "a").alias("a"), "b")
        moved = moved.join(one, moved.b == one.old, "left").select("a", F.coalesce("new", "b").alias("b"))
        live = scratch.save(moved.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-e{i + 1}")
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    labels = nodes.withColumn("component", F.col("node"))
    for hooks in steps:
        one = hooks.select(F.col("a").alias("old"), F.col("b").alias("new"))
        labels = labels.join(one, labels.component == one.old, "left").select("node", F.coalesce("new", "component").alias("component"))
    return scratch.save(labels, f"{name}-labels")
