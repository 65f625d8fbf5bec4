"""Trees: two plans give the same rows; loops, orphans, duplicates and the depth cap have defined results."""

import random

from pyspark.sql import functions as F

from siltstone.operators import hierarchy as T
from siltstone.sources.listing import FOLDER, listed_tree

SCHEMA = "id string, name string, parent_id string, position int"


def tree(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA)


def found(df, *cols):
    return {r["id"]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()}


ROWS = [("a", "A", "root"), ("b", "B", "a"), ("c", "C", "b"), ("d", "D", "drive"), ("e", "E", "d"), ("x", "X", "gone"), ("y", "Y", "x"), ("l1", "L", "l2"), ("l2", "L", "l1"), ("s", "S", "s"), ("n", "N", None)]


def test_reach_and_paths(spark):
    got = found(T.resolve(tree(spark, ROWS), "root", "drive"), "reach", "depth", "path")
    assert got["c"] == ("in", 3, "A / B / C") and got["e"] == ("out", 2, "D / E") and got["a"] == ("in", 1, "A")
    assert {i for i, r in got.items() if r == ("orphan", None, None)} == {"x", "y", "l1", "l2", "s", "n"}


def test_root_comes_before_drive_root(spark):
    assert found(T.resolve(tree(spark, ROWS), "root", "root"), "reach")["c"] == "in"


def test_depth_cap(spark):
    rows = [(f"f{i}", str(i), f"f{i - 1}" if i else "root") for i in range(130)]
    got = found(T.resolve(tree(spark, rows), "root"), "depth")
    assert got["f100"] == 101 and got["f101"] is None
    counts = T.reach_counts(T.resolve(tree(spark, rows), "root")).first()
    assert counts.n_in == 101 + counts.n_beyond_cap - 0 or counts.n_in + counts.n_orphan == 130


def test_first_listing_wins(spark):
    got = T.first_listed(tree(spark, [("a", "new", "root"), ("a", "old", "b")])).first()
    assert (got.name, got.parent_id) == ("new", "root")


class Memory:
    def __init__(self, df):
        self.df = df

    def entries(self, spark):
        return self.df


def test_sweep_equals_walk(spark):
    rng = random.Random(3)
    rows = [(f"n{i}", f"name{i}", "root" if rng.random() < 0.1 else f"n{rng.randrange(60)}") for i in range(60)]
    store = Memory(tree(spark, rows).withColumn("mime_type", F.lit(FOLDER)).withColumn("trashed", F.lit(False)))
    flat, walk = (found(listed_tree(store, spark, "root", flat_allowed=x), "parent_id", "depth") for x in (True, False))
    assert flat == walk and flat


def test_owners_caps_and_counts(spark):
    resolved = T.resolve(tree(spark, ROWS), "root", "drive")
    owners = spark.createDataFrame([("a", "one"), ("b", "two"), ("d", "three")], "folder_id string, owner string")
    assert found(T.nearest_owner(resolved, owners), "owner") == {"a": "one", "b": "two", "c": "two", "d": "three", "e": "three", "x": None, "y": None, "l1": None, "l2": None, "s": None, "n": None}
    assert found(T.subtree_counts(resolved), "below") == {"a": 2, "b": 1, "c": 0}
    assert found(T.capped(resolved, 1), "hidden") == {"a": 2}
    assert found(T.capped(resolved, 1, spark.createDataFrame([("c",)], "folder_id string")), "hidden") == {"a": 1, "c": 0}
    assert T.depth_cap_for(resolved, spark.createDataFrame([("b",)], "folder_id string")).first().cap == 3
    files = spark.createDataFrame([("f1", "c"), ("f2", "root"), ("f3", "zzz"), ("f4", None)], "file string, parent_id string")
    assert {r.file for r in T.outside_map(files, resolved.filter("reach = 'in'").select("id"), "root").collect()} == {"f3", "f4"}
    assert T.shallowest(resolved.filter("depth IS NOT NULL"), "b").first().id == "b"
