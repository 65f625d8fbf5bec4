"""Trees as intervals against a plain walk: loops, orphans, deep chains and a folder with very many children."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import intervals as I


def plain(pairs, root):
    """id: (depth, ids below) of the folders below the root."""
    children = {}
    for i, p in pairs:
        if p is not None and i != root:
            children.setdefault(p, []).append(i)
    out = {}

    def walk(at, depth):
        got = set()
        for c in children.get(at, []):
            got |= {c} | walk(c, depth + 1)
        if at != root:
            out[at] = depth, got
        return got

    walk(root, 0)
    return out


def check(spark, pairs, root="root"):
    tree = I.intervals(spark.createDataFrame(pairs, "id string, parent_id string"), root)
    got = {r.id: r for r in tree.collect()}
    want = plain(pairs, root)
    assert {i: r.depth for i, r in got.items()} == {i: d for i, (d, _) in want.items()}
    assert sorted(r.entry for r in got.values()) == list(range(1, len(want) + 1))
    for i, (_, ids) in want.items():
        assert {j for j, r in got.items() if got[i].entry < r.entry <= got[i].last} == ids
    return tree


@pytest.mark.parametrize("seed", range(2))
def test_random_forests_with_loops_and_orphans(spark, seed):
    rng = random.Random(seed)
    names = [f"f{i}" for i in range(60)]
    pairs = [(n, rng.choice(["root", *names[: max(1, i)]]) if rng.random() < 0.85 else rng.choice(["gone", None, rng.choice(names)])) for i, n in enumerate(names)]
    tree = check(spark, [*pairs, ("root", "drive"), ("l1", "l2"), ("l2", "l1"), ("self", "self"), ("under", "l1")])
    files = [(i, rng.choice([*names, "root", "gone", None])) for i in range(200)]
    df = spark.createDataFrame(files, "file int, parent_id string")
    want = plain(pairs, "root")
    assert {r.id: r.n for r in I.counts_below(df, tree).collect()} == {i: sum(p == i or p in ids for _, p in files) for i, (_, ids) in want.items()}
    some = max(want, key=lambda i: len(want[i][1]))
    assert sorted(r.file for r in I.below(df, tree, some).collect()) == [f for f, p in files if p == some or p in want[some][1]]
    assert {r.id: r.below for r in I.subtree_counts(tree).collect()} == {i: len(ids) for i, (_, ids) in want.items()}


def test_a_chain_and_a_wide_folder(spark):
    pairs = [(f"c{i}", f"c{i - 1}" if i else "root") for i in range(150)] + [(f"w{i}", "c3") for i in range(700)]
    check(spark, pairs)


def test_nothing_below_the_root(spark):
    assert check(spark, [("a", "b"), ("b", "a"), ("root", None)]).count() == 0
    assert I.intervals(spark.createDataFrame([], "id string, parent_id string"), "root").count() == 0


def test_sums_over_spans(spark, monkeypatch):
    monkeypatch.setattr(I, "SPAN", 4)
    tree = check(spark, [("a", "root"), ("b", "a"), ("c", "a"), *((f"d{i}", "c") for i in range(12))])
    files = spark.range(24).select(F.concat(F.lit("d"), (F.col("id") % 12).cast("string")).alias("parent_id"))
    assert {r.id: r.n for r in I.counts_below(files, tree).collect()} == {"a": 24, "b": 0, "c": 24, **{f"d{i}": 2 for i in range(12)}}
