"""Trees kept up to date under changes, against a full rebuild after each."""

import random

import pytest

from siltstone.operators import hierarchy as T

SCHEMA = "id string, name string, parent_id string"


@pytest.mark.parametrize("cap", [100, 3])
def test_random_changes_equal_a_full_rebuild(spark, cap):
    rng = random.Random(cap)
    state = {f"f{i}": (f"n{i}", rng.choice(["root", "drive", *(f"f{j}" for j in range(i))])) for i in range(40)}
    rows = lambda: spark.createDataFrame([(i, n, p) for i, (n, p) in state.items()], SCHEMA)
    tree = T.resolve(rows(), "root", "drive", cap)
    for step in range(3):
        ids = sorted(state)
        changes = {i: (f"m{step}", rng.choice([*ids, "root", "gone", None, "drive"])) for i in rng.sample(ids, 4)} | {f"new{step}": ("new", rng.choice(ids))}
        gone = [i for i in rng.sample(ids, 2) if i not in changes]
        state = {i: x for i, x in (state | changes).items() if i not in gone}
        rewritten = T.after_changes(tree, spark.createDataFrame([(i, n, p) for i, (n, p) in changes.items()], SCHEMA), spark.createDataFrame([(i,) for i in gone], "id string"), "root", "drive", cap)
        tree = T.merged(tree, rewritten)
        want = T.resolve(rows(), "root", "drive", cap).select(*tree.columns)
        assert sorted(map(tuple, tree.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_what_is_written_follows_the_change(spark):
    pairs = [(f"a{i}", "a", "root" if i == 0 else f"a{(i - 1) // 3}") for i in range(300)]
    tree = T.resolve(spark.createDataFrame(pairs, SCHEMA), "root")
    none = spark.createDataFrame([], "id string")
    rewritten = T.after_changes(tree, spark.createDataFrame([("a90", "moved", "a5")], SCHEMA), none, "root")
    below = [i for i in range(300) if i == 90 or (i - 1) // 3 == 90]
    assert sorted(r.id for r in rewritten.collect()) == sorted(f"a{i}" for i in below)
    assert {r.path for r in rewritten.filter("id = 'a90'").collect()} == {"a / a / a / moved"}
