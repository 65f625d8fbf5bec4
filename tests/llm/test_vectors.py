"""Operators on embeddings against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import embedding_dedup, neighbours
from tests.llm.cases import rows

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, score int"


def sample(n=300, dim=24, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 6, dim))
    out = [(i, (base[i % len(base)] + rng.standard_normal(dim) * (0.05 + 0.4 * rng.random())).astype("f4").tolist(), int(i % 3) if i % 11 else None, "x", 1) for i in range(n)]
    out += [(1000 + i, out[7][1], out[7][2], "x", 1) for i in range(40)] + [(1200, [2 * x for x in out[7][1]], out[7][2], "x", 1)]
    odd = [None, [], [0.0] * dim, [None] * dim, [NAN] + [1.0] * (dim - 1), [INF] * dim, [1.0] * (dim + 1), [1.0, -0.0], [1.0, 0.0], [1e38, 1e38], [1e-30] * dim]
    return out + [(2000 + i, v, 0, "x", 1) for i, v in enumerate(odd)] + [(None, out[0][1], 0, "x", 1)]


def good(v):
    return v and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute_links(data, threshold):
    link = {}
    for i, (a, u, g, *_) in enumerate(data):
        for b, v, h, *_ in data[:i]:
            if a is not None and b is not None and g is not None and g == h and good(u) and good(v) and len(u) == len(v):
                u64, v64 = np.array(u), np.array(v)
                if u64 @ v64 / (np.linalg.norm(u64) * np.linalg.norm(v64)) >= threshold:
                    link.setdefault(a, set()).add(b)
                    link.setdefault(b, set()).add(a)
    return link


def reach(link, a):
    seen, todo = {a}, [a]
    while todo:
        for b in link.get(todo.pop(), ()):
            if b not in seen:
                seen.add(b)
                todo.append(b)
    return min(seen)


@pytest.mark.parametrize("tile", [1024, 16])
def test_links_and_components(spark, tile):
    data = sample()
    link = brute_links(data, 0.93)
    assert sum(map(len, link.values())) > 1000
    want = [(a, len(link.get(a, ())), reach(link, a), True if reach(link, a) == a else False) for a, *_ in data if a is not None] + [(None, 0, None, None)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(data, SCHEMA).repartition(5), tile=tile)
    assert rows(got, "vec_id", "n_links", "component_id", "kept") == sorted(want, key=repr)


def test_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert embedding_dedup.near_duplicates(none).count() == 0
    assert neighbours.nearest(none, F.col("vec_id") % 100 == 0).count() == 0


def test_suffix_bounds_lose_no_pair():
    rng = np.random.default_rng(3)
    x = np.repeat(rng.standard_normal((40, 64)), 3, 0) + 0.2 * rng.standard_normal((120, 64))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    side = {"turned": unit.astype("f4"), "own": x, "norm": np.linalg.norm(x, axis=1), "rest": np.stack([np.linalg.norm(unit[:, k:], axis=1) for k in (16, 32, 64)], 1)}
    i, j = embedding_dedup.compare(side, None, 0.9)
    assert {*zip(i.tolist(), j.tolist())} == {(a, b) for a in range(120) for b in range(a + 1, 120) if unit[a] @ unit[b] >= 0.9}


def brute_nearest(data, k, is_query):
    parts = [(a, np.array(v, np.float64)) for a, v, *_ in data if a is not None and good(v)]
    out = []
    for a, u in parts:
        if is_query(a):
            near = sorted((math.sqrt(((u - v) ** 2).sum()), b) for b, v in parts if b != a and len(v) == len(u))[:k]
            out += [(a, r + 1, b, round(d, 9)) for r, (d, b) in enumerate(near)]
    return sorted(out, key=repr)


def test_nearest_with_ties_and_odd_vectors(spark):
    data = sample()
    got = neighbours.nearest(spark.createDataFrame(data, SCHEMA).repartition(3), F.col("vec_id") % 10 == 0, 10).withColumn("score", F.round("score", 9))
    assert rows(got, "query_id", "rank", "vec_id", "score") == brute_nearest(data, 10, lambda a: a % 10 == 0)


@pytest.mark.parametrize(("n", "parts", "kind"), [(1, 1, "float"), (2, 2, "double"), (7, 1, "double"), (12, 12, "float"), (12, 24, "double"), (50, 24, "double")])
def test_few_vectors_in_any_partitions(spark, n, parts, kind):
    rng = np.random.default_rng(n)
    data = [(i, rng.standard_normal(8).astype("f4").tolist()) for i in range(n)]
    v = spark.createDataFrame(data, f"vec_id long, embedding array<{kind}>").repartition(parts)
    got = neighbours.nearest(v, F.lit(True)).withColumn("score", F.round("score", 9))
    assert rows(got, "query_id", "rank", "vec_id", "score") == brute_nearest(data, 10, lambda a: True)


def test_first_bounds_from_a_sample_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS", 16)
    rng = np.random.default_rng(4)
    data = [(i, rng.standard_normal(16).tolist()) for i in range(400)] + [(1000 + i, [1.0] * 16) for i in range(30)]
    v = spark.createDataFrame(data, "id long, vector array<double>").repartition(24)
    centre = neighbours.mean(v, 16)
    got = neighbours.search(neighbours.index(v, 16, centre), v.filter("id % 10 = 0"), 16, centre, block=20, sample=60).withColumn("score", F.round("score", 9))
    assert rows(got, "query_id", "rank", "id", "score") == brute_nearest(data, 10, lambda a: a % 10 == 0)


def test_doubles_keep_their_precision(spark):
    data = [(0, [1.0, 1e-9]), (1, [1.0, 2e-9]), (2, [1.0, 4e-9]), (10, [1e300, 1e300]), (11, [1e300, 1.0000001e300]), (20, [1e-60, 1e-60]), (21, [1e-60, 1.00001e-60]), (22, [1e-200, -1e-200])]
    v = spark.createDataFrame([(*r, 0) for r in data], "vec_id long, embedding array<double>, label int")
    near = {(r.query_id, r.vec_id): r.score for r in neighbours.nearest(v, F.lit(True), 7).collect()}
    assert near[0, 1] == 2e-9 - 1e-9 and near[1, 2] == 4e-9 - 2e-9 and 0 < near[20, 21] < 2e-65
    assert near[10, 11] == pytest.approx(1e293, rel=1e-6) and all(near[10, i] == pytest.approx(math.sqrt(2) * 1e300) for i in (0, 1, 2, 20, 21, 22))
    links = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(v).collect()}
    assert links == {0: (2, 0), 1: (2, 0), 2: (2, 0), 10: (3, 10), 11: (3, 10), 20: (3, 10), 21: (3, 10), 22: (0, 22)}


def test_rows_that_repeat_an_id_count_by_the_smallest_vector(spark):
    data = [(1, [3.0, 4.0]), (1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [1.0, 3.0])]
    got = neighbours.nearest(spark.createDataFrame(data, "vec_id long, embedding array<float>"), F.col("vec_id") == 2)
    assert rows(got, "rank", "vec_id", "score") == [(1, 1, 1.0), (2, 3, 2.0)]


def test_blocks_of_queries_change_nothing(spark, monkeypatch):
    data = [r for r in sample() if good(r[1]) and len(r[1]) == 24 and r[0] is not None]
    v = spark.createDataFrame(data, SCHEMA).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    centre = neighbours.mean(v, 24)
    coded = neighbours.index(v, 24, centre)
    monkeypatch.setattr(neighbours, "ROWS", 50)
    monkeypatch.setattr(neighbours, "COLUMNS", 7)
    got = neighbours.search(coded, v.filter("id % 10 = 0"), 24, centre, block=9).withColumn("score", F.round("score", 9))
    assert rows(got, "query_id", "rank", "id", "score") == brute_nearest(data, 10, lambda a: a % 10 == 0)
