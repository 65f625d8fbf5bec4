"""Vector codes: screening against full evaluation, codebooks against plain Python, odd vectors."""

import hashlib
import math

import numpy as np
import pytest

from siltstone.llm import vector_codes
from siltstone.llm.entry import ORACLES

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error int"


def plain(data, parts=8, entries=16, rounds=6, scale=4096):
    """(id, code, error, label_error, digest) of (id, vector, label) triples, in Python's integers throughout."""
    usable = [(i, v, g) for i, v, g in data if v and all(x is not None and math.isfinite(x) and abs(x) < 2**40 for x in v)]
    if not usable:
        return []
    vectors = [[math.floor(scale * x) for x in v] for _, v, _ in usable]
    dim = len(vectors[0])
    ends = [dim * p // parts for p in range(parts + 1)]
    order = sorted(range(len(usable)), key=lambda j: (usable[j][0] is None, usable[j][0] or 0, vectors[j]))
    books = [[vectors[j][a:b] for j in order[:entries]] for a, b in zip(ends, ends[1:])]
    apart = lambda x, y: sum((s - t) ** 2 for s, t in zip(x, y))

    def assigned():
        return [[min((apart(v[a:b], e), k) for k, e in enumerate(book)) for a, b, book in zip(ends, ends[1:], books)] for v in vectors]

    for _ in range(rounds):
        got = assigned()
        for p, (a, b) in enumerate(zip(ends, ends[1:])):
            for k in range(len(books[p])):
                own = [v[a:b] for v, g in zip(vectors, got) if g[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    got = assigned()
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in g) for g in got]
    by_label = {}
    for (_, _, label), e in zip(usable, errors):
        by_label[label] = by_label.get(label, 0) + e
    return sorted(((i, "".join(f"{k:02x}" for _, k in g), e, by_label[label], digest) for (i, _, label), g, e in zip(usable, got, errors)), key=repr)


def coded(spark, data, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in data], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in vector_codes.compress(df, **kw).collect()), key=repr)


@pytest.mark.parametrize("size", [3, 1000, 1 << 24, 1 << 27, 1 << 45])
def test_nearest_equals_full_evaluation(size):
    rng = np.random.default_rng(size)
    rows, book = rng.integers(-size, size, (500, 8)), rng.integers(-size, size, (16, 8))
    book[5], book[9] = book[2], book[2] + (np.arange(8) == 3)
    rows[:50] = book[rng.integers(0, 16, 50)]
    rows[50:100] = (book[2] + book[9]) // 2
    best, error = vector_codes.nearest(rows, book)
    full = [[sum((int(x) - int(y)) ** 2 for x, y in zip(r, e)) for e in book] for r in rows]
    assert best.tolist() == [f.index(min(f)) for f in full] and list(map(int, error)) == list(map(min, full))


def test_screening_leaves_few_entries(monkeypatch):
    rng = np.random.default_rng(1)
    rows, book, evaluated = rng.integers(-400, 400, (2000, 8)), rng.integers(-400, 400, (16, 8)), []
    whole = vector_codes.exact
    monkeypatch.setattr(vector_codes, "exact", lambda x, y: evaluated.append(len(x)) or whole(x, y))
    vector_codes.nearest(rows, book)
    assert evaluated[-1] == 2000 and sum(evaluated[:-1]) < 200


@pytest.mark.parametrize("dim", [64, 13, 5])
def test_codes_equal_plain_python(spark, dim):
    rng = np.random.default_rng(dim)
    data = [(i, rng.normal(0, 0.2, dim).tolist(), [None, 1, 2, 7][i % 4] if i % 3 else 1) for i in range(120)]
    data += [(3, [0.0] * dim, 1), (3, [-1e-9] * dim, 1), (None, [0.5] * dim, None), (None, data[9][1], 4), (-2, data[7][1], 2)]
    odd = [(500, None, 1), (501, [None] + [0.1] * (dim - 1), 1), (502, [math.nan] + [0.1] * (dim - 1), 1), (503, [math.inf] * dim, None), (504, [1e300] * dim, None), (505, [], 1)]
    assert coded(spark, data + odd + [(506, [0.1] * (dim + 1), 1)]) == plain(data)


def test_large_components_and_few_vectors(spark):
    data = [(i, [float(2 ** (20 + i)), 3.0 * i, -(2.0**31), 0.25] * 4, 1) for i in range(5)] + [(9, [1.0] * 16, None)]
    assert coded(spark, data) == [(i, c, e if e < 1 << 63 else None, x if x < 1 << 63 else None, d) for i, c, e, x, d in plain(data)]
    assert coded(spark, data[:1]) == plain(data[:1])


def test_ties_go_to_the_smaller_index(spark):
    data = [(i, [float(i // 4 % 2)] * 8, 1) for i in range(40)]
    assert coded(spark, data) == plain(data)


def test_nothing_to_code(spark):
    assert coded(spark, []) == [] and coded(spark, [(1, None, 1), (2, [], 1), (3, [math.nan] * 8, 1)]) == []
    with pytest.raises(ValueError):
        coded(spark, [], entries=300)


def test_sql_takes_six_rounds():
    assert ORACLES["op12_vector_codes"].count("AS MATERIALIZED") == 2 + 7 + 6
