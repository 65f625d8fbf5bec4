"""Near-duplicate documents against brute force over full sets."""

import random

import pytest

from siltstone.llm import minhash_dedup
from siltstone.llm.words import shingles
from siltstone.operators.components import components
from tests.llm.cases import odd_docs, rows


def brute(docs, k, percent=80):
    sets = []
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets.append((i, {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()))
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (a, s) in enumerate(sets):
        for b, t in sets[:n]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), find(i), find(i) == i) for i, s in sets if i is not None), key=repr)


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    out = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 5, 12, 60, 200]))]
        out.append(" ".join(base))
        for _ in range(rng.randrange(6)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            out.append(rng.choice([" ", "\n", "  "]).join(copy).replace("a", rng.choice("aA")))
    hub = [word() for _ in range(70)]
    for _ in range(60):  # copies of which many are no links of each other
        copy = list(hub)
        for _ in range(rng.randrange(1, 7)):
            copy[rng.randrange(len(copy))] = word()
        out.append(" ".join(copy))
    passage = [word() for _ in range(60)]
    out += [" ".join([word() for _ in range(rng.randrange(30))] + passage + [word() for _ in range(rng.randrange(30))]) for _ in range(40)]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize(("rounds", "pairs", "tile"), [(2, 64, 256), (1, 0, 2), (1, 3, 256)])
def test_components_equal_brute_force(spark, monkeypatch, rounds, pairs, tile):
    monkeypatch.setattr(minhash_dedup, "ROUNDS", rounds)
    monkeypatch.setattr(minhash_dedup, "FEW_PAIRS", pairs)
    monkeypatch.setattr(minhash_dedup, "TILE", tile)
    monkeypatch.setattr(minhash_dedup, "COLUMNS", 50 * tile)
    docs = corpus() + [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two three"), (906, "One Two\tThree")]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), shingle=4)
    assert rows(got, "doc_id", "n_shingles", "component_id", "kept") == brute(docs, 4)


def test_odd_texts_and_clashing_columns(spark):
    docs = odd_docs(spark).filter("doc_id IS NOT NULL AND text <> 'again'")
    want = brute(sorted({(r.doc_id, r.text) for r in docs.collect()}, key=repr), 5)
    got = minhash_dedup.near_duplicates(docs.withColumn("kept", docs.id), shingle=5)
    assert sorted(set(rows(got, "doc_id", "n_shingles", "component_id", "kept")), key=repr) == want
    assert got.count() == docs.count()
    with_null = minhash_dedup.near_duplicates(spark.createDataFrame([(None, "a b c d e"), (4, "x")], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.kept) for r in with_null} == {(None, None), (4, True)}


def test_two_texts_of_one_id_keep_their_links(spark):
    base = [f"w{i}" for i in range(60)]
    near = " ".join(base[:-1] + ["other"])
    docs = spark.createDataFrame([(1, "quite another text of its own"), (1, " ".join(base)), (2, near), (3, "alone")], "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles): r.component_id for r in minhash_dedup.near_duplicates(docs).collect()}
    assert got == {(1, 3): 1, (1, 57): 1, (2, 57): 1, (3, 1): 3}


def test_deduplication_keeps_whole_rows_whatever_their_ids(spark):
    base = [f"w{i}" for i in range(80)]
    copy = " ".join(base[:-1] + ["other"])
    data = [
        (5, " ".join(base), "a"), (6, copy, "b"), (None, copy, "c"), (None, "a clean text without an id at all", "d"), (7, "first text under seven for good", "e"), (7, "second text under seven also stays", "f"),
        (8, "the same row twice over and over", "g"), (8, "the same row twice over and over", "g"), (9, None, "h"), (9, None, "h"), (10, " ", "i"),
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string, key string").repartition(3)
    got = minhash_dedup.deduplicated(docs)
    assert got.columns == docs.columns
    assert sorted(r.key for r in got.collect()) == ["a", "d", "e", "f", "g", "h", "h", "i"]
    assert minhash_dedup.deduplicated(docs.limit(0)).count() == 0


def test_marks_lose_no_key(spark, monkeypatch):
    from siltstone.llm import marks

    for words in (1, 4, 1 << 20):
        monkeypatch.setattr(marks, "WORDS", words)
        wanted = spark.range(0, 300, 3).select("id")
        marked = marks.marks(wanted, "id")
        assert marked.count() <= words
        hit = {r.id for r in marks.maybe(spark.range(600), "id", marked).collect()}
        missed = {r.id for r in marks.maybe(spark.range(600), "id", marked, "left_anti").collect()}
        assert set(range(0, 300, 3)) <= hit and not hit & missed and hit | missed == set(range(600))
    assert len(hit) == 100
    assert marks.maybe(spark.range(5), "id", marks.marks(spark.range(0), "id")).count() == 0


def test_empty_table(spark):
    assert minhash_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_both_ends_of_a_permutation_estimate_similarity():
    factors, terms = minhash_dedup.permutations(400)
    a, b = (" ".join(f"w{i}" for i in range(x, x + 200)) for x in (0, 40))
    x, y = (minhash_dedup.signature(shingles(t, 1), factors, terms) for t in (a, b))
    assert abs((x == y).mean() - 160 / 240) < 0.05
    assert abs((x == y)[:400].mean() - (x == y)[400:].mean()) < 0.1


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(100, 150)] + [(300, 300), (None, 4), (401, 400), (400, 401)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in [*range(100, 150), 200]}, 300: 300, 400: 400, 401: 400}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
