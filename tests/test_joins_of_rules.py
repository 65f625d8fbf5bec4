"""Word similarity, assignment by components, pieces by joins and JSON values, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.functions import json as J, text as X
from siltstone.operators import matching as M, reports as P, resolution as R


def ordered(text):
    return [("  " + w + " ")[i : i + 3] for w in text.split() for i in range(len(w) + 1)]


def extents(a, b):
    own, t = set(ordered(a)), ordered(b)
    return max((len(own & set(t[i:j])) / len(own | set(t[i:j])) for i in range(len(t)) for j in range(i + 1, len(t) + 1)), default=0.0)


@pytest.fixture(scope="module")
def phrases():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abn") for _ in range(rng.choice([1, 2, 3, 5])))
    return [" ".join(word() for _ in range(rng.choice([1, 2, 3]))) for _ in range(12)], [" ".join(word() for _ in range(rng.choice([0, 1, 3, 7]))) for _ in range(60)]


def test_word_similarity_is_the_best_extent(spark, phrases):
    pairs = [(a, b) for a in phrases[0] for b in phrases[1]] + [("word", "two words"), ("", "a"), ("a", ""), (None, "a"), ("a", None)]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", X.word_similarity(F.col("a"), F.col("b")).alias("s"))
    for r in df.collect():
        assert r.s == (None if r.a is None or r.b is None else extents(r.a, r.b))
    assert extents("word", "two words") == 0.8


@pytest.mark.parametrize("least", [0.3, 0.6, 1.0])
def test_word_matches_lose_no_pair(spark, phrases, least):
    texts = spark.createDataFrame([*enumerate(phrases[1]), (900, None), (901, "  ")], "id long, text string")
    asked = spark.createDataFrame([*enumerate(phrases[0]), (900, None), (901, "--")], "q long, phrase string")
    want = {(q, i): extents(a, b) for q, a in enumerate(phrases[0]) for i, b in enumerate(phrases[1]) if extents(a, b) >= least}
    assert {(r.q, r.id): r.score for r in M.word_matches(texts, asked, least).collect()} == want


def greedy(scores, threshold):
    hits = set()
    for d, e, g, s in sorted(scores, key=lambda r: (-r[3], r[1], r[2])):
        if s >= threshold and not any(h[0] == d and (h[1] == e or h[2] == g) for h in hits):
            hits.add((d, e, g))
    return hits


@pytest.mark.parametrize("one_task", [0, 5, 10**6])
def test_assignment_by_components_and_in_rounds(spark, one_task):
    rng = random.Random(one_task)
    scores = [(d, e, g, rng.choice([0.2, 0.5, 0.6, 0.9])) for d in "ab" for e in range(14) for g in range(14) if rng.random() < 0.09]
    got = M.assign(spark.createDataFrame(scores, "deck string, e int, g int, score double"), 0.4, one_task)
    assert {(r.deck, r.e, r.g) for r in got.filter("hit").collect()} == greedy(scores, 0.4)


def test_a_chain_of_falling_scores_takes_few_jobs(spark):
    n = 10_000
    chain = spark.range(n).select(F.lit("d").alias("deck"), F.ceil(F.col("id") / 2).cast("int").alias("e"), F.floor(F.col("id") / 2).cast("int").alias("g"), (1 - F.col("id") / (2 * n)).alias("score"))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("chain", "chain")
    try:
        hits = M.assign(chain, 0.1).filter("hit").count()
        assert hits == n // 2 and len(jobs.getJobIdsForGroup("chain")) < 400
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def one_by_one(found, pieces, least=0.8):
    holder, out = {}, {}
    for a, p, _, j in sorted(pieces, key=lambda r: r[1], reverse=True):
        if j:
            holder[j] = a
    for a, at, _, j, *_ in sorted(found, key=lambda r: (r[0] is not None, r[0] or "", r[1]), reverse=True):
        if j and not any(x[3] == j for x in pieces):
            holder[j] = a
    for account in {r[0] for r in found}:
        own = [r for r in pieces if r[0] == account]
        by_job = {j: p for _, p, _, j in sorted(own, key=lambda r: r[1], reverse=True) if j}
        by_name = {n.strip().lower(): p for _, p, n, _ in sorted(own, key=lambda r: r[1], reverse=True)}
        ids = {p for _, p, *_ in own}
        for a, at, name, job, match, confidence in sorted((r for r in found if r[0] == account), key=lambda r: r[1]):
            job, name = job if job and holder[job] == account else None, name.strip().lower()
            if job in by_job:
                piece, via = by_job[job], "job_number"
            elif match in ids and confidence is not None and confidence >= least:
                piece, via = match, "match"
            elif name in by_name:
                piece, via = by_name[name], "name"
            else:
                piece, via = f"new-{a or ''}-{at}", "new"
            by_name.setdefault(name, piece)
            if job:
                by_job.setdefault(job, piece)
            out[a, at] = piece, via
    return out


@pytest.mark.parametrize("seed", range(3))
def test_pieces_by_joins_equal_one_after_another(spark, seed):
    rng = random.Random(seed)
    accounts = ["a", "b", "c"]
    pieces = [(rng.choice([*accounts, "d"]), f"p{i}", f" Name {rng.randrange(8)}\t", f"J{i}" if rng.random() < 0.5 else None) for i in range(12)]
    found = [(a, at, f"name {rng.randrange(12)}", rng.choice([None, None, *(f"J{rng.randrange(25)}" for _ in range(3))]), rng.choice([None, f"p{rng.randrange(14)}"]), rng.choice([None, 0.5, 0.8, 0.9])) for a in accounts for at in range(60)]
    got = R.derived_pieces(spark.createDataFrame(found, "account string, position long, name string, job_number string, match_id string, confidence double"), spark.createDataFrame(pieces, "account string, piece_id string, name string, job_number string"))
    assert {(r.account, r.position): (r.piece_id, r.via) for r in got.collect()} == one_by_one(found, pieces)


def test_long_pointers_and_accounts_without_name(spark):
    found = [(None, i, f"n{(i + 1) // 2}", f"j{i // 2}", None, None) for i in range(300)]
    got = R.derived_pieces(spark.createDataFrame(found, "account string, position long, name string, job_number string, match_id string, confidence double"), spark.createDataFrame([], "account string, piece_id string, name string, job_number string"))
    assert {(r.position, r.piece_id) for r in got.collect()} == {(i, "new--0") for i in range(300)}


def test_json_values(spark):
    text = '{"a": {"b": [1, 2.5, "x", true, null, {}]}, "s": "t", "e": []}'
    df = spark.createDataFrame([(text,), ("no json",), (None,), ("[1]",)], "t string").select(J.parsed(F.col("t")).alias("j"))
    asked = df.select(*(J.kind(J.at(F.col("j"), f"$.a.b[{i}]")) for i in range(7)), J.array_length(J.at(F.col("j"), "$.a.b")), J.array_length(J.at(F.col("j"), "$.e")), J.array_length(J.at(F.col("j"), "$.s")), J.text_at(F.col("j"), "$.s"), J.text_at(F.col("j"), "$.a.b[4]"), J.kind(F.col("j"))).collect()
    assert tuple(asked[0]) == ("number", "number", "string", "boolean", "null", "object", None, 6, 0, None, "t", None, "object")
    assert set(asked[1]) == {None} == set(asked[2]) and asked[3][-1] == "array"


def test_unlogged_keys(spark):
    log = spark.createDataFrame([('{"key": "a"}',), ("broken",), (None,), ('{"key": null}',), ('{"key": 7}',)], "payload string")
    assert sorted(r.key for r in P.unlogged(spark.createDataFrame([("a",), ("b",), ("7",)], "key string"), log).collect()) == ["b"]
