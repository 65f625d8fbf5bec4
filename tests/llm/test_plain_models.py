"""The classifiers against plain versions that work document by document, without hash tables, counts or samples."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from siltstone.llm import language, quality
from tests.llm.test_classifiers import SYLLABLES, corpus, prose


def plain_grams(text):
    data = " " + " ".join("".join(c if ord(c) >= 128 or c.isalpha() else " " for c in text.lower()).split()) + " "
    raw, out = data.encode(), {}
    for i in range(len(raw) - 2):
        h = raw[i]
        for b in raw[i + 1 : i + 3]:
            h = (h * 0x9E3779B1 + b) % 2**32
        at = (h * 0x85EBCA6B) % 2**32 >> (32 - language.BITS)
        out[at] = out.get(at, 0) + 1
    return out


def plain_language(docs, k):
    """Centroids by language for (text, lang) in drawing order, and the weights of buckets."""
    df, grams = {}, [plain_grams(t) for t, _ in docs]
    for g in grams:
        for at in g:
            df[at] = df.get(at, 0) + 1
    idf = lambda at: math.log((1 + len(docs)) / (1 + df.get(at, 0))) + 1

    def vector(g):
        v = {at: math.log1p(n) * idf(at) for at, n in g.items()}
        size = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {at: x / size for at, x in v.items()}

    dot = lambda a, b: sum(x * b.get(at, 0.0) for at, x in a.items())
    centroids = []
    for lang in sorted({g for _, g in docs}):
        own = [vector(g) for g, (_, of) in zip(grams, docs) if of == lang]
        chosen = [own[0]]
        while len(chosen) < min(k, len(own)):
            chosen.append(min(own, key=lambda v: max(dot(v, c) for c in chosen)))
        for _ in range(12):
            groups = [[] for _ in chosen]
            for v in own:
                groups[max(range(len(chosen)), key=lambda i: dot(v, chosen[i]))].append(v)
            for i, group in enumerate(groups):
                if group:
                    total = {}
                    for v in group:
                        for at, x in v.items():
                            total[at] = total.get(at, 0) + x
                    size = math.sqrt(sum(x * x for x in total.values()))
                    chosen[i] = {at: x / size for at, x in total.items()}
        centroids += [(lang, c) for c in chosen]
    return lambda text: max((round(dot(vector(plain_grams(text)), c), 6), lang) for lang, c in centroids)


def test_language_equals_the_plain_model(spark):
    rng = random.Random(8)
    data = [(i, prose(rng, lang, rng.choice([8, 30, 60])), lang) for i, lang in enumerate(sorted(SYLLABLES) * 12)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    ordered = [(r.text, r.lang) for r in docs.orderBy(F.xxhash64(F.col("doc_id"), F.col("text"))).collect()]
    plain = plain_language(ordered, 3)
    got = language.predict(docs, language.fit(docs)).collect()
    for r in got:
        score, lang = plain(r.text)
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-4)


def test_more_languages_than_a_broadcast_holds(spark, monkeypatch):
    rng = random.Random(5)
    data = [(i, prose(rng, lang, 30), lang) for i, lang in enumerate(sorted(SYLLABLES) * 12)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = language.fit(docs)
    want = [(r.doc_id, r.lang_pred, round(r.score, 9), r.rejected) for r in language.predict(docs, model).orderBy("doc_id").collect()]
    monkeypatch.setattr(language, "SLICE", 1)
    assert len(model.slices()) == 3
    assert [(r.doc_id, r.lang_pred, round(r.score, 9), r.rejected) for r in language.predict(docs, model).orderBy("doc_id").collect()] == want


def test_one_odd_training_text_moves_no_floor(spark):
    rng = random.Random(6)
    data = [(i, prose(rng, "xa", 40), "xa") for i in range(60)]
    odd = data + [(999, "zzzz qqqq xxxx jjjj", "xa")]
    floors = [min(language.fit(spark.createDataFrame(d, "doc_id long, text string, lang string"), per_language=1).floors) for d in (data, odd)]
    assert floors[1] > 0.5 * floors[0]


def test_columns_that_share_a_name_with_a_result_give_way(spark):
    docs = spark.createDataFrame([(1, "ab abc", "xa", 7, 8)], "doc_id long, text string, lang string, _found int, score int")
    got = language.predict(docs, language.fit(docs))
    assert got.columns == ["doc_id", "text", "lang", "_found", "lang_pred", "score", "rejected"] and got.first()._found == 7
    scored = quality.score(docs.withColumnRenamed("score", "Quality"), quality.fit(docs))
    assert scored.columns == ["doc_id", "text", "lang", "_found", "quality", "rejected"] and 0 <= scored.first().quality <= 1


def plain_posteriors(patterns, rounds=50):
    """Expectation-maximisation, a document at a time."""
    y = [0.9 if "p" in p else 0.02 if "g" in p else 0.1 for p in patterns]
    for _ in range(rounds):
        poor = min(max(sum(y) / len(y), 1e-6), 1 - 1e-6)
        chance = {}
        for k in (0, 1):
            for i in range(len(patterns[0])):
                n = {v: 0.5 for v in "pg"}
                for p, w in zip(patterns, y):
                    if p[i] != "-":
                        n[p[i]] += w if k else 1 - w
                chance[k, i] = {v: n[v] / (n["p"] + n["g"]) for v in "pg"}
        score = lambda p, k: math.log(poor if k else 1 - poor) + sum(math.log(chance[k, i][v]) for i, v in enumerate(p) if v != "-")
        y = [1 / (1 + math.exp(min(500, max(-500, score(p, 0) - score(p, 1))))) for p in patterns]
    return np.array(y)


def test_quality_equals_the_plain_model(spark):
    docs, _ = corpus(150)
    y = plain_posteriors([quality.votes(t) for _, t in docs])
    x = np.zeros((len(docs), 1 << quality.BITS))
    for row, (_, text) in zip(x, docs):
        at, value = quality.features(text)
        row[at] = value
    weight = np.where(y[:, None] >= 0, 1, 1)[:, 0] * ((1 - y) / (1 - y).mean() + y / y.mean())
    w, b, m, v = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for t in range(1, 151):
        error = weight * (1 / (1 + np.exp(-(x @ w + b))) - y) / len(docs)
        g = np.append(x.T @ error + 1e-4 * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.5 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    want = 1 - 1 / (1 + np.exp(-(x @ w + b)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.quality for r in quality.score(df, quality.fit(df)).collect()}
    assert np.allclose([got[i] for i, _ in docs], want, atol=2e-3)


def test_most_documents_may_be_poor():
    rng = np.random.default_rng(1)
    y = rng.random(20000) < 0.7
    seen = ["".join("p" if (a ^ (rng.random() > r)) else "g" for r in (0.95, 0.92, 0.9)) for a in y]
    counts = pd.Series(seen).value_counts().rename_axis("pattern").reset_index(name="n")
    assert abs(quality.fit_votes(counts).poor - 0.7) < 0.05


def test_ties_and_repeated_rows_have_equal_quality(spark):
    docs, _ = corpus(60)
    df = spark.createDataFrame(docs + docs[:5] + [(7000 + i, t) for i, t in docs[:5]], "doc_id long, text string")
    got = quality.score(df, quality.fit(df)).collect()
    assert len(got) == 70 and all(len({r.quality for r in got if r.text == t}) == 1 for _, t in docs[:5])
