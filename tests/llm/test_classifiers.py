"""Language and quality: held-out accuracy, and defined results for odd input."""

import random

import numpy as np
import pandas as pd

from siltstone.llm import language, quality
from tests.llm.cases import odd_docs

SYLLABLES = {"xa": "ka lo mi ne pu ra", "xb": "sch ung ein ber hei te", "xc": "éau què ion ment oir çé"}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang].split()) for _ in range(rng.choice([1, 2, 3]))) for _ in range(n)).capitalize() + "."


def test_languages_that_were_not_seen_in_training(spark):
    rng = random.Random(2)
    data = [(i, prose(rng, lang, rng.choice([8, 30, 200])), lang, "s") for i, lang in enumerate(sorted(SYLLABLES) * 60)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, score string").withColumn("held_out", language.held_out())
    model = language.fit(docs.filter("NOT held_out"), sample=40)
    assert len(model.langs) == 9
    got = language.predict(docs.filter("held_out"), model, prefix="_").toPandas()
    assert len(got) > 30 and (got._lang_pred == got.lang).mean() >= 0.98 and got._score.between(0, 1).all() and not got._rejected.any()
    assert model.predict("日本語のテキスト")[2]
    assert language.fit(docs.filter("NOT held_out"), sample=40).langs == model.langs


def test_odd_texts_have_a_defined_language(spark):
    docs = odd_docs(spark)
    model = language.fit(spark.createDataFrame([(1, "ab abc", "xa"), (2, None, "xb"), (3, "12", "xb"), (4, "q", None)], "doc_id long, text string, lang string"))
    got = language.predict(docs, model)
    assert got.columns == ["doc_id", "text", "n_tokens", "id", "lang_pred", "score", "rejected"] and got.count() == docs.count()
    for r in got.collect():
        letters = any(map(str.isalpha, r.text or ""))
        assert r.lang_pred == ("xa" if letters else "und") and 0 <= r.score <= 1 and (letters or r.rejected)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = language.fit(none)
    assert model.predict("abc") == ("und", 0.0, True) and language.predict(none, model).count() == 0
    scorer = quality.fit(none)
    assert quality.score(none, scorer).count() == 0 and scorer.poor("some text") < 0.5 and scorer.poor(" ") == 1


def corpus(n=400):
    rng = random.Random(4)
    docs, poor = [], []
    for i in range(n):
        text = prose(rng, rng.choice(sorted(SYLLABLES)), rng.choice([20, 60, 300]))
        kind = i % 12
        if kind == 0:
            text = " ".join(w + rng.choice(["$$$", "%%%", "&&&"]) for w in text.split())
        elif kind == 1:
            text = "!! ".join(text.upper().split())
        elif kind == 2:
            text = " ".join([text.split()[0]] * 80)
        elif kind == 3:
            text = " | ".join(text.split())
        docs.append((i, text))
        poor.append(kind < 4)
    return docs, np.array(poor)


def test_quality_without_labels(spark):
    docs, poor = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    scorer = quality.fit(df, sample=300)
    got = quality.score(df, scorer).toPandas().sort_values("doc_id")
    assert got.rejected.to_numpy()[poor].mean() >= 0.95 and got.rejected.to_numpy()[~poor].mean() <= 0.01


def test_expectation_maximisation_finds_the_better_voter():
    rng = np.random.default_rng(0)
    y = rng.random(20000) < 0.3
    right = (0.95, 0.9, 0.65)
    seen = ["".join("p" if (a ^ (rng.random() > r)) else "g" for r in right) for a in y]
    counts = pd.Series(seen).value_counts().rename_axis("pattern").reset_index(name="n")
    model = quality.fit_votes(counts)
    found = (model.tables[0, :, 1] + model.tables[1, :, 0]) / 2
    assert found[0] > found[1] > found[2] and abs(model.poor - 0.3) < 0.05


def test_odd_texts_have_a_defined_quality(spark):
    docs, _ = corpus(60)
    scorer = quality.fit(spark.createDataFrame(docs, "doc_id long, text string"))
    odd = odd_docs(spark).withColumnRenamed("id", "quality")
    got = quality.score(odd, scorer, prefix="_")
    assert got.count() == odd.count()
    for r in got.collect():
        assert 0 <= r._quality <= 1 and (bool((r.text or "").strip()) or r._rejected)
