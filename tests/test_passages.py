"""Passages against whole texts, in blocks and parts."""

import random

import pytest

from siltstone.functions import text as X
from siltstone.operators import matching as M


def grams(text: str) -> set[str]:
    return {f"  {w} "[i : i + 3] for w in text.split() for i in range(len(w) + 1)}


@pytest.mark.parametrize("part", [2, 3, 7, 1 << 20])
def test_trigrams_as_integers_are_those_of_the_text(monkeypatch, part):
    monkeypatch.setattr(M, "TEXT_CHARS", part)
    rng = random.Random(part)
    for _ in range(200):
        text = " ".join("".join(rng.choice("abé𝒳") for _ in range(rng.choice([1, 2, 5]))) for _ in range(rng.choice([1, 2, 9])))
        assert sorted("".join(chr(int(c) >> s & 0x1FFFFF) for s in (42, 21, 0)) for c in M.trigram_codes(text)) == sorted(grams(text))
    assert len(M.trigram_codes("")) == 0


def test_marks_go_and_letters_stay():
    assert X.bare("Crème ﬁ Å 日本 ก็ \U0001d4b3́") == "Creme fi A 日本 ก X"


@pytest.mark.parametrize("chars", [1, 120, 1 << 20])
def test_texts_meet_blocks_of_passages_without_a_join(spark, monkeypatch, chars):
    """Neither blocks nor ids that are strings change the scores; no pair of a text and a passage is made before it is scored."""
    monkeypatch.setattr(M, "PASSAGE_CHARS", chars)
    rng = random.Random(chars)
    word = lambda: "".join(rng.choice(["ka", "lo", "mi", "nu"]) for _ in range(rng.choice([1, 2])))
    passages = [(f"p{i}", " ".join(word() for _ in range(rng.choice([2, 9, 14])))) for i in range(9)] + [("blank", " ."), ("none", None), ("twin", "ka lo mi nu ka lo mi nu ka")]
    texts = [(f"t{i}", " ".join(word() for _ in range(rng.choice([3, 20, 90])))) for i in range(25)] + [("holds", f"x {passages[3][1]} {passages[-1][1]} y"), ("null", None), ("empty", "")]
    runs = lambda s: {tuple(w[i : i + 5]) for w in [s.split()] for i in range(len(w) - 4)}
    want = {}
    for e, t in texts:
        for g, p in passages:
            a, b = grams(t or ""), grams((p or "").strip(" ."))
            score = max(len(a & b) / len(a | b) if a and b else 0, len(runs(t or "") & runs(p or "")) / max(1, len(runs(p or ""))))
            if score >= 0.4:
                want[e, g] = score
    got = M.passage_scores(spark.createDataFrame(texts, "e string, text string"), spark.createDataFrame(passages, "g string, text string"), 0.4)
    rows = got.collect()
    assert {(r.e, r.g): r.score for r in rows} == want and len(rows) == len(want)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_no_passages_score_nothing(spark):
    texts, passages = spark.createDataFrame([(1, "a b")], "e long, text string"), spark.createDataFrame([("x", None)], "g string, text string")
    got = M.passage_scores(texts, passages, 0.3)
    assert got.count() == 0 and [f.simpleString() for f in got.schema] == ["e:bigint", "g:string", "score:double"]
