"""PPM over running bytes against a plain trie."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from siltstone.llm import entry, ppm, running
from tests.llm.cases import odd_docs
from tests.llm.test_ppm import held


class Plain:
    """The same model, one byte at a time."""

    def __init__(self, texts):
        self.seen = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
        for s in map(self.symbols, texts):
            for i in range(ppm.ORDER, len(s)):
                for j in range(ppm.ORDER + 1):
                    self.seen[j][s[i - j : i]][s[i]] += 1

    @staticmethod
    def symbols(text):
        return bytes([ppm.PAD] * ppm.ORDER) + (text or "").encode().lower() + bytes([ppm.TEXT_END])

    def log10(self, text):
        total, s = 0.0, self.symbols(text)
        for i in range(ppm.ORDER, len(s)):
            hidden, p = set(), 1.0
            for j in range(ppm.ORDER, -1, -1):
                n = {k: v for k, v in self.seen[j][s[i - j : i]].items() if k not in hidden}
                if not n:
                    continue
                room = sum(n.values()) + len(n)
                if s[i] in n:
                    p *= n[s[i]] / room
                    break
                p *= len(n) / room
                hidden |= n.keys()
            else:
                p /= 256 - len(hidden)
            total += math.log10(p)
        return total


@pytest.mark.parametrize("small", [False, True])
def test_scores_equal_the_plain_model(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(running, "BLOCK", 300)
        monkeypatch.setattr(running, "PIECE", 64)
    rng = random.Random(1)
    data = [(i, " ".join("".join(rng.choice(["ka", "Lo", "mi", "é", "nu"]) for _ in range(rng.choice([1, 2, 3]))) for _ in range(20))) for i in range(40)]
    docs = spark.createDataFrame(data, "doc_id long, text string").unionByName(odd_docs(spark).select("doc_id", "text"))
    docs = docs.withColumn("score", F.lit("clash")).withColumn("row", F.lit(1))
    every = [(r.doc_id, r.text) for r in docs.collect()]
    train = [t for i, t in every if not held(i)]
    plain, c = Plain(train), Counter(w for t in train for w in (t or "").encode().lower().split())
    n, v = sum(c.values()) + len(train), len(c) + 1
    log = lambda x: math.log10((x + 1) / (n + v + 1))
    want = []
    for i, t in every:
        w = (t or "").encode().lower().split()
        want.append((i, held(i), len(w) + 1, 1 + sum(c[x] > 0 for x in w), n, round(sum(log(c[x]) for x in w) + log(len(train)), 6), round(plain.log10(t), 6)))
    flag = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = running.score(docs.repartition(3), held_out=flag)
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_the_query_tells_fluent_text_from_its_shuffled_words(spark, tmp_path):
    fluent = "the cat sat on the mat and the dog lay by the door"
    shuffled = "door the by lay dog the and mat the on sat cat the"
    rows = [(i, fluent) for i in range(100, 140)] + [(1, fluent), (2, shuffled)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    score = {r.doc_id: r.score for r in entry.op10_lm_scoring(spark, str(tmp_path)).collect()}
    assert score[1] > score[2] + 5


def test_no_rows_and_no_training(spark):
    assert running.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = running.score(spark.createDataFrame([(1, "ab")], "doc_id long, text string"), held_out=F.lit(True)).first()
    assert got.n_known == 0 and got.train_tokens == 0 and got.base_score == 0 and abs(got.score + 3 * math.log10(256)) < 1e-9
