"""PPM against a plain trie, and the unigram base against plain counts."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import ppm
from tests.llm.cases import odd_docs


def symbols(unit):
    if unit[:1] == b" ":
        return [ppm.SPACE_START, *unit[1:-1], ppm.TEXT_END if unit[-1:] == b"$" else ppm.UNIT_END]
    return [ppm.WORD_START, *unit, ppm.UNIT_END]


def units(text):
    raw = (text or "").encode().lower()
    *spaces, last = ppm.NOT_SPACE.split(raw)
    return raw.split() + [b" %b>" % s for s in spaces] + [b" %b$" % last]


class Plain:
    """The same model, one byte at a time."""

    def __init__(self, texts):
        self.seen = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
        for t in texts:
            for u in units(t):
                s = symbols(u)
                for i in range(1, len(s)):
                    for j in range(ppm.ORDER + 1):
                        self.seen[j][self.context(s, i, j)][s[i]] += 1

    @staticmethod
    def context(s, i, j):
        return tuple(([ppm.PAD] * ppm.ORDER + s[:i])[len(s[:i]) + ppm.ORDER - j :])

    def log10(self, text):
        total = 0.0
        for u in units(text):
            s = symbols(u)
            for i in range(1, len(s)):
                hidden, p = set(), 1.0
                for j in range(ppm.ORDER, -1, -1):
                    n = {k: v for k, v in self.seen[j][self.context(s, i, j)].items() if k not in hidden}
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


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


@pytest.mark.parametrize("small", [False, True])
def test_scores_equal_the_plain_model(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(ppm, "ENTRIES", 20)
        monkeypatch.setattr(ppm, "UNITS", 10)
        monkeypatch.setattr(ppm, "MOST", 3)
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
    got = ppm.score(docs.repartition(3), held_out=flag)
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_a_context_gives_out_one_in_all():
    texts = [b"banana", b"bandana", b"ban", b" >", b"  >", b" $"]
    key, _ = ppm.grams(texts)
    own, n = np.unique(key, return_counts=True)
    levels = ppm.Level.stack(own, n, range(ppm.ORDER + 1))
    for context in [*{int(k) >> 8 for k in own}, 0x6161616161, 0xFFFFFFFFF8]:
        p = 10 ** ppm.log_probabilities((context << 8) | np.arange(256), levels)
        assert abs(p.sum() - 1) < 1e-9


def test_no_rows_and_no_training(spark):
    assert ppm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = ppm.score(spark.createDataFrame([(1, "ab")], "doc_id long, text string"), held_out=F.lit(True)).first()
    assert got.n_known == 0 and got.train_tokens == 0 and got.base_score == 0 and abs(got.score + 5 * math.log10(256)) < 1e-9
