"""A quality classifier without gold labels.

Overlapping heuristics vote on each document: poor, good, or nothing. How far each of them is to be trusted is
estimated by expectation-maximisation over the counts of all vote patterns, of which there are at most 3 to the
number of heuristics however large the corpus is. The posteriors then label a sample of at most ``sample`` documents,
drawn by a hash of id and text, on which a linear scorer over hashed word shapes is trained; it decides on all
documents. A shape keeps a word's marks and the kinds of its characters, and tells whether the word was just said, so
the scorer works alike for short and long texts of any language.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from siltstone.llm.batches import others, release

BITS = 15
POOR, GOOD, NONE = "p", "g", "-"
SYMBOLS = "#$%&*|<>{}=~^\\`@+"
VOTERS = 8


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """For each code point 1: capital, 2: other letter, 3: symbol, 4: white space, 5: digit, 0: anything else."""
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        x = chr(c)
        table[c] = (1 if x.isupper() else 2) if x.isalpha() else 3 if x in SYMBOLS else 4 if x.isspace() else 5 if x.isdigit() else 0
    return table


def vote(value: float, good_to: float, poor_from: float) -> str:
    return POOR if value >= poor_from else GOOD if value <= good_to else NONE


def votes(text: str | None) -> str:
    """One letter per heuristic; each abstains where a text gives too little to judge."""
    words = text.split() if text else []
    if not words:
        return NONE * VOTERS
    n, frequencies, raw = len(words), Counter(words), text.encode("utf-8", "replace")
    other, capital, small, symbol, _, digit = np.bincount(kinds()[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")], minlength=6).tolist()
    letters, shown = max(1, capital + small), other + capital + small + symbol + digit
    return "".join((
        vote(symbol / shown, 0.02, 0.10),  # symbols among characters
        vote(capital / letters, 0.25, 0.60) if n >= 5 else NONE,  # capitals among letters
        vote((text.count("!!") + text.count("??")) / n, 0.05, 0.30) if n >= 3 else NONE,  # doubled marks a word
        vote(frequencies.most_common(1)[0][1] / n, 0.15, 0.30) if n >= 20 else NONE,  # the most frequent word
        vote(1 - len(frequencies) / n, 0.50, 0.65) if n >= 20 else NONE,  # words said before
        vote(sum(map(operator.eq, words, words[1:])) / n, 0.05, 0.25) if n >= 10 else NONE,  # words said twice over
        vote(1 - len(zlib.compress(raw, 1)) / len(raw), 0.75, 0.85) if len(raw) >= 300 else NONE,  # what compression saves
        vote((other + symbol) / shown, 0.10, 0.25) if n >= 5 else NONE,  # characters other than letters and digits
    ))


#: Characters of a word that make one shape.
LONGEST = 200


def in_slices(words: list[str]) -> list[str]:
    """``words`` with long ones in slices, so that all of a text without white space counts and a shape stays small."""
    if max(map(len, words), default=0) <= LONGEST:
        return words
    return [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]


class Shapes(dict):
    """The hash of a word's shape, worked out once per distinct word of a task."""

    runs = ((re.compile(r"[^\W\d_]+"), lambda m: "A" if m[0].isupper() else "Aa" if m[0][0].isupper() else "a"), (re.compile(r"\d+"), "0"))

    def __missing__(self, word: str) -> int:
        shape = word
        for pattern, by in self.runs:
            shape = pattern.sub(by, shape)
        if len(self) > 100_000:
            self.clear()
        self[word] = h = zlib.crc32(shape.encode("utf-8", "replace"))
        return h


SHAPES = Shapes()


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of the shapes of words and of pairs of words, scaled to length 1."""
    words = in_slices(text.split())
    shape = np.fromiter(map(SHAPES.__getitem__, words), np.uint32, len(words))
    shape[1:] += np.fromiter(map(operator.eq, words, words[1:]), bool, max(0, len(words) - 1)) * np.uint32(0x51ED270B)
    both = np.concatenate([shape, shape[1:] * np.uint32(31) + shape[:-1]])
    at, n = np.unique((both * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS), return_counts=True)
    value = np.sqrt(n)
    return at, value / (np.linalg.norm(value) or 1)


@dataclass
class LabelModel:
    """``poor`` is the share of poor documents; ``tables[y, i, v]`` the chance that heuristic i, if it votes, votes v on class y."""

    poor: float
    tables: np.ndarray

    def posterior(self, pattern: str) -> float:
        return float(self.posteriors([pattern])[0])

    def posteriors(self, patterns: list[str]) -> np.ndarray:
        cast = np.array([[(POOR + GOOD + NONE).index(v) for v in p] for p in patterns])
        at = np.arange(self.tables.shape[1])
        log = [np.log(self.tables[y, at, cast]).sum(1) + np.log(prior) for y, prior in ((0, 1 - self.poor), (1, self.poor))]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


def fit_votes(patterns: pd.DataFrame, rounds: int = 50) -> LabelModel:
    """EM over (pattern, n), which starts by believing any vote for poor; 0.5 documents are added to each cell."""
    patterns = patterns.sort_values("pattern")
    seen, n = list(patterns.pattern), patterns.n.to_numpy(float)
    y = np.array([0.9 if POOR in p else 0.02 if GOOD in p else 0.1 for p in seen])
    cast = np.array([[(POOR + GOOD + NONE).index(v) for v in p] for p in seen])
    for _ in range(rounds):
        tables = np.full((2, cast.shape[1], 3), 0.5)
        for k, weight in ((0, n * (1 - y)), (1, n * y)):
            for i in range(cast.shape[1]):
                np.add.at(tables[k, i], cast[:, i], weight)
        tables /= tables[:, :, :2].sum(2, keepdims=True)
        tables[:, :, 2] = 1.0  # an abstention tells nothing
        model = LabelModel(float(np.clip((n * y).sum() / n.sum(), 1e-6, 1 - 1e-6)), tables)
        y = model.posteriors(seen)
    return model


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float
    labels: LabelModel

    def poor(self, text: str | None) -> float:
        """The probability that a text is poor; 1 for a text without words."""
        if not text or not text.strip():
            return 1.0
        at, value = features(text)
        return float(1 / (1 + np.exp(-np.clip(value @ self.weights[at] + self.bias, -500, 500))))


def train(docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, rounds: int = 150, rate: float = 0.5, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on the features of documents, by Adam over all rows at once; classes weigh alike."""
    rows = np.repeat(np.arange(len(docs)), [len(at) for at, _ in docs])
    at, value = np.concatenate([at.astype(np.int64) for at, _ in docs]), np.concatenate([x for _, x in docs])
    share = np.array([max(1e-9, (1 - y).mean()), max(1e-9, y.mean())])
    weight = (1 - y) / share[0] + y / share[1]
    w, b, m, v = np.zeros(1 << BITS), 0.0, np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(rows, value * w[at], minlength=len(docs)) + b
        error = weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / len(docs)
        g = np.append(np.bincount(at, value * error[rows], minlength=1 << BITS) + decay * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def fit(docs: DataFrame, sample: int = 3000, id_col: str = "doc_id", text_col: str = "text") -> Scorer:
    """Votes on all documents, estimates the voters, and trains the scorer; without texts it rejects nothing but blanks.

    Null texts take no part and blank ones abstain. Rows that repeat are drawn, or not, together.
    """
    own = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL")

    @F.pandas_udf("string")
    def cast(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield part.map(votes)
        release()

    patterns = own.groupBy(cast("text").alias("pattern")).agg(F.count(F.lit(1)).alias("n")).toPandas()
    if not len(patterns):
        return Scorer(np.zeros(1 << BITS), -1.0, LabelModel(0.1, np.full((2, VOTERS, 3), 1 / 3)))
    labels = fit_votes(patterns)
    share = min(1.0, 1.2 * sample / patterns.n.sum())
    draw = F.xxhash64("id", "text")
    blank = F.col("text").rlike(r"^[\s\p{Z}\x1c-\x1f\x85]*$")
    few = own.filter((F.pmod(draw, F.lit(1 << 30)) < share * (1 << 30)) & ~blank).select(draw.alias("draw"), "text")

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            part = part[part.text.map(lambda t: bool(t.split()))]
            at, value = zip(*map(features, part.text)) if len(part) else ((), ())
            yield pd.DataFrame({"draw": part.draw, "pattern": part.text.map(votes), "at": [a.astype(np.int32) for a in at], "value": list(value)})
        SHAPES.clear()
        release()

    # a row is at most 2^BITS features long, however long its text is
    drawn = few.mapInPandas(described, "draw long, pattern string, at array<int>, value array<double>").orderBy("draw").limit(sample).toPandas()
    if not len(drawn):
        return Scorer(np.zeros(1 << BITS), -1.0, labels)
    weights, bias = train(list(zip(map(np.asarray, drawn["at"]), map(np.asarray, drawn.value))), labels.posteriors(drawn.pattern.tolist()))
    return Scorer(weights.astype(np.float32), bias, labels)


def score(docs: DataFrame, scorer: Scorer, text_col: str = "text", threshold: float = 0.5, prefix: str = "") -> DataFrame:
    """``docs`` with ``quality`` (0 to 1) and ``rejected`` (quality at most 1 - threshold).

    A null or blank text has quality 0 and is rejected. Equal texts get equal results, repeated rows stay, and an empty table
    gives no rows. A column of ``docs`` that has the name of a result gives way to it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([1 - shared.value.poor(t) for t in part], dtype=float)
        SHAPES.clear()
        release()

    quality, rejected = prefix + "quality", prefix + "rejected"
    # so that a filter on the result waits for it; else Spark puts a second call below the filter
    found = docs.select(*others(docs, quality, rejected), run.asNondeterministic()(F.col(text_col).cast("string")).alias(quality))
    return found.withColumn(rejected, F.col(quality) <= 1 - threshold)
