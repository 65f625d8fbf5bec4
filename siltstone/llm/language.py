"""Language identification by the nearest of several centroids per language.

A text is the vector of its byte trigrams (lower-cased, everything but letters as blanks), hashed, weighted by TF-IDF
and scaled to length 1. Document frequencies come from all training rows. The centroids of a language come from
spherical k-means over a sample of its rows of at most ``sample`` documents, drawn by a hash of id and text. A text gets
the language of the centroid with the largest cosine and is rejected if even that is smaller than the language's floor: half
of a low quantile of the cosines in its sample, which one odd training text does not move.

A model has ``per_language`` rows of 2^BITS numbers a language, which is all that the driver holds; it is broadcast in slices
of ``SLICE`` languages.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from siltstone.llm.batches import others, release
from siltstone.llm.hashing import counts

BITS, GRAM = 14, 3
#: Languages that one broadcast holds.
SLICE = 256
#: The share of a sample, and the smallest sample, of which the least cosines do not count for the floor.
QUANTILE, FEWEST = 0.005, 20
#: ASCII bytes other than letters count as blanks.
BLANK = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
UNKNOWN = "und"


def grams(text: str) -> np.ndarray:
    """Trigram counts; runs of blanks shrink to one, and one stands at either end."""
    return counts(b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(BLANK).split()) + b" ", GRAM, BITS)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def unit(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(tf) * idf
    return v / (np.linalg.norm(v) or 1.0)


@dataclass
class LanguageModel:
    """``centroids`` has a row per entry of ``langs``; ``floors`` is the least cosine that is not rejected."""

    langs: list[str]
    centroids: np.ndarray
    floors: np.ndarray
    idf: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0, True
        near = self.centroids @ unit(grams(text), self.idf)
        best = int(near.argmax())
        return self.langs[best], float(min(1.0, max(0.0, near[best]))), bool(near[best] < self.floors[best])

    def slices(self) -> list[LanguageModel]:
        """Models of at most ``SLICE`` languages each, in order; one that knows nothing, if there are none."""
        starts = [i for i in range(len(self.langs)) if i == 0 or self.langs[i] != self.langs[i - 1]][::SLICE]
        ends = [*starts[1:], len(self.langs)]
        return [LanguageModel(self.langs[a:b], self.centroids[a:b], self.floors[a:b], self.idf) for a, b in zip(starts, ends)] or [self]


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = 3, sample: int = 400, floor: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learns from the rows of ``docs`` with a language and at least one letter; without such rows all is rejected.

    Null ids and repeated rows count like any others; rows equal in id, text and language are drawn in any order.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(1 << BITS, np.int64), Counter()
        for batch in batches:
            for text in batch.column("text"):
                df += grams(text.as_py()) > 0
            n.update(batch.column("lang").to_pylist())
        at = df.nonzero()[0]
        release()
        yield pa.RecordBatch.from_arrays([pa.array([None] * len(at) + list(n), pa.string()), pa.array(np.append(at, np.full(len(n), -1)), pa.int64()), pa.array(np.append(df[at], list(n.values())), pa.int64())], names=["lang", "bucket", "n"])

    seen = known.select("text", "lang").mapInArrow(frequencies, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    sizes, df = seen[seen.lang.notna()], seen[seen.lang.isna()]
    total = float(sizes.n.sum())
    idf = np.full(1 << BITS, np.log(1.0 + total) + 1.0)
    idf[df.bucket.to_numpy(int)] = np.log((1.0 + total) / (1.0 + df.n.to_numpy(float))) + 1.0
    if not len(sizes):
        return LanguageModel([], np.zeros((0, 1 << BITS)), np.zeros(0), idf)
    draw = F.xxhash64("id", "text")
    # a row per language, far smaller than the model that the driver holds anyway
    below = docs.sparkSession.createDataFrame([(lang, int(min(1.0, 2.0 * sample / n) * (1 << 30))) for lang, n in zip(sizes.lang, sizes.n.tolist())], "of string, below long")
    few = known.join(F.broadcast(below), F.col("lang") == F.col("of")).filter(F.pmod(draw, F.lit(1 << 30)) < F.col("below")).select("lang", draw.alias("draw"), "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [unit(grams(t.as_py()), idf) for t in batch.column("text")]
            at = [v.nonzero()[0].astype("<i4") for v in own]
            packed = [pa.array(list(map(bytes, x)), pa.binary()) for x in (at, [v[a].astype("<f4") for v, a in zip(own, at)])]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("draw"), *packed], names=["lang", "draw", "at", "value"])
        release()

    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    drawn = few.mapInArrow(vectors, "lang string, draw long, at binary, value binary").withColumn("rank", rank).filter(F.col("rank") <= sample)

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rank")
        vectors = np.zeros((len(group), 1 << BITS), np.float32)
        for v, at, value in zip(vectors, group["at"], group.value):
            v[np.frombuffer(at, "<i4")] = np.frombuffer(value, "<f4")
        centroids, least = spherical(vectors, per_language)
        return pd.DataFrame({"lang": group.lang.iloc[0], "centroid": [c.astype("<f4").tobytes() for c in centroids], "floor": floor * least})

    fitted = drawn.groupBy("lang").applyInPandas(cluster, "lang string, centroid binary, floor double").toPandas()
    fitted = fitted.sort_values(["lang", "centroid"])
    centroids = np.array([np.frombuffer(c, "<f4") for c in fitted.centroid], np.float32).reshape(-1, 1 << BITS)
    return LanguageModel(fitted.lang.tolist(), centroids, fitted.floor.to_numpy(float), idf)


def spherical(vectors: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, float]:
    """At most k centroids by spherical k-means, from the first vector and always the farthest one; and the least cosine that counts."""
    chosen = [0]
    for _ in range(1, min(k, len(vectors))):
        chosen.append(int((vectors @ vectors[chosen].T).max(1).argmin()))
    centroids = vectors[chosen]
    for _ in range(rounds):
        nearest = (vectors @ centroids.T).argmax(1)
        sums = np.array([vectors[nearest == i].sum(0) if (nearest == i).any() else centroids[i] for i in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    cosines = np.sort((vectors @ centroids.T).max(1))
    return centroids, float(cosines[max(1, round(QUANTILE * len(cosines))) if len(cosines) >= FEWEST else 0])


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``.

    A text that is null or has no letter gets ``und``, 0 and is rejected. Ties go to the language that sorts first. Repeated
    rows stay, an empty table gives no rows. A column of ``docs`` that has the name of a result gives way to it.
    """
    names = [prefix + c for c in ("lang_pred", "score", "rejected")]

    def nearest_of(part: LanguageModel):
        shared = docs.sparkSession.sparkContext.broadcast(part)

        @F.pandas_udf("lang_pred string, score double, rejected boolean")
        def nearest(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for batch in texts:
                yield pd.DataFrame([shared.value.predict(t) for t in batch], columns=["lang_pred", "score", "rejected"])
            release()

        # so that a filter on the result waits for it; else Spark puts a second call below the filter
        return nearest.asNondeterministic()(F.col(text_col).cast("string"))

    kept, found = others(docs, *names), [nearest_of(part) for part in model.slices()]
    both = docs.select(F.struct(*kept).alias("row"), F.array(*found).alias("found"))
    best = F.aggregate(F.slice("found", 2, len(found)), F.col("found")[0], lambda a, b: F.when(b["score"] > a["score"], b).otherwise(a)) if len(found) > 1 else F.col("found")[0]
    return both.select("row", best.alias("best")).select("row.*", *(F.col(f"best.{c}").alias(n) for c, n in zip(("lang_pred", "score", "rejected"), names)))
