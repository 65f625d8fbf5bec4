"""Nearest neighbours by randomly rotated one-bit codes.

Indexing turns each vector, less the mean of all, by a seeded random rotation and keeps one bit per dimension, the
vector's length, and how well the bits point its way (a correction scalar). A query's inner product with the bits,
divided by that scalar, is an unbiased estimate of its product with the vector, off by more than a bound that shrinks
with the root of the dimension only with small probability. So the bits alone give each candidate a lower bound of
its distance, and only vectors whose bound lies below the k-th best distance known so far are measured in full.

Queries go through in blocks of about ``BLOCK_BYTES``, which is what is broadcast at once. For each block a sample of the
index first gives every query an upper bound of its k-th distance; then one pass over the whole index returns only what
lies within it, so what a task returns does not grow with the number of tasks. The result of a block is saved and its
broadcast destroyed before the next one begins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from siltstone.llm.vectors import even, matrix, packed, usable
from siltstone.sources.scratch import Scratch

#: Candidates and queries that meet at once.
ROWS, COLUMNS = 2048, 512
#: Bytes of queries that are broadcast at once; rows of the index that give the first bounds.
BLOCK_BYTES, SAMPLE = 1 << 25, 50_000
#: What single precision may take from a bound, as a share of the squared lengths.
SLACK = 1e-5
NOBODY = np.iinfo(np.int64).max


def rotation(dim: int, seed: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))[0]


def mean(vectors: DataFrame, dim: int, exponent: int = 0) -> np.ndarray:
    """The mean of the column ``vector`` in units of 2^exponent, from d + 1 numbers of each task."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim + 1)
        for batch in batches:
            total += np.append(np.ldexp(matrix(batch.column("vector"), dim), -exponent).sum(0), len(batch))
        yield pa.RecordBatch.from_pydict({"at": np.arange(dim + 1), "value": total})

    rows = vectors.select("vector").mapInArrow(partial, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(dim + 1)
    for r in rows:
        total[r["at"]] = r["value"]
    return total[:dim] / max(1.0, total[dim])


def index(vectors: DataFrame, dim: int, centre: np.ndarray, seed: int = 3, exponent: int = 0) -> DataFrame:
    """Rows (id, vector, bits, length, scalar) for rows (id, vector) whose vectors have ``dim`` components.

    ``vector`` holds the components as they came, in double precision; the codes are made in units of 2^exponent.
    """
    turn = rotation(dim, seed)
    id_type = vectors.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = matrix(batch.column("vector"), dim)
            turned = (np.ldexp(own, -exponent) - centre) @ turn
            length = np.linalg.norm(turned, axis=1)
            scalar = np.abs(turned).sum(1) / np.sqrt(dim) / np.maximum(length, 1e-300)
            bits = packed(np.packbits(turned > 0, axis=1))
            yield pa.RecordBatch.from_arrays([batch.column("id"), packed(own), bits, pa.array(length), pa.array(scalar)], names=["id", "vector", "bits", "length", "scalar"])

    return vectors.select("id", "vector").mapInArrow(run, f"id {id_type}, vector binary, bits binary, length double, scalar double")


class Best:
    """The k nearest found so far for each query of a block, none beyond its bound."""

    def __init__(self, bound: np.ndarray, k: int):
        self.k, self.distance, self.id = k, np.repeat(bound[:, None], k, axis=1), np.full((len(bound), k), NOBODY)

    def add(self, q: np.ndarray, ids: np.ndarray, distance: np.ndarray) -> None:
        """Takes in candidates, of which ``q`` gives the queries in ascending order; each pair comes once."""
        own, starts = np.unique(q, return_index=True)
        for at, low, high in zip(own.tolist(), starts.tolist(), [*starts[1:].tolist(), len(q)]):
            d, i = np.append(self.distance[at], distance[low:high]), np.append(self.id[at], ids[low:high])
            order = np.lexsort((i, d))[: self.k]
            self.distance[at], self.id[at] = d[order], i[order]


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows, also where their squares leave the range of doubles."""
    with np.errstate(over="ignore", under="ignore"):
        apart = x - y
        plain = np.sqrt((apart**2).sum(1))
        odd = ~np.isfinite(plain) | (plain < 1e-140)
        if odd.any():
            most = np.abs(x[odd] / 2 - y[odd] / 2).max(1)
            unit = (x[odd] / 2 - y[odd] / 2) / np.where(most > 0, most, 1.0)[:, None]
            plain[odd] = 2 * most * np.sqrt((unit**2).sum(1))
    return plain


def search(coded: DataFrame, queries: DataFrame, dim: int, centre: np.ndarray, k: int = 10, seed: int = 3, width: float = 3.5, block: int | None = None, exponent: int = 0, sample: int = SAMPLE, scratch: Scratch | None = None) -> DataFrame:
    """Rows (query_id, rank, id, score): for each row (id, vector) of ``queries`` its k nearest others in ``coded``.

    Ids are distinct in either table. Neither ``block``, the queries that go through at once, nor ``sample`` changes the result.
    """
    spark, scratch = coded.sparkSession, scratch or Scratch(coded.sparkSession)
    turn = rotation(dim, seed)
    block = block or max(256, BLOCK_BYTES // (12 * dim))
    blocks, every = int(np.ceil(queries.count() / block)), coded.count() // max(1, sample)
    found = []

    def passed(rows: DataFrame, shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids_q, own_q, turned_q, bound = shared.value
            length_q = np.linalg.norm(turned_q.astype(np.float64), axis=1)
            best = Best(bound, k)
            for batch in batches:
                for at in range(0, len(batch), ROWS):
                    part = batch.slice(at, ROWS)
                    near(best, part, ids_q, own_q, turned_q, length_q)
            hit = best.id != NOBODY
            yield pa.RecordBatch.from_pydict({"query_id": np.repeat(ids_q, hit.sum(1)), "id": best.id[hit], "score": best.distance[hit]})

        def near(best: Best, part: pa.RecordBatch, ids_q: np.ndarray, own_q: np.ndarray, turned_q: np.ndarray, length_q: np.ndarray) -> None:
            ids, own = part.column("id").to_numpy(), even(part.column("vector"), np.float64)
            length, scalar = part.column("length").to_numpy(), part.column("scalar").to_numpy()
            bits = np.unpackbits(even(part.column("bits"), np.uint8), axis=1)[:, :dim].astype(np.float32)
            signs = (2 * bits - 1) / np.float32(np.sqrt(dim))
            with np.errstate(divide="ignore", invalid="ignore"):
                doubt = np.where(scalar > 0, np.sqrt(np.maximum(0.0, 1 - scalar**2)) / scalar, np.inf) * width / np.sqrt(max(1, dim - 1))
                inverse = np.where(scalar > 0, 1 / scalar, 0.0)
            for q in range(0, len(ids_q), COLUMNS):
                cols = slice(q, q + COLUMNS)
                estimate = (signs @ turned_q[cols].T) * inverse[:, None]
                with np.errstate(invalid="ignore"):
                    most = length[:, None] * np.minimum(estimate + doubt[:, None] * length_q[None, cols], length_q[None, cols])
                    both = length[:, None] ** 2 + length_q[None, cols] ** 2
                    least = both * (1 - SLACK) - 2 * most
                least[~np.isfinite(least)] = -np.inf
                measured = np.zeros(least.shape, bool)
                if np.isinf(best.distance[cols, -1]).any():  # the nearest by the codes come first, so that the bound bites
                    np.put_along_axis(measured, np.argpartition(least, min(4 * k, len(least)) - 1, axis=0)[: 4 * k], True, axis=0)
                    measure(best, measured, ids, own, ids_q, own_q, q)
                with np.errstate(over="ignore"):
                    reach = np.ldexp(best.distance[cols, -1], -exponent) ** 2 * (1 + SLACK)
                measure(best, ~measured & (least <= reach), ids, own, ids_q, own_q, q)

        return rows.mapInArrow(run, "query_id long, id long, score double")

    for b in range(blocks):
        part = queries.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).select("id", "vector").toPandas().sort_values("id")
        if not len(part):
            continue
        ids, own = part["id"].to_numpy(np.int64), np.array([np.asarray(v, np.float64) for v in part["vector"]]).reshape(-1, dim)
        turned, bound = ((np.ldexp(own, -exponent) - centre) @ turn).astype(np.float32), np.full(len(ids), np.inf)
        if every > 1:
            first = spark.sparkContext.broadcast((ids, own, turned, bound))
            tries = passed(coded.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(every)) == 0), first)
            rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score"))
            last = tries.withColumn("rank", rank).filter(F.col("rank") == k).select("query_id", "score").toPandas()
            bound[np.searchsorted(ids, last.query_id.to_numpy(np.int64))] = last.score
            first.destroy()
        shared = spark.sparkContext.broadcast((ids, own, turned, bound))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id")).cast("int")
        found.append(scratch.save(passed(coded, shared).withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score"), f"near-{dim}-{b}"))
        shared.destroy()
    return reduce(DataFrame.unionByName, found, spark.createDataFrame([], "query_id long, rank int, id long, score double"))


def measure(best: Best, chosen: np.ndarray, ids: np.ndarray, own: np.ndarray, ids_q: np.ndarray, own_q: np.ndarray, first: int) -> None:
    """Full distances of the chosen (candidate, query) pairs; a query never finds itself."""
    q, c = np.nonzero(chosen.T)
    for at in range(0, len(q), 1 << 15):
        x, y = q[at : at + (1 << 15)] + first, c[at : at + (1 << 15)]
        other = ids_q[x] != ids[y]
        x, y = x[other], y[other]
        if len(x):
            best.add(x, ids[y], distances(own[y], own_q[x]))


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, ``id_col``, score) for the rows of ``vectors`` that ``is_query`` picks.

    ``score`` is the Euclidean distance of the original vectors in double precision; ties go to the smaller id. Null,
    empty and zero vectors, those with a null or non-finite component and rows without id take no part. Vectors of
    another length than the most frequent one are searched among their like. Rows that repeat an id count once, by the
    smallest of their vectors. With fewer than k candidates all are returned; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    scratch, steps = Scratch(spark), Scratch(spark)
    v = vectors.withColumn("_query", is_query).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce("_query", F.lit(False)).alias("query"))
    v = v.filter(usable(F.col("vector")) & F.col("id").isNotNull()).groupBy("id").agg(F.min("vector").alias("vector"), F.max("query").alias("query"))
    v, found = steps.save(v, "vectors"), []
    largest = F.max(F.array_max(F.transform("vector", F.abs)))
    for row in v.groupBy(F.size("vector").alias("dim")).agg(F.count_if("query").alias("queries"), largest.alias("largest")).orderBy("dim").collect():
        if not row["queries"]:
            continue
        alike, exponent = v.filter(F.size("vector") == row["dim"]), int(np.frexp(row["largest"])[1])
        centre = mean(alike, row["dim"], exponent)
        coded = steps.save(index(alike, row["dim"], centre, exponent=exponent), f"index-{row['dim']}")
        found.append(search(coded, alike.filter("query"), row["dim"], centre, k, exponent=exponent, scratch=scratch))
        steps.drop(f"index-{row['dim']}")
    steps.clear()
    return reduce(DataFrame.unionByName, found, spark.createDataFrame([], "query_id long, rank int, id long, score double")).withColumnRenamed("id", id_col)
