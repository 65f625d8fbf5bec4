"""Vector codes: each part of a vector becomes the number of its nearest codebook entry, all in exact integers.

Distances are screened before they are worked out. One float32 matrix product of parts and entries gives every squared
distance up to a term that all entries share, and the sum of its rounding errors is bounded: a product of w terms, whose
factors were rounded to float32 first, is off by at most g times the product of the two lengths, g = (w + 4) u /
(1 - (w + 4) u) and u = 2^-24, in whatever order it is summed. So each entry has an interval that surely holds its
value. Entries whose interval lies above the best one's upper end cannot be nearest. Where one entry is left it is the
nearest; where several are, all of them are evaluated in int64 and the smallest wins, ties by index.

A round is one pass over the vectors: tasks add up their parts by entry, and sums and counts, as many numbers as the
codebooks have, go to the driver. Vectors are neither shuffled nor stored anew; what is broadcast is the codebooks.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from siltstone.sources.scratch import Scratch

#: Half the unit in the last place of float32 and, with room, of float64.
UNIT, UNIT_64 = 2.0**-24, 2.0**-50
#: Components of this size and above have no code, as integers next to them are no doubles any more.
LARGEST = 2.0**40
#: Vectors that are screened at once.
ROWS = 4096


def cuts(dim: int, parts: int) -> list[slice]:
    """Consecutive parts, equal if their number divides the dimension, else different by one at most."""
    ends = [dim * i // parts for i in range(parts + 1)]
    return [slice(a, b) for a, b in zip(ends, ends[1:])]


def integers(column: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a list column have ``dim`` components, none null, non-finite or too large, and these as floor(scale * x)."""
    kept = pc.fill_null(pc.equal(pc.list_value_length(column), dim), False).to_numpy(zero_copy_only=False)
    rows = column.filter(pa.array(kept)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    fine = (np.abs(rows) < LARGEST).all(1)
    kept[kept] = fine
    return kept, np.floor(scale * rows[fine]).astype(np.int64)


def exact(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows; of int64 as long as they fit, else of Python's integers."""
    return ((rows - entries) ** 2).sum(-1)


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of integers the nearest entry of ``book``, the first of equals, and its squared distance."""
    width = rows.shape[1]
    if not len(rows) or not width:
        return np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    if max(np.abs(rows).max(), np.abs(book).max()) >= isqrt((1 << 60) // width) // 2:  # squares may leave int64
        apart = np.stack([exact(rows.astype(object), entry) for entry in book.astype(object)], 1)
        best = np.argmin(apart, axis=1)
        return best, apart[np.arange(len(rows)), best]
    product = (rows.astype(np.float32) @ book.astype(np.float32).T).astype(np.float64)
    square = (book**2).sum(1).astype(np.float64)
    lengths = np.sqrt((rows.astype(np.float64) ** 2).sum(1))[:, None] * np.sqrt(square)[None, :]
    doubt = 2 * (width + 4) * UNIT / (1 - (width + 4) * UNIT) * lengths * (1 + 1e-9) + UNIT_64 * (square + 2 * np.abs(product))
    middle = square - 2 * product
    open_ = middle - doubt <= (middle + doubt).min(1)[:, None]
    best = np.argmax(open_, axis=1)
    several = np.flatnonzero(open_.sum(1) > 1)
    if len(several):
        at, entry = np.nonzero(open_[several])
        apart = np.full((len(several), len(book)), np.iinfo(np.int64).max)
        apart[at, entry] = exact(rows[several[at]], book[entry])
        best[several] = np.argmin(apart, axis=1)
    return best, exact(rows, book[best])


def start(vectors: DataFrame, dim: int, entries: int, scale: int) -> np.ndarray:
    """The vectors of the smallest ids, equal ids by their components, rows without id last; each task sends as many at most."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: list[tuple] = []
        for batch in batches:
            kept, rows = integers(batch.column("vector"), dim, scale)
            ids = batch.column("id").filter(pa.array(kept)).to_pylist()
            own = ((i is None, i or 0, at) for at, i in enumerate(ids))
            last = least[-1][:2] if len(least) == entries else (True, np.inf)
            least = heapq.nsmallest(entries, [*least, *((none, i, tuple(rows[at].tolist())) for none, i, at in own if (none, i) <= last)])
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in least], pa.bool_()), pa.array([x[1] for x in least], pa.int64()), pa.array([list(x[2]) for x in least], pa.list_(pa.int64()))], names=["none", "id", "row"])

    rows = vectors.select("id", "vector").mapInArrow(first, "none boolean, id long, row array<long>").orderBy("none", "id", "row").limit(entries).collect()
    return np.array([r["row"] for r in rows], np.int64).reshape(-1, dim)


def refined(vectors: DataFrame, books: list[np.ndarray], dim: int, scale: int) -> list[np.ndarray]:
    """One round: all parts are assigned, and each used entry becomes the floor of the mean of its parts."""
    parts = cuts(dim, len(books))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros(b.shape, object) for b in books]
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                rows = integers(batch.column("vector").slice(at, ROWS), dim, scale)[1]
                for p, own in enumerate(parts):
                    best, _ = nearest(rows[:, own], books[p])
                    count[p] += np.bincount(best, minlength=len(books[p]))
                    added = np.zeros(books[p].shape, np.int64)
                    np.add.at(added, best, rows[:, own])
                    total[p] = total[p] + added
        out = [(p, e, i, n, t) for p in range(len(books)) for e, n in enumerate(count[p].tolist()) if n for i, t in enumerate(total[p][e].tolist())]
        columns = zip(*out) if out else [[]] * 5
        types = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38))
        yield pa.RecordBatch.from_arrays([pa.array(list(map(int, c)), pa.int64()).cast(t) if t != types[-1] else pa.array(list(map(int, c)), t) for c, t in zip(columns, types)], names=["part", "entry", "at", "n", "total"])

    found = vectors.select("vector").mapInArrow(sums, "part int, entry int, at int, n long, total decimal(38,0)").groupBy("part", "entry", "at")
    new = [b.copy() for b in books]
    for r in found.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        new[r["part"]][r["entry"], r["at"]] = int(r["total"]) // r["n"]
    return new


def fit(vectors: DataFrame, dim: int, parts: int, entries: int, rounds: int, scale: int) -> list[np.ndarray]:
    """The codebooks of all parts: integers of shape (entries, width), fewer entries if there are fewer vectors."""
    first = start(vectors, dim, entries, scale)
    books = [first[:, own] for own in cuts(dim, parts)]
    for _ in range(rounds if len(first) else 0):
        books = refined(vectors, books, dim, scale)
    return books


def fingerprint(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, books: list[np.ndarray], dim: int, scale: int) -> DataFrame:
    """Rows (id, label, code, error) for the rows (id, label, vector) that have a code."""
    parts, id_type, label_type = cuts(dim, len(books)), *(vectors.schema[c].dataType.simpleString() for c in ("id", "label"))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                batch = whole.slice(at, ROWS)
                kept, rows = integers(batch.column("vector"), dim, scale)
                code, error = np.zeros((len(rows), len(books)), np.uint8), np.zeros(len(rows), object)
                for p, own in enumerate(parts):
                    code[:, p], apart = nearest(rows[:, own], books[p])
                    error = error + apart
                own = pa.array(kept)
                error = pa.array([int(e) if e < 1 << 63 else None for e in error], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("id").filter(own), batch.column("label").filter(own), pa.array([c.tobytes().hex() for c in code], pa.string()), error], names=["id", "label", "code", "error"])

    return vectors.mapInArrow(codes, f"id {id_type}, label {label_type}, code string, error long")


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """One row per vector that has a code: id, ``code``, ``error``, ``label_error``, ``codebooks_sha256``.

    A component x becomes floor(scale * x); vectors are cut into ``parts`` consecutive parts, equal ones if their number
    divides the dimension. Each part's codebook starts as that part of the ``entries`` (at most 256) smallest ids'
    vectors; rows that repeat an id are vectors of their own, in the order of their components, rows without id come
    last. ``code`` holds two hex digits for each part, ``error`` the squared distances summed over parts and
    ``label_error`` the errors of all rows of equal label, null being one.

    Null and empty vectors, those with a null, NaN, infinite or too large (2^40 and above) component and those of
    another length than the most frequent one (the smaller of equals) have no code and give no row. Sums that leave
    64 bits are null. With fewer vectors than entries the codebooks are shorter; an empty table gives no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    vectors = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    lengths = vectors.filter("size(vector) > 0").groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = lengths["dim"] if lengths else 1
    books = fit(vectors, dim, parts, entries, rounds, scale)
    if not len(books[0]):
        vectors = vectors.limit(0)
    coded = Scratch(vectors.sparkSession).save(encode(vectors, books, dim, scale), "coded")
    errors = coded.groupBy("label").agg(F.expr("try_cast(sum(CAST(error AS DECIMAL(38, 0))) AS BIGINT)").alias("label_error"))
    met = coded.join(errors.withColumnRenamed("label", "of"), F.col("label").eqNullSafe(F.col("of")))
    return met.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))


def oracle(rounds: int = 6) -> str:
    """The same rows, each round a pair of steps, all distances in full."""
    steps = [
        "kept AS (SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "parts AS MATERIALIZED (SELECT vec_id, p, i, CAST(floor(4096 * CAST(embedding[8 * p + i + 1] AS DOUBLE)) AS HUGEINT) AS x FROM kept, range(8) a(p), range(8) b(i))",
        "b0 AS MATERIALIZED (SELECT p, e, i, x AS c FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 16) JOIN parts USING (vec_id))",
    ]
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, p, min({{'d': d, 'e': e}}) AS s FROM (SELECT vec_id, p, e, sum((x - c) * (x - c)) AS d FROM parts JOIN b{r} USING (p, i) GROUP BY ALL) GROUP BY ALL)")
        if r < rounds:
            mean = "(total - (total % n + n) % n) // n"
            sums = f"SELECT p, s.e AS e, i, sum(x) AS total, count(*) AS n FROM parts JOIN a{r} USING (vec_id, p) GROUP BY ALL"
            steps.append(f"b{r + 1} AS MATERIALIZED (SELECT p, e, i, coalesce({mean}, c) AS c FROM b{r} LEFT JOIN ({sums}) USING (p, e, i))")
    steps.append(f"coded AS (SELECT vec_id, string_agg(printf('%02x', s.e), '' ORDER BY p) AS code, CAST(sum(s.d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)")
    steps.append(f"book AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM b{rounds})")
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded JOIN kept USING (vec_id), book"
