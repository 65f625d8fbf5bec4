"""Near-duplicate vectors by tiled comparison in the order of principal components.

Equal vectors are one row from the start. The rest is turned into the basis of principal components, where products of
the leading dimensions say most about the cosine. Vectors of a group are dealt into tiles by their first component, and
two tiles meet only if their first components are near enough for the threshold. Tiles grow with their group up to
``TILE_BYTES``, so a vector goes to a bounded number of tiles until a group holds ``STRIPS`` tiles of that size; from
there on comparing all pairs of a group costs what it must, the square. In a pair of tiles the products of
the leading dimensions come first; what the others can add is bounded by the norms of the suffixes, and a pair is given
up as soon as it cannot reach the threshold. What is left is decided by the cosine of the original vectors.

A pair of tiles returns counts of links and a spanning set of them, never the links themselves, so its result is no
larger than its input however dense a group is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from siltstone.llm.vectors import matrix, packed, roots, scaled, unpacked, usable
from siltstone.operators.components import components
from siltstone.sources.scratch import Scratch

#: First components fall into this many bins over [-1, 1].
BINS = 4096
#: What single precision may take from a bound.
SLACK = 1e-4
#: Pairs that are compared at once.
BLOCK = 1 << 16
#: Bases are found for this many of the most frequent lengths; others keep their own order.
MOST_LENGTHS = 16
#: Tiles that a group is dealt into, until they reach this size.
STRIPS, TILE_BYTES = 6, 1 << 24


def bases(reps: DataFrame) -> dict[int, np.ndarray]:
    """Principal directions, the largest first, for the most frequent lengths of vectors, from sums of d x d numbers."""
    lengths = reps.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(MOST_LENGTHS).collect()
    wanted = [r["dim"] for r in lengths]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = pc.list_value_length(batch.column("vector")).to_numpy()
            for d in np.unique(dims):
                x = matrix(batch.column("vector").filter(pa.array(dims == d)), int(d))
                x = scaled(x)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                sums[int(d)] = sums.get(int(d), 0) + np.append(x.T @ x, len(x))
        yield made(sums)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, raw in zip(batch.column("dim").to_pylist(), batch.column("sums").to_pylist()):
                sums[d] = sums.get(d, 0) + np.frombuffer(raw)
        yield made(sums)

    def made(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["dim", "sums"])

    schema = "dim int, sums binary"
    rows = reps.filter(F.size("vector").isin(wanted)).select("vector").mapInArrow(partial, schema).repartition(8, "dim").mapInArrow(total, schema).collect()
    return {r["dim"]: np.linalg.eigh(np.frombuffer(r["sums"])[:-1].reshape(r["dim"], r["dim"]))[1][:, ::-1] for r in rows}


def compare(a: dict, b: dict | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (into a and b, or into a twice, i < j) whose cosine reaches the threshold."""
    other = a if b is None else b
    d = a["turned"].shape[1]
    steps = sorted({min(d, k) for k in (16, 32)} | {d})
    found = []
    for low in range(0, len(a["turned"]), 512):
        rows = slice(low, low + 512)
        k = steps[0]
        near = a["turned"][rows, :k] @ other["turned"][:, :k].T
        i, j = np.nonzero(near + a["rest"][rows, 0:1] * other["rest"][:, 0] >= threshold - SLACK)
        product = near[i, j]
        i = i + low
        if b is None:
            product, i, j = product[i < j], *(x[i < j] for x in (i, j))
        for at in range(0, len(i), BLOCK):
            x, y, p = i[at : at + BLOCK], j[at : at + BLOCK], product[at : at + BLOCK]
            for s in range(1, len(steps)):
                part = slice(steps[s - 1], steps[s])
                p = p + np.einsum("ij,ij->i", a["turned"][x, part], other["turned"][y, part])
                keep = p + a["rest"][x, s] * other["rest"][y, s] >= threshold - SLACK
                x, y, p = x[keep], y[keep], p[keep]
            exact = np.einsum("ij,ij->i", a["own"][x], other["own"][y]) / (a["norm"][x] * other["norm"][y])
            found.append((x[exact >= threshold], y[exact >= threshold]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    return tuple(np.concatenate(x) for x in zip(*found))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, tile: int = 2048, id_col: str = "vec_id", vector_col: str = "embedding", group_col: str = "label") -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links``, ``component_id``, ``kept``.

    Two vectors are linked if their groups are equal and not null, their lengths are equal, and their cosine in double
    precision is at least ``threshold`` (over 0). Vectors that are null, empty or zero, or hold null or non-finite
    components, link with nothing, nor do rows without id (their component and ``kept`` are null). Rows that repeat an
    id are vectors of their own. Further columns are not read. An empty table gives no rows. ``tile`` is the least size
    of a tile and does not change the result.
    """
    out, scratch = Scratch(vectors.sparkSession), Scratch(vectors.sparkSession)
    v = vectors.select(F.col(id_col).alias("id"), F.col(group_col).alias("group"), F.col(vector_col).cast("array<double>").alias("vector"))
    clean = F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    good = usable(F.col("vector")) & F.col("group").isNotNull() & F.col("id").isNotNull()
    # components travel as they came: single precision holds what was single, also in units of a power of two
    kind = "<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"
    v = v.withColumn("vector", F.when(good, clean)).withColumn("code", F.md5(F.array_join(F.transform("vector", lambda x: x.cast("string")), ",").cast("binary")))
    reps = scratch.save(v.filter(F.col("vector").isNotNull()).groupBy("group", "code").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")), "reps")
    basis = reps.sparkSession.sparkContext.broadcast(bases(reps))
    group_type = reps.schema["group"].dataType.simpleString()
    id_type = reps.schema["rep"].dataType.simpleString()

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = pc.list_value_length(batch.column("vector")).to_numpy()
            for d in map(int, np.unique(dims)):
                part = batch.filter(pa.array(dims == d))
                own = scaled(matrix(part.column("vector"), d))
                unit = own / np.linalg.norm(own, axis=1, keepdims=True)
                turned = (unit @ basis.value[d] if d in basis.value else unit).astype("<f4")
                bins = np.clip((turned[:, 0] + 1) * (BINS / 2), 0, BINS - 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("group"), pa.array(np.full(len(own), d, np.int32)), part.column("rep"), part.column("copies"), pa.array(bins), packed(turned), packed(own.astype(kind))], names=["group", "dim", "rep", "copies", "bin", "turned", "own"])

    turned = scratch.save(reps.select("group", "rep", "copies", "vector").mapInArrow(turn, f"group {group_type}, dim int, rep {id_type}, copies long, bin int, turned binary, own binary"), "turned")
    one_group = ["group", "dim"]
    before = F.sum("n").over(Window.partitionBy(*one_group).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    most = F.greatest(F.lit(tile), F.floor(F.lit(TILE_BYTES) / (12 * F.col("dim"))))
    fit = F.least(most, F.greatest(F.lit(tile), F.ceil(F.sum("n").over(Window.partitionBy(*one_group)) / STRIPS)))
    strips = turned.groupBy(*one_group, "bin").agg(F.count(F.lit(1)).alias("n")).withColumn("fit", fit).withColumn("strip", F.floor(before / F.col("fit")))
    spread = strips.groupBy(*one_group, "strip").agg(F.min("bin").alias("low"), F.max("bin").alias("high"), F.ceil(F.sum("n") / (2 * F.max("fit"))).alias("parts"))
    tiles = scratch.save(spread.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))), "tiles")
    places = scratch.save(strips.select(*one_group, "bin", "strip").join(spread, [*one_group, "strip"]).select(*one_group, "bin", "strip", "parts"), "places")
    members = turned.join(places, [*one_group, "bin"]).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")))
    reach = int(np.ceil(np.sqrt(max(0.0, 2 - 2 * threshold)) * BINS / 2)) + 2
    a = tiles.select(*one_group, *(F.col(c).alias(f"{c}_a") for c in ("strip", "part", "high")))
    b = tiles.select(*one_group, *(F.col(c).alias(f"{c}_b") for c in ("strip", "part", "low")))
    meet = a.join(b, one_group).filter("strip_a < strip_b OR strip_a = strip_b AND part_a <= part_b").filter(F.col("low_b") - F.col("high_a") <= reach)
    meet = scratch.save(meet.withColumn("pair", F.xxhash64(*one_group, "strip_a", "part_a", "strip_b", "part_b")), "meet")
    alone = (F.col("strip_a") == F.col("strip_b")) & (F.col("part_a") == F.col("part_b"))
    sides = meet.select(*one_group, F.col("strip_a").alias("strip"), F.col("part_a").alias("part"), "pair", F.lit(0).alias("side"), alone.alias("alone")).unionByName(
        meet.filter(~alone).select(*one_group, F.col("strip_b").alias("strip"), F.col("part_b").alias("part"), "pair", F.lit(1).alias("side"), F.lit(False).alias("alone"))
    )
    dealt = members.join(sides, [*one_group, "strip", "part"]).select("pair", "side", "alone", "rep", "copies", "turned", "own", *one_group)

    def side(rows: pd.DataFrame) -> dict:
        turned, own = unpacked(rows.turned, "<f4"), unpacked(rows.own, kind).astype(np.float64)
        d = turned.shape[1]
        ends = sorted({min(d, k) for k in (16, 32)} | {d})
        return {"turned": turned, "own": own, "norm": np.linalg.norm(own, axis=1), "rest": np.stack([np.linalg.norm(turned[:, k:], axis=1) for k in ends], 1)}

    def pairs(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, rows in rows.groupby(["group", "dim"]):  # one, but for a clash of hashes
            rows = rows.sort_values("rep")
            first, second = rows[rows.side == 0], rows[rows.side == 1]
            if rows.alone.iloc[0]:
                both, (x, y) = first, compare(side(first), None, threshold)
            elif len(first) and len(second):
                both, (x, y) = pd.concat([first, second]), compare(side(first), side(second), threshold)
                y = y + len(first)
            else:
                continue
            if not len(x):
                continue
            copies, rep = both.copies.to_numpy(), both.rep.to_numpy()
            order = np.argsort(rep, kind="stable")
            place = np.empty_like(order)
            place[order] = np.arange(len(rep))
            links = np.bincount(x, copies[y], len(rep)) + np.bincount(y, copies[x], len(rep))
            root = rep[order[roots(len(rep), place[x], place[y])[place]]]
            some = links > 0
            out.append(pd.DataFrame({"rep": rep[some], "links": links[some].astype(np.int64), "root": root[some]}))
        return pd.concat(out) if out else pd.DataFrame({"rep": [], "links": [], "root": []})

    linked = scratch.save(dealt.groupBy("pair").applyInPandas(pairs, f"rep {id_type}, links long, root {id_type}"), "linked")
    scratch.drop("turned", "tiles", "places", "meet")
    whole = components(linked.select(F.col("rep").alias("a"), F.col("root").alias("b")), scratch)
    per_rep = linked.groupBy("rep").agg(F.sum("links").alias("links")).join(whole, F.col("rep") == F.col("node"), "left").select("rep", "links", "component")
    result = out.save(reps.select("group", "code", "rep", "copies").join(per_rep, "rep", "left"), "result")
    scratch.clear()
    joined = v.select("id", "group", "code").join(result.withColumnsRenamed({"group": "g", "code": "c"}), (F.col("group") == F.col("g")) & (F.col("code") == F.col("c")), "left")
    component = F.coalesce("component", "rep", "id")
    return joined.select(F.col("id").alias(id_col), F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept"))


#: The same rows by comparing all vectors of a label.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x <> 0)) > 0
), pairs AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_dot_product(x.e, y.e) / (sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e))) >= 0.93
), n AS (
  SELECT a, count(*) AS n FROM pairs GROUP BY a
), reach(node, top) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT node, b FROM reach JOIN pairs ON a = top
), component AS (
  SELECT node, min(top) AS component_id FROM reach GROUP BY node
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN component ON node = vec_id LEFT JOIN n ON a = vec_id
"""
