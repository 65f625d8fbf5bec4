"""Near-duplicate documents by min-max hashing.

Each permutation of the shingles yields both its smallest and its largest value, so a signature takes half as many hash
evaluations as it has values. Values are banded, and documents that share a band are candidates. Documents with equal
sets are one representative from the start. In a bucket each member is compared with one centre only, on full sets;
what the links found join is one component. Only where a bucket still spans several components are further centres
tried, and in the end all pairs between a component other than the bucket's largest and the rest of the bucket. So no
candidate is lost. Only buckets with at most ``FEW_PAIRS`` such pairs put them out as rows; the members of larger ones
are dealt into tiles, and tiles are compared by one product of their incidence matrices, which puts out a spanning set
of the links found.

Before a wide table is shuffled to meet a narrow one, marks of bounded size (``marks``) keep back the rows that cannot
meet any. All intermediate tables are dropped as soon as nothing reads them any more.

With 6 values a band and 42 bands, two documents of similarity 0.8 share no band with a chance of 3 in a million.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from siltstone.llm.batches import release
from siltstone.llm.marks import marks, maybe
from siltstone.llm.vectors import roots
from siltstone.llm.words import HASHES, MULTIPLIER, mixed, shingles
from siltstone.operators.components import components
from siltstone.sources.scratch import Scratch

ROWS, BANDS = 6, 42
#: Shingles that are permuted at once.
SLICE = 4096
#: Rounds with one centre a bucket before all remaining pairs are compared.
ROUNDS = 2
#: Pairs that a bucket may put out as rows; members of a tile, of either side; shingles of a product.
FEW_PAIRS, TILE, COLUMNS = 64, 256, 8192


def permutations(n: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 64, n, np.uint64) | np.uint64(1), rng.integers(0, 1 << 64, n, np.uint64)


def signature(s: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """The minima, then the maxima, of all permutations of a set that is not empty."""
    low, high = np.full(len(factors), ~np.uint64(0)), np.zeros(len(factors), np.uint64)
    for at in range(0, len(s), SLICE):
        v = s[at : at + SLICE, None] * factors + terms
        low, high = np.minimum(low, v.min(0)), np.maximum(high, v.max(0))
    return np.concatenate([low, high])


def bands(values: np.ndarray, rows: int) -> np.ndarray:
    """One hash per band; the number of the band is part of it."""
    parts = values.reshape(-1, rows)
    h = np.arange(1, len(parts) + 1, dtype=np.uint64)
    for i in range(rows):
        h = mixed(h * MULTIPLIER + parts[:, i])
    return h.astype(np.int64)


def remaining(members: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The members (h, rep, label) of other labels than their bucket's largest, and all, with their numbers f and g."""
    per_label = members.groupBy("h", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = scratch.save(per_label.groupBy("h").agg(F.max_by("label", F.struct("n", "label")).alias("largest"), (F.sum("n") - F.max("n")).alias("f"), F.sum("n").alias("g")), "open-sizes")
    every = members.select("h", "rep", "label").join(sizes, "h")
    return every.filter("label <> largest"), every


def tiled(few: DataFrame, every: DataFrame, sets: DataFrame, percent: int, id_type: str) -> DataFrame:
    """Links (a, b) between labels that follow from pairs of few and all members of the larger buckets."""
    large = F.col("f") * F.col("g") > FEW_PAIRS
    tiles = lambda n: F.ceil(F.col(n) / TILE)
    own = lambda n: F.pmod(F.xxhash64("rep"), tiles(n))
    across = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), tiles(n) - 1))
    one = few.filter(large).select("h", "rep", "label", own("f").alias("i"), across("g").alias("j"), F.lit(0).alias("side"))
    two = every.filter(large).select("h", "rep", "label", across("f").alias("i"), own("g").alias("j"), F.lit(1).alias("side"))

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["side", "rep"])
        n = int((rows.side == 0).sum())
        label, at = np.unique(rows.label, return_inverse=True)
        size = rows["set"].map(len).to_numpy()
        column = np.unique(np.concatenate(rows["set"].to_list()), return_inverse=True)[1]
        row = np.repeat(np.arange(len(rows)), size)
        both = np.zeros((n, len(rows) - n), np.float32)
        for low in range(0, int(column.max()) + 1, COLUMNS):
            part = (column >= low) & (column < low + COLUMNS)
            holds = np.zeros((len(rows), COLUMNS), np.float32)
            holds[row[part], column[part] - low] = 1
            both += holds[:n] @ holds[n:].T
        x, y = np.nonzero(100 * both >= percent * (size[:n, None] + size[None, n:] - both))
        x, y = at[x], at[n + y]
        root = roots(len(label), x, y)
        moved = root != np.arange(len(label))
        return pd.DataFrame({"a": label[moved], "b": label[root[moved]]})

    dealt = one.unionByName(two).join(sets, "rep")
    return dealt.groupBy("h", "i", "j").applyInPandas(block, f"a {id_type}, b {id_type}")


def grouped(docs: DataFrame, shingle: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", rows: int = ROWS, n_bands: int = BANDS) -> DataFrame:
    """One narrow row per row of ``docs``: id, key, n, component, lead; null ids come last wherever the smallest is sought.

    ``key`` is a hash of the text and ``component`` the smallest id that links reach. ``lead`` says whether id and key are
    those of the row that stands for its component; it is null for an empty set, which links with nothing.
    """
    scratch, steps = Scratch(docs.sparkSession), Scratch(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("key", F.xxhash64("text"))
    id_type = docs.schema["id"].dataType.simpleString()
    factors, terms = permutations(rows * n_bands // 2)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, codes, hashes = [], [], []
            for text in batch.column("text"):
                s = shingles(text.as_py(), shingle)
                n.append(len(s))
                codes.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                hashes.append(bands(signature(s, factors, terms), rows) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(n, pa.int64()), pa.array(codes, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))], names=["id", "key", "n", "code", "bands"])
        HASHES.clear()  # a worker that lives on keeps nothing
        release()

    sketches = steps.save(docs.mapInArrow(sketch, f"id {id_type}, key long, n long, code binary, bands array<long>"), "sketches")
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("lead")
    equal = sketches.filter("code IS NOT NULL").groupBy("code").agg(least, F.first("bands").alias("bands"))
    classes = steps.save(equal.select(F.monotonically_increasing_id().alias("rep"), "code", "lead", "bands"), "classes")
    narrow = scratch.save(sketches.drop("bands"), "narrow")
    steps.drop("sketches")
    banded = classes.select("rep", F.explode("bands").alias("h"))
    shared = steps.save(banded.groupBy("h").agg(F.min("rep").alias("centre"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("h", "centre"), "shared")
    marked = steps.save(marks(shared, "h"), "shared-marks")
    members = steps.save(maybe(banded, "h", marked).join(shared, "h").select("h", "rep", "centre"), "members")
    steps.drop("shared", "shared-marks")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array([shingles(t.as_py(), shingle).astype(np.int64) for t in batch.column("text")], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), sets], names=["rep", "set"])
        HASHES.clear()
        release()

    wanted = steps.save(classes.join(members.select("rep").distinct(), "rep", "left_semi").select("rep", F.col("lead.id").alias("of"), F.col("lead.key").alias("of_key")), "wanted")
    marked = steps.save(marks(wanted, "of_key"), "wanted-marks")
    texts = maybe(docs, "key", marked).join(wanted, F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key")))
    sets = steps.save(texts.select("rep", "text").dropDuplicates(["rep"]).mapInArrow(shingled, "rep long, set array<long>"), "sets")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """Those of the distinct pairs (a, b) that are links, by their full sets; b may be in many, so it is met before rows are wide."""
        first = sets.select(F.col("rep").alias("a"), F.col("set").alias("set_a"))
        second = sets.select(F.col("rep").alias("b"), F.col("set").alias("set_b"))
        both = F.size(F.array_intersect("set_a", "set_b"))
        close = 100 * both >= percent * (F.size("set_a") + F.size("set_b") - both)
        return steps.save(pairs.join(second, "b").join(first, "a").filter(close).select("a", "b"), name)

    def pairs_of(candidates: DataFrame) -> DataFrame:
        return candidates.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    links = [verified(pairs_of(members.select(F.col("rep").alias("a"), F.col("centre").alias("b"))), "links0")]
    for turn in range(1, ROUNDS + 2):
        edges = links[0]
        for more in links[1:]:
            edges = edges.unionByName(more)
        labels = components(edges, steps, f"cc{turn}")
        if turn == ROUNDS + 1:
            break
        labelled = members.select("h", "rep").join(labels, F.col("rep") == F.col("node"), "left").select("h", "rep", F.coalesce("component", "rep").alias("label"))
        split = labelled.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min_by(F.struct("rep", "label"), F.xxhash64("rep", F.lit(turn))).alias("pick")).filter("low <> high")
        open_ = steps.save(labelled.join(split.select("h", "pick"), "h"), f"open{turn}")
        if open_.isEmpty():
            break
        if turn < ROUNDS:
            candidates = open_.filter(F.col("label") != F.col("pick.label")).select(F.col("rep").alias("a"), F.col("pick.rep").alias("b"))
        else:
            few, all_ = remaining(open_, steps)
            links.append(steps.save(tiled(few, all_, sets, percent, "long"), "tiled"))
            a, b = few.select("h", F.col("rep").alias("a"), F.col("label").alias("of_a"), "f", "g"), all_.select("h", F.col("rep").alias("b"), F.col("label").alias("of_b"))
            candidates = a.filter(F.col("f") * F.col("g") <= FEW_PAIRS).join(b, "h").filter("of_a <> of_b").select("a", "b")
        links.append(verified(pairs_of(candidates), f"links{turn}"))

    steps.drop("members", "sets", "wanted", "wanted-marks")
    linked = classes.select("rep", "lead").join(labels, F.col("rep") == F.col("node"))
    leads = linked.groupBy("component").agg(F.min("lead").alias("first"))
    of_linked = labels.join(leads, "component").select("node", "first")
    known = classes.select("rep", "code", "lead").join(of_linked, F.col("rep") == F.col("node"), "left")
    known = scratch.save(known.select(F.col("code").alias("c"), F.coalesce("first", "lead").alias("lead")), "known")
    steps.clear()
    found = narrow.join(known, F.col("code") == F.col("c"), "left")
    own = F.col("id").eqNullSafe(F.col("lead.id")) & (F.col("key") == F.col("lead.key"))
    return found.select("id", "key", "n", F.when(F.col("code").isNotNull(), F.col("lead.id")).otherwise(F.col("id")).alias("component"), F.when(F.col("code").isNotNull(), own).alias("lead"))


def near_duplicates(docs: DataFrame, shingle: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", rows: int = ROWS, n_bands: int = BANDS) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``, ``kept``.

    A document's set holds its distinct shingles of ``shingle`` words, with fewer words all of them as one. Two are
    linked if 100 times their common shingles are at least ``percent`` times all their shingles. A null text or one
    without words has an empty set and links with nothing. ``component_id`` is the smallest id that links reach,
    ``kept`` says whether it is the row's own; for a null id both follow from the other rows, ``kept`` is null. Rows
    that repeat an id are documents of their own, linked or not as their texts say. An empty table gives no rows.
    """
    found = grouped(docs, shingle, percent, id_col, text_col, rows, n_bands)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


def deduplicated(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest id stays, whole; null ids come last.

    Of rows that repeat both id and text one stays. Rows whose text is null or has no words stay, as they resemble
    nothing, and so do rows without id that stand for their component. Only texts that marks of the rows to drop point at
    are shuffled; further columns may have any name.
    """
    scratch = Scratch(docs.sparkSession)
    found = grouped(docs, shingle, percent, id_col, text_col)
    odd = found.filter("lead IS NOT NULL").groupBy("id", "key").agg(F.first("lead").alias("lead"), F.count(F.lit(1)).alias("n")).filter("NOT lead OR n > 1")
    odd = scratch.save(odd.select(F.col("id").alias("of"), F.col("key").alias("of_key"), "lead", F.xxhash64("id", "key").alias("mark")), "odd")
    marked = scratch.save(marks(odd, "mark"), "odd-marks")
    row = F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns)).alias("row")
    keyed = docs.select(row, F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("key")).withColumn("mark", F.xxhash64("id", "key"))
    met = maybe(keyed, "mark", marked).join(odd.drop("mark"), F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key")), "left")
    left = maybe(keyed, "mark", marked, "left_anti").unionByName(met.filter("lead IS NULL").select(*keyed.columns))
    if not odd.filter("lead").isEmpty():
        left = left.unionByName(met.filter("lead").dropDuplicates(["id", "key"]).select(*keyed.columns))
    return left.select("row.*")


#: The same rows by comparing all documents that share a shingle.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS shingle FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), pairs AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach(node, top) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT node, b FROM reach JOIN pairs ON a = top
), component AS (
  SELECT node, min(top) AS component_id FROM reach GROUP BY node
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM documents JOIN component ON node = doc_id LEFT JOIN n USING (doc_id)
"""
