"""Line dedup: documents probe arrays that a sharded minimal perfect hash of all distinct lines indexes.

A line is a 128-bit hash of its key. Distinct hashes are dealt into shards, each small enough for a task. A shard's
minimal perfect hash is built in levels: each level is a bit array in which a hash takes its place unless another one
wants it too, and those left go on to the next level. The number of bits set before a place is the hash's slot in three
arrays: a 32-bit fingerprint, the number of rows that hold the line (1 if they are one document, 255 at most) and, for
lines of several documents, the smallest id. So a shard is one row of some six bytes a line and can be kept.

Documents send only hashes, each to the shard that can answer, and are told which lines to drop; no text of a line is
shuffled, and lines are not joined with lines. Lines that make up over 1 / ``HOT`` of all, of which there are fewer than
``HOT``, form a shard of their own that every task of a second dealing holds, so a line of a third of all documents is
answered by all tasks. Only documents that lose lines meet that news; marks of bounded size keep the others where they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from siltstone.llm.batches import release
from siltstone.llm.marks import marks, maybe
from siltstone.llm.words import MULTIPLIER, mixed
from siltstone.sources.scratch import Scratch

SPACE = b" \t\n\x0b\x0c\r"
#: Hashes of a shard; lines that are held so often that they are dealt out over all tasks; places a hash of a level.
SHARD, HOT, ROOM = 1 << 16, 1024, 2
#: Rows that are probed at once.
ROWS = 1 << 14


def key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def long_enough(k: bytes, least: int) -> bool:
    """At least ``least`` code points, of one to four bytes each."""
    return len(k) >= least and (len(k) > 4 * (least - 1) or len(k.decode("utf-8", "replace")) >= least)


def codes(lines: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Which lines count, and two 64-bit numbers of each of these."""
    keys = list(map(key, lines))
    own = np.fromiter((long_enough(k, least) for k in keys), bool, len(keys))
    digests = b"".join(xxhash.xxh3_128_digest(keys[i]) for i in np.flatnonzero(own))
    return own, np.frombuffer(digests, np.int64).reshape(-1, 2)


def spot(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    turn = np.uint64(level * int(MULTIPLIER) % (1 << 64))
    return (mixed(mixed(a + turn) + b * MULTIPLIER) % np.uint64(size)).astype(np.int64)


@dataclass
class Slots:
    """A minimal perfect hash of distinct pairs of numbers onto 0 to n - 1, as bits of levels of the given sizes."""

    sizes: list[int]
    bits: np.ndarray

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> Slots:
        a, b, sizes, bits = a.astype(np.uint64), b.astype(np.uint64), [], []
        while len(a):
            sizes.append(max(64, ROOM * len(a)))
            at = spot(a, b, len(sizes), sizes[-1])
            wanted = np.bincount(at, minlength=sizes[-1])
            bits.append(wanted == 1)
            left = wanted[at] > 1
            a, b = a[left], b[left]
        return cls(sizes, np.concatenate([*bits, np.zeros(0, bool)]))

    def __post_init__(self) -> None:
        self.before = np.cumsum(self.bits) - self.bits

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each pair; for a pair that is not of the set any slot or -1."""
        a, b, slot, offset = a.astype(np.uint64), b.astype(np.uint64), np.full(len(a), -1), 0
        for level, size in enumerate(self.sizes, 1):
            open_ = np.flatnonzero(slot < 0)
            at = offset + spot(a[open_], b[open_], level, size)
            hit = self.bits[at]
            slot[open_[hit]] = self.before[at[hit]]
            offset += size
        return slot


def distinct(lines: DataFrame) -> DataFrame:
    """Rows (a, b, rows, n, first) for rows (a, b, id): how many rows hold a line, in one document or more, and the smallest id; null ids come last, all as one."""
    own = F.struct(F.col("id").isNull().alias("none"), "id")
    sums = lines.groupBy("a", "b").agg(F.min(own).alias("least"), F.max(own).alias("most"), F.count(F.lit(1)).alias("rows"))
    return sums.select("a", "b", "rows", F.when(F.col("least") == F.col("most"), 1).otherwise(F.least("rows", F.lit(255))).cast("int").alias("n"), F.col("least.id").alias("first"))


def index(found: DataFrame) -> DataFrame:
    """One row per shard for rows (shard, a, b, n, first): ``sizes`` and ``bits`` of its hash, ``prints``, ``counts``, ``firsts``."""
    id_type = found.schema["first"].dataType.simpleString()

    def shard(rows: pa.Table) -> pa.RecordBatch:
        a, b, n = (rows.column(c).to_numpy() for c in ("a", "b", "n"))
        slots = Slots.build(a, b)
        order = np.argsort(slots.find(a, b))
        firsts = rows.column("first").take(order[n[order] > 1]).combine_chunks()
        firsts = firsts if isinstance(firsts, pa.Array) else pa.concat_arrays(firsts.chunks)
        held = [rows.column("shard")[:1].combine_chunks(), pa.array([slots.sizes], pa.list_(pa.int64()))]
        held += [pa.array([x.tobytes()], pa.binary()) for x in (np.packbits(slots.bits), b[order].astype(np.uint32), n[order].astype(np.uint8))]
        return pa.RecordBatch.from_arrays([*held, pa.ListArray.from_arrays(pa.array([0, len(firsts)], pa.int32()), firsts)], names=["shard", "sizes", "bits", "prints", "counts", "firsts"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            own = batch.column("shard").to_numpy()
            ends = np.flatnonzero(np.append(own[1:] != own[:-1], True)) + 1
            for low, high in zip([0, *ends], ends):
                if waiting and waiting[0].column("shard")[0].as_py() != own[low]:
                    yield shard(pa.Table.from_batches(waiting))
                    waiting = []
                waiting.append(batch.slice(low, high - low))
        if waiting:
            yield shard(pa.Table.from_batches(waiting))
        release()

    dealt = found.select("shard", "a", "b", "n", "first").repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(build, f"shard long, sizes array<long>, bits binary, prints binary, counts binary, firsts array<{id_type}>")


class Shard:
    """The arrays of a row of an index."""

    def __init__(self, row: pa.RecordBatch):
        sizes, bits, prints, counts = (row.column(c)[0].as_py() for c in ("sizes", "bits", "prints", "counts"))
        self.slots = Slots(sizes, np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes)).astype(bool))
        self.prints, self.counts = np.frombuffer(prints, np.uint32), np.frombuffer(counts, np.uint8)
        self.shared = np.cumsum(self.counts > 1) - 1
        self.firsts = row.column("firsts")[0].values

    def dropped(self, rows: pa.RecordBatch) -> np.ndarray:
        """Which rows (a, b, id) hold a line of several documents of which theirs is not the first."""
        a, b = rows.column("a").to_numpy(), rows.column("b").to_numpy()
        slot = self.slots.find(a, b)
        gone = (slot >= 0) & (self.prints[slot] == b.astype(np.uint32)) & (self.counts[slot] > 1)
        at = np.flatnonzero(gone)
        first = self.firsts.take(pa.array(self.shared[slot[at]]))
        gone[at] = ~pc.fill_null(pc.equal(rows.column("id").take(pa.array(at)), first), False).to_numpy(zero_copy_only=False)
        return gone


def probe(lines: DataFrame, arrays: DataFrame) -> DataFrame:
    """The rows (id, key, a) that lose their line, for rows (shard, salt, a, b, id, key) and a row of the index for each shard and salt."""
    id_type = lines.schema["id"].dataType.simpleString()
    asked = lines.select("shard", "salt", F.lit(1).alias("kind"), "a", "b", "id", "key")
    both = arrays.withColumn("kind", F.lit(0)).unionByName(asked, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            starts = [0, *(np.flatnonzero((kind[1:] == 0) | (kind[:-1] == 0)) + 1), len(kind)]
            for low, high in zip(starts, starts[1:]):
                part = batch.slice(low, high - low)
                if not len(part):
                    continue
                if kind[low] == 0:
                    held = Shard(part)
                    continue
                gone = pa.array(held.dropped(part))
                yield pa.RecordBatch.from_arrays([part.column(c).filter(gone) for c in ("id", "key", "a")], names=["id", "key", "a"])
        release()

    return both.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind").mapInArrow(run, f"id {id_type}, key long, a long")


def lost(docs: DataFrame, scratch: Scratch, least: int) -> DataFrame:
    """Rows (of, of_key, gone) for rows (id, key, text) that lose lines: the first numbers of their hashes."""
    id_type, spark = docs.schema["id"].dataType.simpleString(), docs.sparkSession

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.unique(codes((t.as_py() or b"").split(b"\n"), least)[1], axis=0) for t in batch.column("text")]
            at, pairs = np.repeat(np.arange(len(own)), list(map(len, own))), np.concatenate(own)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), *(batch.column(c).take(pa.array(at)) for c in ("id", "key"))], names=["a", "b", "id", "key"])
        release()

    lines = scratch.save(docs.select("id", "key", "text").mapInArrow(hashed, f"a long, b long, id {id_type}, key long"), "lines")
    found = scratch.save(distinct(lines), "distinct")
    counts = found.agg(F.count(F.lit(1)).alias("distinct"), F.sum("rows").alias("rows")).first()
    spread = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(spread, counts["distinct"] // SHARD)
    hot = F.col("rows") > (counts["rows"] or 0) / HOT
    often = scratch.save(found.filter(hot).select("a", "b", F.lit(True).alias("hot")), "often")
    arrays = scratch.save(index(found.withColumn("shard", F.when(hot, -1).otherwise(F.pmod("a", F.lit(shards))))), "index")
    salts = F.explode(F.sequence(F.lit(0), F.when(F.col("shard") < 0, spread - 1).otherwise(0)))
    asked = lines.join(F.broadcast(often), ["a", "b"], "left").withColumn("shard", F.when(F.col("hot"), F.lit(-1).cast("long")).otherwise(F.pmod("a", F.lit(shards))))
    asked = asked.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("key", "id"), F.lit(spread))).otherwise(0).cast("int"))
    gone = probe(asked, arrays.withColumn("salt", salts)).groupBy("id", "key").agg(F.collect_set("a").alias("gone"))
    gone = scratch.save(gone.select(F.col("id").alias("of"), F.col("key").alias("of_key"), "gone"), "gone")
    scratch.drop("lines", "distinct", "often", "index")
    return gone


def dedup_lines(docs: DataFrame, least: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_lines`` before dropping, ``n_dropped``, ``kept``, the lines that stay.

    A text is split at line feeds; null and empty texts are one empty line. A line's key is the line without ASCII white
    space at its ends, A-Z lower-cased. Keys of at least ``least`` code points that at least two documents hold lose all
    their lines except in the document of the smallest id, which keeps all of its own. Shorter lines always stay. Rows
    that share an id are one document, and so are all rows without id, which come after all ids. A document that loses all
    lines has an empty ``kept``. Further columns may have any name and are not read; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    text = F.col(text_col).cast("string")
    docs = docs.select(F.col(id_col).alias("id"), text.cast("binary").alias("text"), F.xxhash64(text).alias("key"))
    id_type = docs.schema["id"].dataType.simpleString()
    gone = lost(docs, scratch, least).withColumn("mark", F.xxhash64("of", "of_key"))
    marked = scratch.save(marks(gone, "mark"), "gone-marks")
    keyed = docs.withColumn("mark", F.xxhash64("id", "key"))
    met = maybe(keyed, "mark", marked).join(gone.drop("mark"), F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key")), "left").select("id", "text", "gone")
    others = maybe(keyed, "mark", marked, "left_anti").select("id", "text", F.lit(None).cast("array<long>").alias("gone"))

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for text, lost_ in zip(batch.column("text"), batch.column("gone")):
                lines = (text.as_py() or b"").split(b"\n")
                n_lines.append(len(lines))
                if lost_.is_valid:
                    own, pairs = codes(lines, least)
                    own[own] = np.isin(pairs[:, 0], lost_.values.to_numpy())
                    lines = [x for x, out in zip(lines, own) if not out]
                n_dropped.append(n_lines[-1] - len(lines))
                kept.append(b"\n".join(lines))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary())], names=["id", "n_lines", "n_dropped", "kept"])
        release()

    out = met.unionByName(others).mapInArrow(cleaned, f"id {id_type}, n_lines long, n_dropped long, kept binary")
    return out.select(F.col("id").alias(id_col), "n_lines", "n_dropped", F.col("kept").cast("string").alias("kept"))


ORACLE = """
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM split
), keyed AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k FROM lines
), shared AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (first <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (first IS NULL OR first = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (k) GROUP BY doc_id
"""
