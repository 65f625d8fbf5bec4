"""Scoring texts by prediction by partial matching (PPM) over bytes, pretrained on the corpus.

A text is a row of units: white space, word, white space, word, ..., white space, end. A byte is predicted from up to
``ORDER`` bytes before it in its own unit, marks for the kind of unit and its end counting as bytes; where a context
has not been followed by the byte, it escapes (method C) to the next shorter one, in which all symbols that the longer
one has seen are excluded. So a unit's code length does not depend on where it stands, and the trie has to be asked
once per distinct unit instead of once per byte of the corpus:

1. Each task turns blocks of documents into postings: unit -> (row, frequency), with its count in training rows.
2. Counts of units give the unigram base, and, spread over their bytes, the counts of all (context, byte) of the trie.
3. A trie node's probabilities need only nodes with the same last three bytes of context, so the trie is scored in parts
   dealt by those; shorter contexts, at most 2^24 (context, byte) pairs ever, are broadcast.
4. Blocks of units fetch the part of the trie that they use, and postings fetch the two scores of their unit; sums go
   back to the rows.

Every step is a shuffle on keys that are pre-aggregated per block, so a word that is in every document is one row per
block of documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from siltstone.sources.scratch import Scratch

ORDER = 5
#: Symbols that no UTF-8 text holds.
WORD_START, SPACE_START, UNIT_END, TEXT_END, PAD = 0xF8, 0xF9, 0xFA, 0xFB, 0xFF
#: (row, unit) entries of a block of postings, and units of a block of scoring.
ENTRIES, UNITS = 1 << 20, 1 << 16
#: An entry is the row's number in its block and, in the lower bits, a frequency; larger frequencies take several.
FREQUENCY_BITS = 10
MOST = (1 << FREQUENCY_BITS) - 1
NOT_SPACE = re.compile(rb"[^\x20\x09-\x0d]+")
GRAM = (1 << 48) - 1


class Numbers(dict):
    def __missing__(self, unit: bytes) -> int:
        self[unit] = n = len(self)
        return n


def postings(docs: DataFrame, id_type: str) -> DataFrame:
    """From (id, text, train): a row per document (unit null) and, for blocks of documents, a row per unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = key = TaskContext.get().partitionId() << 33
        numbers, parts, entries = Numbers(), [], 0
        for batch in batches:
            first, n_tokens = key, []
            for text, train in zip(batch.column("text"), batch.column("train").to_pylist()):
                raw = (text.as_py() or "").encode("utf-8", "replace").lower()
                words = raw.split()
                *spaces, last = NOT_SPACE.split(raw)
                units = words + [b" %b>" % s for s in spaces] + [b" %b$" % last]
                unit, n = np.unique(np.fromiter(map(numbers.__getitem__, units), np.int64, len(units)), return_counts=True)
                parts.append((unit, np.full(len(unit), key - base), n, n * train))
                n_tokens.append(len(words) + 1)
                entries += len(unit)
                key += 1
                if entries >= ENTRIES:
                    yield block(numbers, parts, base, batch)
                    base, numbers, parts, entries = key, Numbers(), [], 0
            yield padded({"row": pa.array(np.arange(first, key)), "id": batch.column("id"), "train": batch.column("train"), "n_tokens": pa.array(n_tokens, pa.int64())}, batch)
        if parts:
            yield block(numbers, parts, base, batch)

    def block(numbers: dict, parts: list, base: int, batch: pa.RecordBatch) -> pa.RecordBatch:
        unit, row, n, c = map(np.concatenate, zip(*parts))
        counted = np.bincount(unit, c, len(numbers)).astype(np.int64)
        times = -(-n // MOST)
        unit, row, n, nth = np.repeat(unit, times), np.repeat(row, times), np.repeat(n, times), np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        entry = ((row << FREQUENCY_BITS) | np.minimum(MOST, n - nth * MOST)).astype("<u4")
        order = np.argsort(unit, kind="stable")
        starts = np.searchsorted(unit[order], np.arange(len(numbers) + 1)).astype(np.int32) * 4
        entries = pa.Array.from_buffers(pa.binary(), len(numbers), [None, pa.py_buffer(starts), pa.py_buffer(entry[order])])
        return padded({"unit": pa.array(list(numbers), pa.binary()), "base": pa.array(np.full(len(numbers), base)), "entries": entries, "c": pa.array(counted)}, batch)

    def padded(columns: dict, batch: pa.RecordBatch) -> pa.RecordBatch:
        schema = pa.schema([("row", pa.int64()), ("id", batch.schema.field("id").type), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("unit", pa.binary()), ("base", pa.int64()), ("entries", pa.binary()), ("c", pa.int64())])
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    return docs.mapInArrow(run, f"row long, id {id_type}, train boolean, n_tokens long, unit binary, base long, entries binary, c long")


def grams(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The (context, byte) keys of units, six bytes each, and the number of the unit that each belongs to."""
    pad = bytes([PAD] * (ORDER - 1))
    whole = [pad + (bytes([SPACE_START]) + u[1:-1] + bytes([TEXT_END if u[-1:] == b"$" else UNIT_END]) if u[:1] == b" " else bytes([WORD_START]) + u + bytes([UNIT_END])) for u in units]
    size = np.fromiter(map(len, whole), np.int64, len(whole))
    a = np.frombuffer(b"".join(whole), np.uint8).astype(np.int64)
    key = np.zeros(max(0, len(a) - ORDER), np.int64)
    for i in range(ORDER + 1):
        key = (key << 8) | a[i : len(a) - ORDER + i]
    of = np.repeat(np.arange(len(units)), size)[ORDER:]
    place = np.arange(len(a)) - np.repeat(np.cumsum(size) - size, size)
    real = place[ORDER:] >= ORDER
    return key[real], of[real]


class Level:
    """All (context, byte) counts of one order, and for each context what the next shorter one has of its symbols."""

    def __init__(self, key: np.ndarray, n: np.ndarray, below: Level | None):
        self.key, at = np.unique(key, return_inverse=True)
        self.n = np.bincount(at, n, len(self.key))
        self.context, of = np.unique(self.key >> 8, return_inverse=True)
        self.total, self.kinds = np.bincount(of, self.n), np.bincount(of)
        self.hidden = None
        if below is not None:
            self.hidden = np.bincount(of, below.n[find(below.key, self.key & below.mask)[0]])
        self.mask = 0

    @staticmethod
    def stack(key: np.ndarray, n: np.ndarray, orders: range, below: Level | None = None) -> list[Level]:
        """Levels of the orders, ascending, from keys of the highest of them."""
        out = []
        for j in orders:
            mask = (1 << 8 * (j + 1)) - 1
            below = Level(key & mask, n, below)
            below.mask = mask
            out.append(below)
        return out


def find(table: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    at = np.minimum(np.searchsorted(table, key), len(table) - 1)
    return at, table[at] == key


def log_probabilities(key: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 P(byte | context) for keys of the highest level."""
    out, open_ = np.zeros(len(key)), np.ones(len(key), bool)
    hidden, kinds = np.zeros(len(key)), np.zeros(len(key))
    for level in reversed(levels):
        own = key & level.mask
        at, hit = find(level.key, own)
        where, seen = find(level.context, own >> 8)
        if not len(level.key):
            continue
        new_kinds = level.kinds[where] - kinds
        room = level.total[where] - hidden + new_kinds
        done, escape = open_ & hit, open_ & seen & ~hit & (new_kinds > 0)
        out[done] += np.log10(level.n[at[done]] / room[done])
        out[escape] += np.log10(new_kinds[escape] / room[escape])
        open_ &= ~hit
        if level.hidden is not None:
            hidden = np.where(seen, level.hidden[where], hidden)
        kinds = np.where(seen, level.kinds[where], kinds)
    out[open_] -= np.log10(256 - kinds[open_])
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out=None) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Learns from the rows for which ``held_out`` (a Column; none: no row) is not true. A-Z count as a-z. ``base_score``
    is the add-one unigram log10 probability of the words and one end; ``score`` is the log10 probability of the whole
    text, white space included, under the trie. A null text is an empty one: it has one token, its end. Without
    training rows the base gives each token 1 / 1 and the trie 1/256 a byte. Repeated rows and null ids are kept.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    flag = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    docs = docs.withColumn("_held", flag).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), (~F.col("_held")).alias("train"))
    id_type = docs.schema["id"].dataType.simpleString()
    saved = scratch.save(postings(docs, id_type), "postings")
    heads, posted = saved.filter("unit IS NULL").select("row", "id", "train", "n_tokens"), saved.filter("unit IS NOT NULL")
    units = scratch.save(posted.groupBy("unit").agg(F.sum("c").alias("c")), "units")
    is_word = F.substring("unit", 1, 1) != F.lit(b" ")
    sums = units.agg(F.count(F.lit(1)).alias("units"), F.sum(F.when(is_word, F.col("c")).otherwise(0)).alias("n"), F.count_if(is_word & (F.col("c") > 0)).alias("v")).first()
    ends = heads.agg(F.count_if("train")).first()[0]
    tokens, kinds = (sums["n"] or 0) + ends, sums["v"] + (1 if ends else 0)
    n_blocks = max(1, -(-sums["units"] // UNITS))
    blocked = units.withColumn("block", F.pmod(F.xxhash64("unit"), F.lit(n_blocks)).cast("int"))

    def slices(group: pd.DataFrame) -> pd.DataFrame:
        key, of = grams(group.unit.tolist())
        own, at = np.unique(key, return_inverse=True)
        return pd.DataFrame({"block": group.block.iloc[0], "key": own, "n": np.bincount(at, group.c.to_numpy()[of], len(own)).astype(np.int64)})

    sliced = scratch.save(blocked.groupBy("block").applyInPandas(slices, "block int, key long, n long"), "slices")
    counted = scratch.save(sliced.groupBy("key").agg(F.sum("n").alias("n")), "grams")
    low = counted.filter("n > 0").groupBy(F.col("key").bitwiseAND(F.lit(0xFFFFFF)).alias("key")).agg(F.sum("n").alias("n")).toPandas()
    shared = spark.sparkContext.broadcast(Level.stack(low.key.to_numpy(np.int64), low.n.to_numpy(np.int64), range(3)))

    def trie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [(b.column("key").to_numpy(), b.column("n").to_numpy()) for b in batches]
        if own:
            key, n = map(np.concatenate, zip(*own))
            high = Level.stack(key[n > 0], n[n > 0], range(3, ORDER + 1), shared.value[-1])
            yield pa.RecordBatch.from_pydict({"key": key, "logp": log_probabilities(key, shared.value + high)})

    parts = max(spark.sparkContext.defaultParallelism, -(-counted.count() // 500_000))
    suffix = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFFFF))
    scored = scratch.save(counted.repartition(parts, suffix).mapInArrow(trie, "key long, logp double"), "trie")

    def in_units(group: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        key, of = grams(group.unit.tolist())
        order = np.argsort(known.key.to_numpy())
        logp = known.logp.to_numpy()[order][np.searchsorted(known.key.to_numpy()[order], key)] if len(known) else np.zeros(0)
        word = np.array([u[:1] != b" " for u in group.unit])
        c = group.c.to_numpy()
        base = np.where(word, np.log10((c + 1) / (tokens + kinds + 1)), 0.0)
        return pd.DataFrame({"unit": group.unit, "seen": word & (c > 0), "base_logp": base, "logp": np.bincount(of, logp, len(group))})

    fetched = sliced.select("block", "key").join(scored, "key").select("block", "key", "logp")
    known = scratch.save(blocked.groupBy("block").cogroup(fetched.groupBy("block")).applyInPandas(in_units, "unit binary, seen boolean, base_logp double, logp double"), "known")
    scratch.drop("units", "slices", "grams", "trie")  # all of them have gone into known

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            raw = batch.column("entries")
            ends = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1]
            entry, length = np.frombuffer(raw.buffers()[2], "<u4", (ends[-1] - ends[0]) // 4, ends[0]), np.diff(ends) // 4
            row, freq = np.repeat(batch.column("base").to_numpy(), length) + (entry >> FREQUENCY_BITS), entry & MOST
            values = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("seen", "base_logp", "logp"))
            held.append((row, *(freq * np.repeat(v.astype(float), length) for v in values)))
            size += len(row)
            if size > 1 << 22:
                yield summed(held)
                held, size = [], 0
        if held:
            yield summed(held)

    def summed(held: list) -> pa.RecordBatch:
        row, *values = map(np.concatenate, zip(*held))
        own, at = np.unique(row, return_inverse=True)
        seen, base, logp = (np.bincount(at, v, len(own)) for v in values)
        return pa.RecordBatch.from_pydict({"row": own, "seen": seen.astype(np.int64), "base": base, "logp": logp})

    # a block's rows come together again, so that each row of a document is summed in one task
    placed = posted.select("unit", "base", "entries").join(known, "unit").select("base", "entries", "seen", "base_logp", "logp").repartition("base")
    totals = placed.mapInArrow(back, "row long, seen long, base double, logp double").groupBy("row").agg(*(F.sum(c).alias(c) for c in ("seen", "base", "logp")))
    end = float(np.log10((ends + 1) / (tokens + kinds + 1)))
    return heads.join(totals, "row", "left").select(
        F.col("id").alias(id_col), (~F.col("train")).alias("held_out"), "n_tokens", (F.col("seen") + F.lit(1 if ends else 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(end)).alias("base_score"), F.col("logp").alias("score"),
    )
