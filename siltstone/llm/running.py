"""Scoring texts by PPM over their running bytes, pretrained on the corpus.

The model of ``ppm`` with contexts that run on over words and white space: a byte is predicted from the ``ORDER`` bytes
before it in its text, wherever words begin; only the start of the text cuts them short. The symbol ``TEXT_END`` ends a text.

1. Each task gathers documents into blocks of about ``BLOCK`` bytes. A block puts out its compressed text, and its distinct
   (context, byte) grams and words with their counts in training rows, dealt into buckets: grams by the last three bytes
   of context, words by a hash. The bytes of a bucket's grams are one value, so no gram is ever a row of its own.
2. A bucket's counts of all blocks come together in one task, which scores them: a trie node's probabilities need only nodes
   with the same last three bytes of context. Counts of shorter contexts, at most 2^24 pairs ever, are broadcast.
3. A block's grams come back with their log probabilities to its text, where they are summed row by row.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from siltstone.llm.ppm import ORDER, PAD, TEXT_END, Level, find, log_probabilities
from siltstone.sources.scratch import Scratch

#: Bytes of a block, and of the pieces in which its grams are worked out.
BLOCK, PIECE = 1 << 24, 1 << 20
START, END = bytes([PAD] * ORDER), bytes([TEXT_END])
GRAMS, WORDS, LOW, TEXT = "grams", "words", "low", "text"
PARTS = "block long, kind string, bucket int, keys binary, n binary"


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as differences, byte by byte of equal weight, compressed."""
    return zlib.compress(np.diff(values.astype("<i8"), prepend=0).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(8, -1).T).view("<i8").ravel())


def grams(stream: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The (context, byte) keys of texts that each follow a ``START``, and the places of their bytes, by pieces."""
    for at in range(0, max(0, len(stream) - ORDER), PIECE):
        a = stream[at : at + PIECE + ORDER].astype(np.int64)
        key = np.zeros(len(a) - ORDER, np.int64)
        for i in range(ORDER + 1):
            key = (key << 8) | a[i : len(a) - ORDER + i]
        real = (a[ORDER:] != PAD).nonzero()[0]
        yield key[real], real + (at + ORDER)


def merged(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.append(True, key[1:] != key[:-1]).nonzero()[0] if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n[order], first) if len(key) else n


def counted(train: bytes, held: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of both streams in order, with their counts in the first."""
    parts, size = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
    for raw, weight in ((train, 1), (held, 0)):
        for key, _ in grams(np.frombuffer(raw, np.uint8)):
            own, n = np.unique(key, return_counts=True)
            parts.append((own, n * weight))
            size += len(own)
            if size > 4 * PIECE:
                parts = [merged(*map(np.concatenate, zip(*parts)))]
                size = len(parts[0][0])
    return merged(*map(np.concatenate, zip(*parts)))


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """By the last three bytes of context."""
    return ((((key >> 8) & 0xFFFFFF) * 2654435761 & 0xFFFFFFFF) * buckets) >> 32


def blocks(docs: DataFrame, id_type: str, buckets: int) -> DataFrame:
    """From (id, text, train): a row per document (kind null), and the rows of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            first, n_tokens = key, []
            for text, train in zip(batch.column("text"), batch.column("train").to_pylist()):
                raw = (text.as_py() or "").encode("utf-8", "replace").lower()
                n_tokens.append(len(raw.split()) + 1)
                held.append((key, raw, train))
                size += len(raw) + ORDER + 1
                key += 1
                if size >= BLOCK:
                    yield block(held, batch)
                    held, size = [], 0
            yield padded({"row": pa.array(np.arange(first, key)), "id": batch.column("id"), "train": batch.column("train"), "n_tokens": pa.array(n_tokens, pa.int64())}, batch)
        if held:
            yield block(held, batch)

    def block(held: list, batch: pa.RecordBatch) -> pa.RecordBatch:
        number, rows = held[0][0], np.array([k for k, _, t in held if t] + [k for k, _, t in held if not t], np.int64)
        train, other = (b"".join(START + raw + END for _, raw, t in held if t == own) for own in (True, False))
        key, n = counted(train, other)
        out = [(TEXT, 0, packed(rows), zlib.compress(train + other, 1))]
        low, low_n = merged(key & 0xFFFFFF, n)
        out.append((LOW, 0, packed(low[low_n > 0]), packed(low_n[low_n > 0])))
        at = bucket_of(key, buckets)
        order = np.argsort(at, kind="stable")
        cuts = np.searchsorted(at[order], np.arange(buckets + 1))
        for b in (np.diff(cuts) > 0).nonzero()[0].tolist():
            own = order[cuts[b] : cuts[b + 1]]
            out.append((GRAMS, b, packed(key[own]), packed(n[own])))
        words: Counter[bytes] = Counter()
        for _, raw, t in held:
            words.update(raw.split() if t else dict.fromkeys(raw.split(), 0))
        dealt: dict[int, list[bytes]] = {}
        for w in words:
            dealt.setdefault(zlib.crc32(w) % buckets, []).append(w)
        for b, own in dealt.items():
            out.append((WORDS, b, zlib.compress(b" ".join(own), 1), packed(np.array([words[w] for w in own], np.int64))))
        kind, bucket, keys, n = zip(*out)
        return padded({"block": pa.array([number] * len(out), pa.int64()), "kind": pa.array(kind), "bucket": pa.array(bucket, pa.int32()), "keys": pa.array(keys, pa.binary()), "n": pa.array(n, pa.binary())}, batch)

    def padded(columns: dict, batch: pa.RecordBatch) -> pa.RecordBatch:
        schema = pa.schema([("row", pa.int64()), ("id", batch.schema.field("id").type), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("block", pa.int64()), ("kind", pa.string()), ("bucket", pa.int32()), ("keys", pa.binary()), ("n", pa.binary())])
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    return docs.mapInArrow(run, f"row long, id {id_type}, train boolean, n_tokens long, {PARTS}")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out=None) -> DataFrame:
    """The columns of ``ppm.score``, with ``score`` under contexts that run on over words and white space."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    flag = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    docs = docs.withColumn("_held", flag).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), (~F.col("_held")).alias("train"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(4096, max(64, size >> 23))
    saved = scratch.save(blocks(docs, docs.schema["id"].dataType.simpleString(), buckets), "blocks")
    heads, parts = saved.filter("kind IS NULL").select("row", "id", "train", "n_tokens"), saved.select("block", "kind", "bucket", "keys", "n")

    def low_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << 24, np.int64)
        for batch in batches:
            for keys, n in zip(batch.column("keys").to_pylist(), batch.column("n").to_pylist()):
                sums[unpacked(keys)] += unpacked(n)
        at = sums.nonzero()[0]
        yield pa.RecordBatch.from_pydict({"key": at, "n": sums[at]})

    low = parts.filter(F.col("kind") == LOW).select("keys", "n").mapInArrow(low_counts, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    shared = spark.sparkContext.broadcast(Level.stack(low.key.to_numpy(np.int64), low.n.to_numpy(np.int64), range(3)))

    def count_words(group: pd.DataFrame) -> pd.DataFrame:
        total: Counter[bytes] = Counter()
        own = [(zlib.decompress(k).split(b" "), unpacked(n)) for k, n in zip(group["keys"], group.n)]
        for words, n in own:
            for w, c in zip(words, n.tolist()):
                total[w] += c
        first = np.arange(len(group)) == 0
        return pd.DataFrame({
            "block": group.block, "kind": WORDS, "bucket": group.bucket, "keys": group["keys"], "n": [packed(np.array([total[w] for w in words], np.int64)) for words, _ in own],
            "v": first * sum(c > 0 for c in total.values()), "total": first * sum(total.values()),
        })

    counts = scratch.save(parts.filter(F.col("kind") == WORDS).groupBy("bucket").applyInPandas(count_words, f"{PARTS}, v long, total long"), "words")
    sums = counts.agg(F.sum("v").alias("v"), F.sum("total").alias("n")).first()
    ends = heads.agg(F.count_if("train")).first()[0]
    tokens, kinds = (sums["n"] or 0) + ends, (sums["v"] or 0) + (1 if ends else 0)

    def trie(group: pd.DataFrame) -> pd.DataFrame:
        keys = list(map(unpacked, group["keys"]))
        key, n = merged(np.concatenate(keys), np.concatenate(list(map(unpacked, group.n))))
        high = Level.stack(key[n > 0], n[n > 0], range(3, ORDER + 1), shared.value[-1])
        logp = log_probabilities(key, shared.value + high)
        return pd.DataFrame({"block": group.block, "kind": GRAMS, "bucket": group.bucket, "keys": group["keys"], "n": [logp[find(key, k)[0]].tobytes() for k in keys]})

    scored = parts.filter(F.col("kind") == GRAMS).groupBy("bucket").applyInPandas(trie, PARTS)

    def back(group: pd.DataFrame) -> pd.DataFrame:
        of = {kind: group[group.kind == kind] for kind in (TEXT, GRAMS, WORDS)}
        rows, raw = unpacked(of[TEXT]["keys"].iloc[0]), zlib.decompress(of[TEXT].n.iloc[0])
        key, logp = np.concatenate(list(map(unpacked, of[GRAMS]["keys"]))), np.concatenate([np.frombuffer(x) for x in of[GRAMS].n])
        order = np.argsort(key)
        key, logp = key[order], logp[order]
        stream = np.frombuffer(raw, np.uint8)
        starts, total = ((stream[ORDER:] != PAD) & (stream[ORDER - 1 : -1] == PAD)).nonzero()[0] + ORDER, np.zeros(len(rows))
        for own, place in grams(stream):
            kind, at = np.unique(own, return_inverse=True)
            total += np.bincount(np.searchsorted(starts, place, "right") - 1, logp[find(key, kind)[0]][at], len(rows))
        words = [w for k in of[WORDS]["keys"] for w in zlib.decompress(k).split(b" ")]
        c = np.concatenate([np.zeros(0, np.int64), *map(unpacked, of[WORDS].n)])
        index, base = dict(zip(words, range(len(words)))), np.log10((c + 1) / (tokens + kinds + 1))
        seen, unigram = np.zeros(len(rows), np.int64), np.zeros(len(rows))
        for i, (start, stop) in enumerate(zip(starts.tolist(), [*(starts[1:] - ORDER).tolist(), len(raw)])):
            said = raw[start : stop - 1].split()
            at = np.fromiter(map(index.__getitem__, said), np.int64, len(said))
            seen[i], unigram[i] = (c[at] > 0).sum(), base[at].sum()
        return pd.DataFrame({"row": rows, "seen": seen, "base": unigram, "logp": total})

    every = parts.filter(F.col("kind") == TEXT).unionByName(counts.select("block", "kind", "bucket", "keys", "n")).unionByName(scored)
    totals = every.groupBy("block").applyInPandas(back, "row long, seen long, base double, logp double")
    end = float(np.log10((ends + 1) / (tokens + kinds + 1)))
    return heads.join(totals, "row", "left").select(
        F.col("id").alias(id_col), (~F.col("train")).alias("held_out"), "n_tokens", (F.col("seen") + F.lit(1 if ends else 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(end)).alias("base_score"), F.col("logp").alias("score"),
    )
