"""Byte-level BPE encoding and decoding, with long texts encoded in overlapping chunks.

A text of at most ``chunk_chars`` is encoded where it lies. A longer one is cut into chunks that overlap; each chunk
is pre-tokenised on its own, in parallel. Pre-tokenising may start in the middle of a pre-token, but where the
boundaries of two neighbours coincide inside their overlap they coincide from there on, as a match depends only on
the text from its start. At the first such place the chunks are stitched, and each chunk encodes the pieces from its
own stitch to the next. A text with an overlap that never resynchronises (one run of letters longer than the overlap)
is put together again and pre-tokenised in one go.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from siltstone.llm.batches import release
from siltstone.sources.scratch import Scratch

#: A match that ends this close to the end of a cut text may end elsewhere in the whole text.
LOOKAHEAD = 4
#: Distinct pieces that a task remembers; beyond it starts anew.
REMEMBERED = 50_000


class Codec:
    """Encoding by ranks, piece by piece, and decoding by joining raw bytes."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.raw = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.raw[rank] = token
        self.known: dict[str, bytes] = {}

    def piece(self, piece: str) -> bytes:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        ids = np.asarray(self.encoding._encode_single_piece(piece), "<u4").tobytes()
        if len(piece) <= 64:
            self.known[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        known, piece = self.known, self.piece
        return b"".join([known.get(p) or piece(p) for p in self.pattern.findall(text)])

    def encode_span(self, text: str, start: int, stop: int) -> bytes:
        """Ids of the pieces that start in [start, stop), seeing the text beyond ``stop``."""
        out = []
        for m in self.pattern.finditer(text, start):
            if m.start() >= stop:
                break
            out.append(self.known.get(m[0]) or self.piece(m[0]))
        return b"".join(out)

    def starts(self, text: str, low: int, high: int) -> list[int]:
        """Where pre-tokens that can be relied upon start, within [low, high)."""
        limit = min(high, len(text) - LOOKAHEAD)
        out = []
        for m in self.pattern.finditer(text):
            if m.start() >= limit:
                break
            if m.start() >= low:
                out.append(m.start())
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, chunk_chars: int = 65536, overlap: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, row_key, chunk_no, whole, ids): ``ids`` holds little-endian unsigned 32-bit ids of one chunk.

    ``whole`` marks texts of one chunk. Chunks of a longer text share ``row_key`` and join up in order of
    ``chunk_no``. A null or empty text gives one chunk without ids. Repeated rows and null ids are kept apart.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    columns = ["id", "row_key", "chunk_no", "ids"]

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            ids = pa.array([own.encode(t.as_py() or "") for t in batch.column("text")], pa.binary())
            none = pa.array(np.full(len(ids), -1)), pa.array(np.zeros(len(ids), np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *none, ids], names=columns)
        release()

    schema = f"id {docs.schema['id'].dataType.simpleString()}, row_key long, chunk_no long, ids binary"
    whole = docs.filter(~is_long(chunk_chars)).mapInArrow(here, schema).withColumn("whole", F.lit(True))
    chunked = in_chunks(docs.filter(is_long(chunk_chars)), ranks_path, pattern, chunk_chars, overlap).withColumn("whole", F.lit(False))
    return whole.unionByName(chunked).withColumnRenamed("id", id_col)


def is_long(chunk_chars: int) -> Column:
    return F.coalesce(F.length("text") > chunk_chars, F.lit(False))


def in_chunks(docs: DataFrame, ranks_path: str, pattern: str, chunk_chars: int, overlap: int) -> DataFrame:
    """Rows (id, row_key, chunk_no, ids) of texts (id, text) that are longer than a chunk."""
    if overlap * 2 >= chunk_chars:
        raise ValueError("a chunk must be longer than two overlaps")
    id_type = docs.schema["id"].dataType.simpleString()
    columns = ["id", "row_key", "chunk_no", "ids"]
    schema = f"id {id_type}, row_key long, chunk_no long, ids binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            for id_, text in zip(batch.column("id").to_pylist(), (t.as_py() for t in batch.column("text"))):
                starts = range(0, len(text), chunk_chars)
                yield pa.RecordBatch.from_pydict({"id": [id_] * len(starts), "row_key": [key] * len(starts), "chunk_no": list(range(len(starts))), "text": [text[s : s + chunk_chars + overlap] for s in starts]}, pa.schema([("id", batch.schema.field("id").type), ("row_key", pa.int64()), ("chunk_no", pa.int64()), ("text", pa.string())]))
                key += 1

    scratch = Scratch(docs.sparkSession)
    chunks = scratch.save(docs.mapInArrow(cut, f"id {id_type}, row_key long, chunk_no long, text string"), "chunks")

    def boundaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            at = [n * chunk_chars for n in batch.column("chunk_no").to_pylist()]
            head = [[a + x for x in own.starts(t[: 2 * overlap], 0, overlap)] for t, a in zip(texts, at)]
            tail = [[a + x for x in own.starts(t, chunk_chars, chunk_chars + overlap)] for t, a in zip(texts, at)]
            yield pa.RecordBatch.from_arrays([batch.column("row_key"), batch.column("chunk_no"), pa.array(head, pa.list_(pa.int64())), pa.array(tail, pa.list_(pa.int64()))], names=["row_key", "chunk_no", "head", "tail"])

    one_text = Window.partitionBy("row_key")
    in_order = one_text.orderBy("chunk_no")
    stitched = (
        chunks.mapInArrow(boundaries, "row_key long, chunk_no long, head array<long>, tail array<long>")
        .withColumn("start", F.when(F.col("chunk_no") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect(F.lag("tail").over(in_order), F.col("head")))))
        .withColumn("stop", F.lead("start").over(in_order))
        .withColumn("in_step", F.min(F.col("start").isNotNull()).over(one_text))
        .select("row_key", "chunk_no", "start", "stop", "in_step")
    )

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            ids = []
            for text, n, start, stop in zip((t.as_py() for t in batch.column("text")), batch.column("chunk_no").to_pylist(), batch.column("start").to_pylist(), batch.column("stop").to_pylist()):
                at = n * chunk_chars
                ids.append(own.encode_span(text, start - at, len(text) if stop is None else stop - at))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns[:3]] + [pa.array(ids, pa.binary())], names=columns)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts, last = codec(ranks_path, pattern), [], None
        out = lambda: pa.RecordBatch.from_arrays([pa.array([last[0]], id_arrow), pa.array([last[1]]), pa.array([0]), pa.array([own.encode("".join(parts))], pa.binary())], names=columns)
        for batch in batches:
            id_arrow = batch.schema.field("id").type
            for id_, key, text in zip(batch.column("id").to_pylist(), batch.column("row_key").to_pylist(), (t.as_py() for t in batch.column("text"))):
                if last and last[1] != key:
                    yield out()
                    parts = []
                last = id_, key
                parts.append(text[:chunk_chars])
        if last:
            yield out()

    placed = chunks.join(stitched, ["row_key", "chunk_no"])
    stepping = placed.filter("in_step").mapInArrow(spans, schema)
    lost = placed.filter("NOT in_step").select("id", "row_key", "chunk_no", "text").repartition("row_key").sortWithinPartitions("row_key", "chunk_no").mapInArrow(together, schema)
    return stepping.unionByName(lost)


def digest(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """One row per encoded text: id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of the decoded bytes.

    Hashes of chunked texts run on from chunk to chunk in order, so no text is put together again.
    """
    columns = id_col, "row_key", "chunk_no", "ids"
    whole = encoded.filter("whole").select(*columns).withColumn("row_key", F.lit(-1).cast("long"))
    return hashed(whole, ranks_path, pattern, id_col).unionByName(hashed(encoded.filter("NOT whole").select(*columns).repartition("row_key").sortWithinPartitions("row_key", "chunk_no"), ranks_path, pattern, id_col))


def digest_texts(docs: DataFrame, ranks_path: str, pattern: str, chunk_chars: int = 65536, overlap: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``digest`` of ``encode``, where a text of one chunk is encoded, decoded and hashed in one pass, by one Python worker a task.

    A null or empty text gives no ids and the hashes of no bytes. Repeated rows and null ids are kept apart; an empty table
    gives no rows.
    """
    docs = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text"))

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            ids = [own.encode(t.as_py() or "") for t in batch.column("text")]
            codes = [(hashlib.sha256(i).hexdigest(), hashlib.sha256(own.decode(i)).hexdigest()) for i in ids]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array([len(i) // 4 for i in ids], pa.int64()), *(pa.array([c[k] for c in codes], pa.string()) for k in (0, 1))], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])
        release()

    chunks = in_chunks(docs.filter(is_long(chunk_chars)).withColumnRenamed(id_col, "id"), ranks_path, pattern, chunk_chars, overlap).withColumnRenamed("id", id_col)
    in_order = chunks.repartition("row_key").sortWithinPartitions("row_key", "chunk_no")
    whole = docs.filter(~is_long(chunk_chars)).mapInArrow(here, digest_schema(docs, id_col))
    return whole.unionByName(hashed(in_order, ranks_path, pattern, id_col))


def digest_schema(rows: DataFrame, id_col: str) -> str:
    return f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"


def hashed(chunks: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """Digests of chunks (id, row_key, chunk_no, ids): those in a row that share a ``row_key`` are one text, unless it is negative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last, held = codec(ranks_path, pattern), None, None
        for batch in batches:
            rows, id_arrow = [], batch.schema.field(id_col).type
            for id_, key, ids in zip(batch.column(id_col).to_pylist(), batch.column("row_key").to_pylist(), (x.as_py() for x in batch.column("ids"))):
                if held and (key < 0 or key != last):
                    rows.append(held)
                    held = None
                held = held or [id_, 0, hashlib.sha256(), hashlib.sha256()]
                held[1] += len(ids) // 4
                held[2].update(ids)
                held[3].update(own.decode(ids))
                last = key
            yield made(rows, id_arrow)
        if held:
            yield made([held], id_arrow)

    def made(rows: list, id_arrow: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], id_arrow), pa.array([r[1] for r in rows], pa.int64()), *(pa.array([r[i].hexdigest() for r in rows], pa.string()) for i in (2, 3))], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return chunks.mapInArrow(run, digest_schema(chunks, id_col))


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """``bytes`` of each chunk; chunks of one text join up in order of ``chunk_no``, also in the middle of a character."""
    schema = f"{id_col} {encoded.schema[id_col].dataType.simpleString()}, row_key long, chunk_no long, bytes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            raw = pa.array([own.decode(x.as_py()) for x in batch.column("ids")], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (id_col, "row_key", "chunk_no")), raw], names=[id_col, "row_key", "chunk_no", "bytes"])

    return encoded.select(id_col, "row_key", "chunk_no", "ids").mapInArrow(run, schema)
