"""Token counts without token ids: pieces are counted once per distinct pre-token.

A unigram or BPE piece model with escaped spaces never merges across the start of a run of spaces, nor next to a
line feed, if no piece of its vocabulary spans one. ``PieceCounter`` checks that for its model. So a text's count is
the sum over its pre-tokens, and a task has to segment each distinct pre-token only once: it joins that dictionary to
each document's pre-token frequencies and sums. Documents stay where they are; nothing is shuffled. A global
dictionary would need every (document, pre-token) pair shuffled, more bytes than the texts themselves.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

#: Distinct pre-tokens that a task remembers; beyond it starts anew, which costs time only.
REMEMBERED = 250_000
#: Characters of a text that are cut into pre-tokens at once.
SLICE = 1 << 20
SPACE = "▁"


class PieceCounter:
    """Piece counts of texts for one sentencepiece model."""

    pre_token = re.compile(r"\n| +[^ \n]*|[^ \n]+")
    safe_cut = re.compile(r"(?<=[^ ])(?= )|\n")

    def __init__(self, model_path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        if any(re.search(rf"[^{SPACE}]{SPACE}", p) or ("\n" in p and len(p) > 1) for p in pieces):
            raise ValueError("a piece spans a pre-token boundary, so counts of pre-tokens do not add up")
        if self.model.encode("\n  a  ", out_type=str)[0] != SPACE or self.model.decode(self.model.encode("ﬁ  ① ")) != "ﬁ  ① ":
            raise ValueError("the model rewrites its input; normalise the texts first")
        self.prefix = len(self.model.encode("\n"))
        self.known: dict[str, int] = {}

    def learn(self, pre_tokens: list[str]) -> None:
        """A leading line feed keeps the model from adding its own space."""
        if len(self.known) + len(pre_tokens) > REMEMBERED:
            self.known.clear()
        ids = self.model.encode(["\n" + p for p in pre_tokens], num_threads=1)
        self.known.update(zip(pre_tokens, (len(x) - self.prefix for x in ids)))

    def slices(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > SLICE and (cut := self.safe_cut.search(text, at + SLICE)):
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        total = 0
        for part in self.slices(" " + text.replace(SPACE, " ")):
            frequencies = Counter(self.pre_token.findall(part))
            if new := [p for p in frequencies if p not in self.known]:
                self.learn(new)
            known = self.known
            if all(p in known for p in frequencies):
                total += sum(known[p] * n for p, n in frequencies.items())
            else:  # the dictionary was emptied in between
                self.learn(list(frequencies))
                total += sum(self.known[p] * n for p, n in frequencies.items())
        return total


@lru_cache(maxsize=2)
def counter(model_path: str) -> PieceCounter:
    return PieceCounter(model_path)


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (n_tokens > limit).

    A null or empty text has 0 bytes and 0 tokens. Repeated rows and null ids are kept. An empty table gives an empty
    result. Further columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"{id_col} {docs.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(model_path)
        for batch in batches:
            text = batch.column("text")
            tokens = pa.array([own.count(t.as_py()) for t in text], pa.int64())
            n_bytes = pc.fill_null(pc.cast(pc.binary_length(text), pa.int64()), 0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), n_bytes, tokens, pc.greater(tokens, limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.mapInArrow(run, schema) if docs.columns else spark.createDataFrame([], schema)
