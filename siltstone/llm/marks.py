"""Marks: which rows of a wide table may meet a narrow one, told before anything is shuffled.

The keys of the narrow table set bits of one bitmap, of which only words with a bit set are rows. It is broadcast, as it
never has more than ``WORDS`` rows of two integers. A key without its bit is certainly absent; one with it may be
present, so the real join follows. Where keys are so many that most bits are set, nothing is saved and nothing lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Words of 64 bits: 4 MB as numbers, some 20 MB as the table that an executor looks them up in.
WORDS = 1 << 18


def place(key: str) -> str:
    return f"pmod(xxhash64(`{key}`, 29), {WORDS * 64}L)"


def marks(keys: DataFrame, key: str) -> DataFrame:
    """Rows (word, bits) for the column ``key``, at most ``WORDS`` of them; save them before they are used."""
    spots = keys.select(F.expr(place(key)).alias("spot"))
    return spots.groupBy(F.shiftright("spot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(spot & 63 AS INT)))").alias("bits"))


def maybe(df: DataFrame, key: str, marked: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``df`` whose key may be among the marked ones; with ``left_anti`` those whose key is certainly not."""
    own = marked.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    hit = F.expr(f"_word = shiftright({place(key)}, 6) AND (shiftrightunsigned(_bits, CAST({place(key)} & 63 AS INT)) & 1L) = 1L")
    return df.join(F.broadcast(own), hit, how)
