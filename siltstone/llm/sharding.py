"""Sharding by a Feistel permutation, with cycle walking, of global row numbers.

The permutation of [0, n) is a keyed bijection of the next even power of two, applied again while it leaves [0, n).
A row's place, and so its shard and slot, follows from its number, ``n`` and the seed alone. DataFrame code only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltstone.sources.scratch import Scratch

ROUNDS = 6
#: Each walk ends in [0, n) with a chance over 1/4; all but 3 % of rows have arrived after the first few. A row that has not
#: arrived after all of them is an error.
FIRST_WALKS, WALKS = 12, 256
#: Numbers that one array may hold.
SPAN = 1 << 16


def permuted(number: Column, n: int, seed: int) -> Column:
    """The image of ``number`` under the seeded permutation of [0, n)."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask = F.lit((1 << half) - 1).cast("long")

    def once(x: Column) -> Column:
        halves = F.struct(F.shiftright(x, half).alias("l"), x.bitwiseAND(mask).alias("r"))
        turn = lambda s, i: F.struct(s["r"].alias("l"), s["l"].bitwiseXOR(F.xxhash64(s["r"], i, F.lit(seed)).bitwiseAND(mask)).alias("r"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), halves, turn, lambda s: F.shiftleft(s["l"], half).bitwiseOR(s["r"]))

    step = lambda x, _: F.when(x < n, x).otherwise(once(x))
    first = F.aggregate(F.sequence(F.lit(1), F.lit(FIRST_WALKS)), once(number.cast("long")), step)
    # a lambda's argument is worked out once, so rows that have arrived take no further steps
    rest = lambda x: F.when(x < n, x).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(WALKS - FIRST_WALKS)), x, step))
    arrived = F.transform(F.transform(F.array(first), rest), lambda x: F.when(x < n, x).otherwise(F.raise_error(F.lit("a cycle outlasted its walks; use another seed")).cast("long")))
    return arrived[0]


def numbered(rows: DataFrame, scratch: Scratch, name: str = "row_number") -> DataFrame:
    """Adds a global row number, from 0, in the order of a hash of all columns.

    Equal rows are counted before they are numbered, so a row that repeats without end is one row to every shuffle; its
    numbers are dealt out by spans of at most ``SPAN``.
    The numbers of a hash's first 12 bits start where counts over 4,096 such parts say, and a part is numbered alone.
    """
    columns = rows.columns
    code = F.md5(F.concat_ws("\x00", *(F.coalesce(F.col(c).cast("string"), F.lit("\x01")) for c in columns)).cast("binary"))
    counted = scratch.save(rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_code", code).withColumn("_part", F.substring("_code", 1, 3)), "counted")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.groupBy("_part").agg(F.sum("_n").alias("_sum")).withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    so_far = F.sum("_n").over(Window.partitionBy("_part").orderBy("_code", *columns).rowsBetween(Window.unboundedPreceding, 0))
    first = counted.withColumn("_upto", so_far).join(F.broadcast(starts), "_part").withColumn("_first", F.col("_start") + F.col("_upto") - F.col("_n"))
    last = F.col("_first") + F.col("_n") - 1
    spans = first.withColumn("_last", last).withColumn("_from", F.explode(F.sequence("_first", "_last", F.lit(SPAN).cast("long"))))
    return spans.withColumn(name, F.explode(F.sequence("_from", F.least("_last", F.col("_from") + SPAN - 1)))).select(*columns, name)


def shard(docs: DataFrame, shards: int = 8, seed: int = 11, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``size`` (UTF-8 bytes + 1), ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    The law is ``rows``: counts of shards differ by one at most, slots run from 0 without a gap. A null text has
    size 1 and the checksum of no bytes, 0. ``grown_shard`` is null, as another shard count moves rows anywhere.
    Equal rows get places of their own. ``n``, the number of rows, comes from a count of the narrow table.
    """
    scratch = Scratch(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    narrow = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = scratch.save(numbered(narrow, scratch), "numbered")
    place = permuted(F.col("row_number"), rows.count(), seed)
    return rows.withColumn("place", place).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), (F.col("place") % shards).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )
