"""Mixing and sharding: laws, totals and odd input."""

import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from siltstone.llm import mixing, sharding
from tests.llm.cases import odd_docs, rows
from tests.test_queries import normal


def water(sizes, weights, budget, cap):
    """Fills by the smallest steps: clamp, share out again, until none is above."""
    target, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    while open_:
        level = (budget - sum(target[s] for s in sizes if s not in open_)) / sum(weights[s] for s in open_)
        above = {s for s in open_ if weights[s] * level > cap * sizes[s]}
        for s in open_:
            target[s] = cap * sizes[s] if s in above else weights[s] * level
        if not above:
            break
        open_ -= above
    return target


@pytest.mark.parametrize("share", [1.0, 2.9])
def test_targets_and_takes(spark, share):
    data = [(i, " ".join(["w"] * (1 + i % 7)), s) for i, s in enumerate(["a"] * 400 + ["b"] * 20 + ["c"] * 3 + ["é"] * 90 + [None] * 30)]
    data += [(9000, None, "a"), (9001, "", "zz"), (None, "no id", "b"), (5, "w w w", "a")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in data], "doc_id long, text string, source string, taken int, size int")
    got = mixing.mix(docs, share=share).toPandas()
    assert len(got) == len(data)
    sizes = got.fillna({"source": "\U0010ffff"}).groupby("source")["size"].sum().to_dict()
    weights = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes))}
    want = water(sizes, weights, share * sum(sizes.values()), 3)
    for source, own in got.fillna({"source": "\U0010ffff"}).groupby("source"):
        assert own.target.nunique() == 1 and abs(own.target.iloc[0] - want[source]) < 1e-5
        assert abs(own.taken.sum() - want[source]) <= own["size"].max() / 2 + 1e-6
        assert (own.taken <= 3 * own["size"]).all() and (own.source_size == own["size"].sum()).all()
    again = mixing.mix(docs.repartition(3), share=share)
    assert rows(again, "doc_id", "size", "taken") == sorted(zip(got.doc_id.astype(object).where(got.doc_id.notna(), None), got["size"], got.taken), key=repr)


def test_repeat_takes_whole_rows_as_often_as_the_mix_says(spark):
    data = [(i, " ".join(["w"] * (i % 9)), f"s{i % 4}" if i % 5 else None, i) for i in range(300)] + [(None, "x y", "s1", 1), (None, None, None, 2)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, size int")
    want = [(r.doc_id, r.source, r.size) for r in mixing.mix(docs).collect() for _ in range(r.repeats)]
    got = mixing.repeat(docs, mixing.plan(docs))
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.source, len(r.text.split())) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_equal_rows_come_as_near_as_single_ones(spark):
    data = [(1, "w " * 10, "a", 1)] * 1000 + [(2 + i, "w " * (9990 - 40 * i), "b", 1) for i in range(2)] + [(7, "x y z", "c", i % 3) for i in range(900)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, lang int").repartition(7)
    got = mixing.mix(docs).toPandas()
    assert len(got) == len(data)
    for source, width in (("a", 10), ("c", 3)):
        own = got[got.source == source]
        assert abs(own.taken.sum() - own.target.iloc[0]) <= width / 2 + 1e-5
    con = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841  read by the SQL
    want = con.sql(mixing.ORACLE).df()
    assert normal(got[list(want.columns)]) == normal(want)
    whole = mixing.repeat(docs, mixing.plan(docs)).groupBy("source").count().collect()
    assert {r.source: r["count"] for r in whole} == got.groupby("source").repeats.sum().to_dict()


def test_a_row_that_repeats_over_spans(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SPAN", 64)
    docs = spark.createDataFrame([(None, "a b", None)] * 1000 + [(1, "c " * 4300, "b")], "doc_id long, text string, source string")
    got = mixing.mix(docs).filter("source IS NULL").toPandas()
    assert len(got) == 1000 and abs(got.taken.sum() - got.target.iloc[0]) <= 1 and got.taken.nunique() > 1
    assert mixing.repeat(docs, mixing.plan(docs)).filter("source IS NULL").count() == got.repeats.sum()


def test_rows_without_ids_spread_over_the_order(spark):
    docs = spark.createDataFrame([(None, f"a{i} b c", "a") for i in range(500)] + [(1, "x " * 3333, "b")], "doc_id long, text string, source string")
    got = mixing.mix(docs).filter("source = 'a'").toPandas()
    assert abs(got.taken.sum() - got.target.iloc[0]) <= 1.5 and got.taken.nunique() > 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(none).count() == 0 and sharding.shard(none).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000])
def test_permutation_is_a_bijection(spark, n):
    got = [r.p for r in spark.range(n).select(sharding.permuted(F.col("id"), n, 3).alias("p")).collect()]
    assert sorted(got) == list(range(n)) and (n < 60 or got != sorted(got))


def feistel(x, n, seed, hashes):
    """The plain permutation: ``hashes`` gives the round function of (half, round)."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = x >> half, x & mask
        for i in range(1, sharding.ROUNDS + 1):
            left, right = right, left ^ (hashes[right, i] & mask)
        x = left << half | right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 5, 100, 700])
def test_permutation_equals_a_plain_network(spark, n):
    pairs = spark.range(1 << max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(sharding.ROUNDS))))
    hashes = {(r.id, r.i): r.h for r in pairs.withColumn("h", F.xxhash64("id", "i", F.lit(3))).collect()}
    got = {r.id: r.p for r in spark.range(n).select("id", sharding.permuted(F.col("id"), n, 3).alias("p")).collect()}
    assert got == {x: feistel(x, n, 3, hashes) for x in range(n)}


def test_numbers_of_a_row_that_repeats_come_in_spans(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SPAN", 7)
    df = spark.range(3).select(F.lit("a").alias("x")).unionByName(spark.range(50).select(F.lit("b").alias("x")))
    got = sharding.numbered(df, sharding.Scratch(spark)).collect()
    assert sorted(r.row_number for r in got) == list(range(53)) and sum(r.x == "b" for r in got) == 50


def test_very_long_texts(spark):
    docs = spark.createDataFrame([(1, "word " * 300_000, "a"), (2, "x" * 2_000_000, "b"), (3, "y", "b")], "doc_id long, text string, source string")
    assert rows(sharding.shard(docs), "doc_id", "size") == [(1, 1_500_001), (2, 2_000_001), (3, 2)]
    assert rows(mixing.mix(docs), "doc_id", "size") == [(1, 300_000), (2, 1), (3, 1)]


def test_rows_law(spark):
    docs = odd_docs(spark).withColumnRenamed("id", "shard")
    docs = docs.unionByName(docs.filter("doc_id = 5").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("n"))
    got = sharding.shard(docs).toPandas()
    assert len(got) == docs.count() and set(got.law) == {"rows"} and got.grown_shard.isna().all()
    sizes = got.groupby("shard").size().reindex(range(8), fill_value=0)
    assert sizes.max() - sizes.min() <= 1
    for _, own in got.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    want = sorted(((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect()), key=repr)
    assert rows(sharding.shard(docs.repartition(7)), "doc_id", "size", "text_crc32") == want
    columns = "doc_id", "text_crc32", "shard", "slot"
    assert rows(sharding.shard(docs.repartition(7)), *columns) == rows(sharding.shard(docs), *columns)


def test_shard_and_slot_follow_from_the_row_number(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    got = sharding.shard(docs).withColumn("again", sharding.permuted(F.col("row_number"), 50, 11))
    assert got.filter("shard <> again % 8 OR slot <> floor(again / 8)").count() == 0
