"""The data sources: pages, pushed filters, tokens, streams that resume, and expired tokens."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from siltstone.sources import feed


@pytest.fixture
def store(spark, tmp_path):
    root = str(tmp_path / "store")
    entries = spark.range(200).selectExpr("CAST(id AS STRING) AS id", "concat('n', id) AS name", "if(id % 10 = 0, 'folder', 'text') AS mime_type", "if(id = 7, NULL, CAST(id % 7 AS STRING)) AS parent_id", "id % 5 = 0 AS trashed", "id AS size", "id AS position")
    entries.repartition(3).write.parquet(f"{root}/entries")
    entries.selectExpr("position + 1 AS sequence", "'edit' AS kind", "*").repartition(2).write.parquet(f"{root}/changes")
    feed.register(spark)
    return root


def more(spark, root, first, n):
    spark.read.parquet(f"{root}/entries").filter(F.col("position") < n).selectExpr(f"position + {first} AS sequence", "'edit' AS kind", "*").write.mode("append").parquet(f"{root}/changes")


def listing(spark, root, **options):
    return spark.read.format("siltstone_listing").option("path", root).options(**options).load()


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_all_entries_come_once_by_pages(spark, store):
    df = listing(spark, store)
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(map(tuple, spark.read.parquet(f"{store}/entries").select(*df.columns).collect()), key=repr)
    assert df.rdd.getNumPartitions() == 3 and listing(spark, store, pages_per_partition=2).rdd.getNumPartitions() == 2


@pytest.mark.parametrize("where,pushed", [("parent_id = '3'", "EqualTo(parent_id,3)"), ("parent_id IN ('1', '2') AND mime_type = 'folder' AND size > 9", "In(parent_id, [1,2])"), ("parent_id IS NULL", None), ("id IN ('3', '4')", "In(id, [3,4])"), ("parent_id = '3' AND parent_id IN ('3', '4')", "parent_id")])
def test_filters_reach_the_client_and_change_no_row(spark, store, where, pushed):
    df = listing(spark, store).filter(where)
    assert sorted(r.id for r in df.collect()) == sorted(r.id for r in spark.read.parquet(f"{store}/entries").filter(where).collect())
    if pushed:
        line = next(x for x in plan(df).splitlines() if x.startswith("PushedFilters"))
        assert pushed.replace(" ", "") in line.replace(" ", "")


def test_the_client_skips_what_is_not_wanted(store):
    client = feed.ParquetClient({"path": f"file:{store}"})
    got = [x for p in client.pages() for b in client.entries(p, {"parent_id": ["3"], "mime_type": ["folder"]}) for x in b.column("parent_id").to_pylist()]
    assert got and set(got) == {"3"} and len(got) < 10


def test_changes_by_ranges_of_tokens(spark, store):
    changes = spark.read.format("siltstone_changes").option("path", store).option("tokens_per_partition", 60)
    assert changes.load().count() == 200 and changes.load().rdd.getNumPartitions() == 4
    assert sorted(r.sequence for r in changes.option("after", 150).load().collect()) == list(range(151, 201))


def run(spark, root, **options):
    stream = spark.readStream.format("siltstone_changes").option("path", root).options(**options).load()
    stream.writeStream.format("parquet").option("path", f"{root}/seen").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return sorted((r.sequence, r.kind) for r in spark.read.parquet(f"{root}/seen").collect())


def test_a_stream_resumes_where_it_was_and_equals_the_batch(spark, store):
    assert len(run(spark, store)) == 200 and len(run(spark, store)) == 200
    more(spark, store, 201, 30)
    seen = run(spark, store, tokens_per_partition=7)
    batch = spark.read.format("siltstone_changes").option("path", store).load()
    assert seen == sorted((r.sequence, r.kind) for r in batch.collect()) and len(seen) == 230


def test_an_expired_token_lists_anew_and_goes_on(spark, store):
    run(spark, store)
    more(spark, store, 501, 5)
    seen = run(spark, store, oldest=400)
    assert seen[200:] == [(505, "listed")] * 200
    more(spark, store, 506, 2)
    assert run(spark, store, oldest=400)[400:] == [(506, "edit"), (507, "edit")]


def test_a_client_of_the_callers(spark, store):
    with pytest.raises(Exception, match="no_such_client"):
        listing(spark, store, client="siltstone.sources.feed:no_such_client").collect()
    assert listing(spark, store, client="siltstone.sources.feed:ParquetClient").count() == 200


def test_tokens_read_only_their_row_groups(spark, tmp_path):
    changes = spark.range(1, 20001).select(F.col("id").alias("sequence"), F.lit("k").alias("kind"), *(F.lit(None).cast(c).alias(n) for n, c in zip(feed.ENTRY_FIELDS.names, ("string", "string", "string", "string", "boolean", "long", "long"))))
    changes.orderBy(F.rand(1)).write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/unordered/changes")
    feed.write_ordered(changes.repartition(7), "sequence", f"{tmp_path}/changes")
    for root in (tmp_path, tmp_path / "unordered"):
        client = feed.ParquetClient({"path": str(root)})
        assert client.tokens() == (0, 20000)
        batches = list(client.changes(500, 900))
        assert sorted(x for b in batches for x in b.column("sequence").to_pylist()) == list(range(501, 901)) and max(map(len, batches)) <= 8192
