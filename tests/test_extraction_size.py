"""The size rule of the registered extraction."""

import types

import pyarrow as pa
from pyspark.sql import functions as F

from siltstone.plans.entities import extract_texts
from siltstone.sources.extraction import MAX_BYTES, skip_reason


def test_large_pages_are_extracted(spark):
    pages = spark.createDataFrame([(1, "<p>" + "word " * 20_000 + "</p>"), (2, "<p>a</p>")], "page_id long, html string")
    assert {r.id: (r.reason, r.n_chars) for r in extract_texts(types.SimpleNamespace(pages=pages)).collect()} == {"1": (None, 99_999), "2": (None, 1)}
    files = spark.createDataFrame([(MAX_BYTES,), (MAX_BYTES + 1,)], "size long").select("size", F.lit("text/html").alias("mime_type"), F.lit(False).alias("is_folder"), F.lit(None).cast("struct<id:string,mime_type:string>").alias("shortcut"))
    assert [r.reason for r in files.select("size", skip_reason(MAX_BYTES).alias("reason")).orderBy("size").collect()] == [None, "too_large"]


def test_batches_for_python_are_bounded_by_bytes(spark):
    from siltstone.sources.extraction import BATCH_BYTES, extract

    files = spark.range(0, 60, 1, 1).select(F.col("id").cast("string").alias("id"), F.lit("text/plain").alias("mime_type"), F.lit(500_000).cast("long").alias("size"), F.lit(False).alias("is_folder"), F.lit(None).cast("struct<id:string,mime_type:string>").alias("shortcut"), F.repeat(F.lit("x"), 500_000).cast("binary").alias("content"))
    assert extract(files, 10**7).filter("length(text) = 500000").count() == 60
    sizes = files.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
    assert max(r.n for r in sizes) <= 2 * BATCH_BYTES
