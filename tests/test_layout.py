"""Bucketed tables: no shuffle for the latest row of a key and its join, and the same rows."""

import contextlib
import io

from pyspark.sql import functions as F

from siltstone.operators import versions
from siltstone.sources.layout import Laid


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_the_latest_row_and_its_join_shuffle_nothing(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = spark.createDataFrame([(i % 37 if i % 41 else None, i * 7919 % 1000, f"v{i}") for i in range(800)], "file_id int, at int, v string")
        files = spark.createDataFrame([(i, f"n{i}") for i in range(50)], "file_id int, name string")
        laid = Laid(spark)
        a, b = laid.save(rows, ["file_id"], "versions", 4), laid.save(files, ["file_id"], "files", 4)
        top, plain = versions.latest(a, ["file_id"], ["at", "v"]), versions.latest(rows, ["file_id"], ["at", "v"])
        joined = top.join(b, "file_id")
        assert "Exchange" not in plan(top) and "Exchange" not in plan(joined) and "Exchange" in plan(plain)
        assert sorted(map(tuple, top.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, plain.join(files, "file_id").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_are_forgotten(spark):
    laid = Laid(spark)
    assert laid.save(spark.range(0).select(F.col("id").alias("k")), ["k"], "none").count() == 0
    laid._forget()
    assert not any(t.name in laid.names for t in spark.catalog.listTables())
