"""State between batches, the commit gate, day walks and chunks: what a run again does."""

import pytest
from pyspark.sql import functions as F

from siltstone.streaming import state as S
from siltstone.streaming.forward import run_forward
from tests.test_sources_streaming import events


def test_a_batch_that_runs_again_starts_from_the_same_state(spark, tmp_path):
    table = S.StateTable(spark, str(tmp_path / "s"), "k string, n long", keep=2)
    add = lambda k: lambda before: before.unionByName(spark.createDataFrame([(k, 1)], "k string, n long"))
    table.update(0, add("a"))
    table.update(1, add("b"))
    for _ in range(2):
        after = table.update(2, add("c"))
        assert sorted(r.k for r in after.collect()) == ["a", "b", "c"]
    assert table.versions() == [1, 2] and sorted(r.k for r in table.before(2).collect()) == ["a", "b"]


def test_gate(spark):
    kinds = lambda *k: spark.createDataFrame([(x,) for x in k], "kind string")
    assert S.gate(kinds("ok", "snapshot"), 1).first().advance and not S.gate(kinds("snapshot", "snapshot"), 1).first().advance
    held = S.gate(kinds("stage3", "transient", "transient")).first()
    assert not held.advance and held.causes == "1 stage3 failure(s) + 2 transient failure(s)"
    assert S.gate(spark.createDataFrame([], "kind string")).first().advance
    with pytest.raises(S.HeldBack, match="1 stage3"):
        S.committed(kinds("stage3"))


def test_failures_hold_the_checkpoint(spark, tmp_path):
    source, sink, check = (str(tmp_path / x) for x in ("in", "sink", "check"))
    events(spark, (1, "2024-01-01 10:00:00", "signup"), (2, "2024-01-01 10:00:30", "purchase")).coalesce(1).write.parquet(source)
    seen = []

    def failing(batch, number):
        seen.append(batch.count())
        return batch.select(F.lit("transient").alias("kind"))

    with pytest.raises(Exception, match="transient failure"):
        run_forward(spark, source, sink, check, process=failing)
    done = run_forward(spark, source, sink, check, process=lambda batch, number: batch.select(F.lit("ok").alias("kind")))
    assert seen == [2] and sum(r.edits for r in done.collect()) == 2


def test_days_are_walked_in_order(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01", 1), ("a", "2024-01-01", 2), ("a", "2024-01-05", 3), ("b", "2024-01-03", 4)], "account string, day string, file int").withColumn("day", F.to_date("day"))
    cursors = S.StateTable(spark, str(tmp_path / "c"), "account string, cursor date")
    cursors.update(0, lambda _: spark.createDataFrame([("a", None), ("b", None)], cursors.schema))
    done = []
    assert S.walk_days(rows, cursors, lambda due: done.append(sorted(r.file for r in due.collect())), most=1) == 1

    def fails(due):
        raise RuntimeError("broken")

    with pytest.raises(RuntimeError):
        S.walk_days(rows, cursors, fails)
    assert S.walk_days(rows, cursors, lambda due: done.append(sorted(r.file for r in due.collect()))) == 1
    assert done == [[1, 2, 4], [3]]
    assert all(r.completed for r in S.advanced(rows, cursors.before()).collect())


def test_chunks_resume_after_the_last_one(spark, tmp_path):
    items = spark.range(25).select(F.col("id").alias("n"))
    done = S.StateTable(spark, str(tmp_path / "d"), "chunk long")
    seen = []

    def work(part, chunk):
        if chunk == 1 and not seen[1:]:
            seen.append("failed")
            raise RuntimeError("broken")
        seen.append(sorted(r.n for r in part.collect()))

    with pytest.raises(RuntimeError):
        S.run_chunks(items, 10, ["n"], done, work)
    assert S.run_chunks(items, 10, ["n"], done, work) == 2
    assert seen == [list(range(10)), "failed", list(range(10, 20)), list(range(20, 25))]
