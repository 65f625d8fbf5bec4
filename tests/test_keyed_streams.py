"""Streams with state by key against batch answers, over splits into batches, restarts and late rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from siltstone.streaming import keyed as K

START = datetime.datetime(2024, 1, 1)
SIGHT = "account long, file_id long, ok boolean, ts timestamp"


def sightings(seed, days=6, n=120):
    rng = random.Random(seed)
    rows = [(rng.choice([1, 2, None]), rng.randrange(5), rng.random() < 0.3, START + datetime.timedelta(minutes=rng.randrange(days * 24 * 60))) for _ in range(n)]
    return sorted(rows, key=lambda r: r[3]) + [(9, 9, True, START + datetime.timedelta(days=days, hours=1))]


def plain(rows):
    """The worklist of all days before the last, and the files that were put out."""
    last, days = max(r[3] for r in rows).date(), {}
    for account, file, ok, ts in rows:
        if ts.date() < last:
            own = days.setdefault((account, file), {})
            own[ts.date()] = own.get(ts.date(), False) or ok
    out = []
    for (account, file), own in days.items():
        failed = [d for d, ok in own.items() if not ok]
        if failed:
            end = max(d for d in own if d >= min(failed))
            out.append((account, file, "resolved" if own[end] else "open", min(failed), end))
    return sorted(out, key=repr)


def feed(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("cuts", [[], [40], [7, 30, 31, 90]])
def test_restricted_files_over_restarts_equal_the_batch_answer(spark, tmp_path, cuts):
    source, sink, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    rows = sightings(4)
    for low, high in zip([0, *cuts], [*cuts, len(rows)]):
        feed(spark, source, rows[low:high], SIGHT)
        K.run_to_end(K.restricted_stream(spark.readStream.schema(SIGHT).parquet(source)), sink, check)  # each a stream started anew
    steps = spark.read.parquet(sink)
    assert sorted(map(tuple, K.worklist(steps).collect()), key=repr) == plain(rows)
    emitted = [(r.account, r.file_id, r.day) for r in steps.filter("emitted").collect()]
    assert sorted(emitted, key=repr) == [(a, f, first) for a, f, _, first, _ in plain(rows)]


def test_rows_of_an_open_day_may_come_in_any_order(spark, tmp_path):
    source, sink, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    hour = lambda h: START + datetime.timedelta(hours=h)
    feed(spark, source, [(1, 1, False, hour(10)), (2, 1, False, hour(10))], SIGHT)
    stream = lambda: K.restricted_stream(spark.readStream.schema(SIGHT).parquet(source), late="20 hours")
    K.run_to_end(stream(), sink, check)
    feed(spark, source, [(1, 1, True, hour(2))], SIGHT)  # the same day, before what came before
    K.run_to_end(stream(), sink, check)
    feed(spark, source, [(3, 3, True, hour(72))], SIGHT)
    K.run_to_end(stream(), sink, check)
    late = K.dropped_late(K.run_to_end(stream(), sink, check))
    assert [(r.account, r.status) for r in spark.read.parquet(sink).collect()] == [(2, "open")] and late == 0
    feed(spark, source, [(1, 1, False, hour(3))], SIGHT)
    assert K.dropped_late(K.run_to_end(stream(), sink, check)) == 1 and spark.read.parquet(sink).count() == 1


def test_state_is_the_open_days(spark, tmp_path):
    source, sink, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    most = []
    for day in range(5):
        feed(spark, source, [(1, f, False, START + datetime.timedelta(days=day, minutes=f)) for f in range(10)], SIGHT)
        most.append(K.most_state(K.run_to_end(K.restricted_stream(spark.readStream.schema(SIGHT).parquet(source)), sink, check)))
    assert max(most[2:]) <= max(most[:3]) + 10


@pytest.mark.parametrize("cuts,ttl", [([30], None), ([5, 50, 51], 10**9)])
def test_new_ideas_come_once(spark, tmp_path, cuts, ttl):
    source, sink, check, schema = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), "account long, name string"
    rng = random.Random(2)
    rows = [(rng.choice([1, 2, None]), rng.choice(["A", " A ", "b", "", None, "c d", f"n{rng.randrange(20)}"])) for _ in range(80)]
    for low, high in zip([0, *cuts], [*cuts, len(rows)]):
        feed(spark, source, rows[low:high], schema)
        K.run_to_end(K.new_ideas(spark.readStream.schema(schema).parquet(source), ttl_ms=ttl), sink, check, timed=ttl is None)
    want = {(a, n.strip()) for a, n in rows if n and n.strip()}
    assert sorted(map(tuple, spark.read.parquet(sink).select("account", "name").collect()), key=repr) == sorted(want, key=repr)


def test_ideas_known_for_good_ask_no_python(spark, tmp_path):
    source, sink, check, schema = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), "account long, name string"
    feed(spark, source, [(1, "a"), (1, " a"), (2, "a"), (None, "a")], schema)
    progress = K.run_to_end(K.new_ideas(spark.readStream.schema(schema).parquet(source)), sink, check)
    assert [o["operatorName"] for o in progress[0]["stateOperators"]] == ["dedupe"] and K.most_state(progress) == 3


CHANGES, ACTS = "sequence long, file_id long, changed_at timestamp", "event_id long, file_id long, actor long, acted_at timestamp"


def logs(seed, n=150):
    rng = random.Random(seed)
    at = lambda: START + datetime.timedelta(seconds=rng.randrange(5 * 3600))
    changes = sorted(((i, rng.choice([1, 2, 3, None]), at()) for i in range(n)), key=lambda r: r[2])
    return changes, sorted(((i, rng.choice([1, 2, 3, None]), rng.randrange(4), at()) for i in range(n)), key=lambda r: r[3])


@pytest.mark.parametrize("steps", [1, 3, 6])
def test_changes_meet_activity_as_in_a_batch(spark, tmp_path, steps):
    changes, acts = logs(1)
    want = sorted(map(tuple, K.actors_of_changes(spark.createDataFrame(changes, CHANGES), spark.createDataFrame(acts, ACTS)).collect()))
    a, b, sink, check = (str(tmp_path / x) for x in ("a", "b", "out", "check"))
    most = 0
    for i in range(steps):
        span = [START + datetime.timedelta(seconds=5 * 3600 * x // steps) for x in (i, i + 1)]
        feed(spark, a, [r for r in changes if span[0] <= r[2] < span[1]], CHANGES)
        feed(spark, b, [r for r in acts if span[0] <= r[3] < span[1]], ACTS)
        progress = K.run_to_end(K.actors_of_changes(spark.readStream.schema(CHANGES).parquet(a), spark.readStream.schema(ACTS).parquet(b)), sink, check)
        assert K.dropped_late(progress) == 0
        most = K.most_state(progress[-1:])
    assert sorted(map(tuple, spark.read.parquet(sink).select("sequence", "file_id", "changed_at", "event_id", "actor", "acted_at").collect())) == want and want
    assert most < 80  # of 300 rows; what lies beyond the watermark by the reach is gone
    feed(spark, a, [(999, 1, START)], CHANGES)
    progress = K.run_to_end(K.actors_of_changes(spark.readStream.schema(CHANGES).parquet(a), spark.readStream.schema(ACTS).parquet(b)), sink, check)
    assert K.dropped_late(progress) == 1 and spark.read.parquet(sink).filter(F.col("sequence") == 999).isEmpty()


def test_changes_are_compared_only_with_what_is_near_in_time(spark):
    """A busy file over many days: pairs that the join looks at grow with the days, not with their square."""
    days, schema = 40, "file_id long, at timestamp"
    at = lambda i: START + datetime.timedelta(hours=i)
    rows = spark.createDataFrame([(1, at(i)) for i in range(24 * days)], schema)
    changes = rows.select(F.monotonically_increasing_id().alias("sequence"), "file_id", F.col("at").alias("changed_at"))
    acts = rows.select(F.monotonically_increasing_id().alias("event_id"), "file_id", F.lit(1).cast("long").alias("actor"), F.col("at").alias("acted_at"))
    met = K.actors_of_changes(changes, acts)
    assert met.count() == 24 * days
    keys = met._jdf.queryExecution().optimizedPlan().toString()
    assert "of_span" in keys and "on_span" in keys
    edges = [datetime.timedelta(minutes=m, seconds=s) for m in range(-10, 11, 5) for s in (-1, 0, 1)]
    c = spark.createDataFrame([(m, 1, START + datetime.timedelta(minutes=m)) for m in range(0, 90, 5)], CHANGES)
    a = spark.createDataFrame([(i * 100 + m, 1, 0, START + datetime.timedelta(minutes=m) + e) for m in range(0, 90, 30) for i, e in enumerate(edges)], ACTS)
    want = sorted((x.sequence, y.event_id) for x in c.collect() for y in a.collect() if abs(x.changed_at - y.acted_at) <= datetime.timedelta(minutes=10))
    assert sorted((r.sequence, r.event_id) for r in K.actors_of_changes(c, a).collect()) == want
