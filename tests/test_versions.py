"""The index: look-through, veto, ties, reasons."""

from datetime import datetime as D

from pyspark.sql import functions as F

from siltstone.operators import versions as V

SCHEMA = "id long, file_id string, scanned_at timestamp, was_extracted boolean, content_hash string, skip_reason string, modified_time timestamp, name string, path string, mime_type string"


def day(n):
    return D(2024, 1, n)


def versions(spark, *rows):
    """(file, day, extracted, hash, reason)"""
    return spark.createDataFrame([(i, f, day(d), e, h, r, day(d), "n", "p", "m") for i, (f, d, e, h, r) in enumerate(rows)], SCHEMA)


def known(df, cutoff=20):
    return {r.file_id: r.content_hash for r in V.last_extracted(df, F.lit(day(cutoff))).collect()}


def test_transparent_rows_are_looked_through(spark):
    df = versions(spark, ("a", 1, True, "h1", None), ("a", 2, False, None, "content_unchanged"), ("a", 3, False, None, "trashed"), ("a", 4, False, None, "index_refresh"))
    assert known(df) == {"a": "h1"}


def test_a_newer_failure_vetoes(spark):
    assert known(versions(spark, ("a", 1, True, "h1", None), ("a", 2, False, None, "error"))) == {}


def test_cutoff_and_missing_hash_veto(spark):
    assert known(versions(spark, ("a", 1, True, "h1", None), ("a", 21, True, "h2", None), ("b", 1, True, "h", None), ("b", 2, True, None, None))) == {}


def test_ties_go_to_the_larger_id(spark):
    df = versions(spark, ("a", 1, True, "h1", None), ("a", 1, True, "h2", None))
    assert V.latest(df, ["file_id"], ["scanned_at", "id"]).first().content_hash == "h2"
    assert known(df) == {"a": "h2"}


def test_reasons_in_their_order(spark):
    listing = spark.createDataFrame([(f, n, p, m, t) for f, n, p, m, t in [("a", "n", "p", "m", day(1)), ("b", "x", "y", "m", day(1)), ("c", "n", "y", "m", day(2)), ("d", "n", "p", "m", None), ("e", "n", "p", "z", day(1)), ("new", "n", "p", "m", day(1))]], "file_id string, name string, path string, mime_type string, modified_time timestamp")
    newest = versions(spark, *[(f, 1, True, "h", None) for f in "abcde"])
    got = {r.file_id: r.reason for r in V.refresh_reason(listing, newest).collect()}
    assert got == {"a": None, "b": "renamed", "c": "moved", "d": "modified", "e": "mime_changed", "new": "unindexed"}
    stand_in = spark.createDataFrame([("c", "y")], "file_id string, account_path string")
    assert {r.file_id: r.reason for r in V.refresh_reason(listing, newest, stand_in).collect()}["c"] == "modified"
    assert {r.reason: r.files for r in V.refresh_counts(V.refresh_reason(listing, newest)).collect()}["unchanged"] == 1


def test_delta(spark):
    listing = spark.createDataFrame([("a", day(1)), ("b", day(3)), ("c", None), ("d", day(1))], "file_id string, modified_time timestamp")
    df = versions(spark, ("a", 2, True, "h", None), ("b", 2, True, "h", None), ("c", 2, True, "h", None), ("d", 2, False, None, "index_refresh"))
    assert {r.file_id: r.reason for r in V.delta_check(listing, df).collect()} == {"a": "delta_unchanged", "b": "modified_since_last", "c": "no_modified_time", "d": "first_seen"}


def test_fingerprint_ignores_order_and_tells_repeats(spark):
    rows = [("k", 1, "a"), ("k", 2, "b"), ("l", 2, "b"), ("l", 1, "a"), ("m", 1, "a"), ("m", 2, "b"), ("m", 2, "b")]
    got = {r.k: r.fingerprint for r in V.fingerprint(spark.createDataFrame(rows, "k string, i int, n string"), ["k"], ["i", "n"]).collect()}
    assert got["k"] == got["l"] != got["m"]
