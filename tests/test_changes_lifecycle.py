"""Validation, guards, states, scores."""

from datetime import datetime as D

from pyspark.sql import functions as F

from siltstone.functions.validate import unchanged, validated
from siltstone.operators import changes as C, lifecycle as L, scores as S

NOW = D(2024, 1, 10)


def test_validators(spark):
    cases = [
        ("account", "status", "active", True, "active"), ("account", "status", "", True, None), ("account", "status", "x", False, None), ("account", "industry", "", True, ""), ("account", "industry", "x" * 129, False, None),
        ("account", "primary_contact_email", "a@b.org", True, "a@b.org"), ("account", "primary_contact_email", "a@b", False, None), ("account", "account_exec_staff_id", "123e4567-e89b-12d3-a456-426614174000", True, "123e4567-e89b-12d3-a456-426614174000"),
        ("campaign", "budget", "12.5", True, "12.5"), ("campaign", "budget", "-1", False, None), ("campaign", "budget", "many", True, None), ("campaign", "live_at", "2024-01-05", True, "2024-01-05"), ("campaign", "live_at", "5.1.2024", False, None),
        ("campaign", "owner", "x", False, None), ("campaign", "notes", "x", False, None), ("campaign", "status", None, True, None),
    ]
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], "i int, entity string, field string, raw string")
    got = {r.i: (r.v.ok, r.v.value) for r in df.select("i", validated(F.col("entity"), F.col("field"), F.col("raw")).alias("v")).collect()}
    assert got == {i: c[3:] for i, c in enumerate(cases)}


def test_no_ops(spark):
    rows = [("account", "notes", " A ", "a", True), ("account", "status", "active", "Active", False), ("account", "notes", None, None, True), ("account", "notes", None, "a", False), ("campaign", "budget", "5", "5", False), ("campaign", "budget", None, None, True)]
    df = spark.createDataFrame(rows, "e string, f string, c string, p string, want boolean")
    assert df.filter(unchanged(F.col("e"), F.col("f"), F.col("c"), F.col("p")) != F.col("want")).count() == 0
    assert df.filter(unchanged(F.col("e"), F.col("f"), F.col("c"), F.col("p"), budget_is_text=False)).count() == 4


def test_invalid_changes_become_notes(spark):
    df = spark.createDataFrame([("account", "a1", "status", None, "x"), ("account", "a1", "notes", "n", "N"), ("campaign", "c1", "live_at", None, "2024-01-05")], "entity string, entity_id string, field string, current string, raw string")
    changes, notes = C.rescued(C.judged(df))
    row = C.change_rows(changes).collect()
    assert len(row) == 1 and str(row[0].value_date) == "2024-01-05" and row[0].value_text is None
    assert [r.field for r in notes.collect()] == ["status"] and "status" in notes.first().note


def test_pending_duplicates(spark):
    schema = "k string, v string"
    pending = spark.createDataFrame([("a", "1", "pending", D(2024, 2, 1)), ("a", None, "pending", D(2024, 2, 1)), ("b", "1", "pending", D(2024, 1, 1)), ("c", "1", "rejected", D(2024, 2, 1))], schema + ", state string, expires_at timestamp")
    new = spark.createDataFrame([("a", "1"), ("a", None), ("a", "2"), ("b", "1"), ("c", "1")], schema)
    assert {(r.k, r.v) for r in C.not_pending(new, pending, ["k", "v"], F.lit(NOW)).collect()} == {("a", "2"), ("b", "1"), ("c", "1")}


def test_facts_worklist_and_new_entities(spark):
    facts, candidates = C.known_facts(spark.createDataFrame([("e", '- one\n- [new campaign candidate "X"] two\ntext\n- one\n- ')], "entity_id string, body string"))
    assert [r.fact for r in facts.collect()] == ["one"] and [r.fact for r in candidates.collect()] == ["two"]
    work = spark.createDataFrame([("a", "f1", "open", D(2024, 1, 1), D(2024, 1, 1)), ("a", "f2", "open", D(2024, 1, 1), D(2024, 1, 1))], "account string, file_id string, status string, first_seen timestamp, last_seen timestamp")
    seen = spark.createDataFrame([("a", "f1", False), ("a", "f2", True), ("a", "f3", False), ("a", "f4", True)], "account string, file_id string, ok boolean")
    updated, emitted = C.restricted_worklist(work, seen, F.lit(NOW))
    assert {r.file_id: (r.status, r.first_seen.day) for r in updated.collect()} == {"f1": ("open", 1), "f2": ("resolved", 1), "f3": ("open", 10)}
    assert [r.file_id for r in emitted.collect()] == ["f3"]
    found = spark.createDataFrame([("g", "New", "hint", {"status": "pitch", "budget": "-1"}), ("h", "Bare", None, {})], "group_id string, name string, note string, fields map<string,string>")
    assert {(r.group_id, r.property, r.value) for r in C.new_entity_rows(found, "campaign").collect()} == {("g", "name", "New"), ("g", "status", "pitch"), ("g", "note", "hint"), ("h", "name", "Bare")}


QUEUE = "id string, status string, requested_at timestamp, started_at timestamp, last_heartbeat_at timestamp, next_attempt_at timestamp, attempts int, error_message string, files_processed int, completed_at timestamp"


def queue(spark, *rows):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], QUEUE)


def test_queue(spark):
    d = lambda n, h=0: D(2024, 1, n, h)
    q = queue(spark, ("a", "pending", d(2), None, None, d(11), 1), ("b", "pending", d(3), None, None, None, 0), ("c", "pending", d(3), None, None, d(9), 2), ("d", "running", d(1), d(9), d(9, 23), None, 1), ("e", "running", d(1), d(9, 23), None, None, 3))
    assert L.next_claim(q, F.lit(NOW)).first().id == "b"
    claimed = {r.id: r for r in L.claimed(q, spark.createDataFrame([("b",)], "id string"), F.lit(NOW)).collect()}
    assert (claimed["b"].status, claimed["b"].attempts, claimed["b"].started_at) == ("running", 1, D(2024, 1, 10)) and claimed["a"].status == "pending"
    assert {r.id for r in L.reclaimed(q, F.lit(NOW)).filter("status = 'pending'").collect()} == {"a", "b", "c", "d", "e"}
    assert L.next_wait(q, F.lit(NOW)).first().seconds == 86400
    failures = spark.createDataFrame([("d", "x", True), ("e", "y", True), ("a", "z", False)], "id string, error string, transient boolean")
    after = {r.id: r for r in L.failed_once_more(q, failures, F.lit(NOW)).collect()}
    assert (after["d"].status, after["d"].next_attempt_at) == ("pending", D(2024, 1, 10, 0, 1)) and after["e"].status == after["a"].status == "failed" and after["e"].error_message == "y"
    done = {r.id: r for r in L.finished(L.failed_once_more(q, failures, F.lit(NOW)), spark.createDataFrame([("d", 7)], "id string, files_processed int"), F.lit(NOW)).collect()}
    assert (done["d"].status, done["d"].error_message, done["d"].files_processed) == ("completed", None, 7)
    assert L.exit_code(q).first()[0] == 1 and L.exit_code(q.filter("id = 'b'")).first()[0] == 0 and L.exit_code(q.limit(0)).first()[0] == 0
    assert [r.w for r in spark.range(1, 9).select(L.backoff(F.col("id")).alias("w")).collect()] == [60, 120, 240, 480, 960, 1920, 3600, 3600]


def test_scores(spark):
    decisions = [("a", 1, "k1", "create", "x"), ("a", 2, "k1", "merge", "x"), ("a", 3, "k1", "merge", "y"), ("a", 4, "k2", "create", "x"), ("a", 5, "k1", "merge", None), ("a", 6, "k9", "merge", "x"), ("a", 7, "k3", "create_after_match_error", None), ("b", 1, "k", "create", "x")]
    got = {r.account: r.asDict() for r in S.merge_score(spark.createDataFrame(decisions, "account string, position int, cluster string, action string, key string")).collect()}
    assert {k: got["a"][k] for k in ("correct", "false_merges", "unscored", "missed", "false_merge_rate")} == {"correct": 1, "false_merges": 1, "unscored": 2, "missed": 1, "false_merge_rate": 0.5}
    assert got["b"]["missed"] == 0 and got["b"]["false_merge_rate"] is None
    assert [r.id for r in S.evenly_spaced(spark.range(10), 4, "id").orderBy("id").collect()] == [0, 2, 5, 7]
    changed = S.keys_changed(*(spark.createDataFrame([("r", k)], "id string, keys array<string>") for k in (["a", "b"], ["b", "c"]))).first()
    assert (changed.lost, changed.added) == (["c"], ["a"])
