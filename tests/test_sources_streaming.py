"""Sinks that can be run again, extraction, the completer, and the forward stream."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from siltstone.sources import completer, extraction as X, listing as S, sinks
from siltstone.sources.scratch import Scratch
from siltstone.streaming.forward import daily_totals, run_forward


def test_wipe_counts(spark):
    counts = sinks.wipe_counts({"s": spark.createDataFrame([("a",), ("b",)], "acc string"), "t": spark.createDataFrame([("b",)], "acc string")}, "acc", "a")
    assert {r.table: r.rows for r in counts.collect()} == {"s": 1, "t": 0}


def test_day_codec(spark):
    files = spark.createDataFrame([("f1", "2024-01-01", 1), ("f2", "2024-01-01", 2), ("f1", "2024-01-02", 1)], "file_id string, day string, n int")
    one, days = sinks.encode_days(files)
    assert one.count() == 2 and sorted(map(tuple, sinks.decode_days(one, days).select(*files.columns).collect())) == sorted(map(tuple, files.collect()))
    assert sinks.decode_days(one.filter("file_id = 'f1'"), days) is None


def test_digests(spark):
    rows = [("a@x", "field_change", None), ("a@x", "new_entity", "g"), ("a@x", "new_entity", "g"), (None, "field_change", None)]
    got = sinks.digests(spark.createDataFrame(rows, "reviewer_email string, kind string, group_id string")).collect()
    assert len(got) == 1 and (got[0].field_change, got[0].new_entity, got[0].groups) == (1, 2, 1) and "2 new entity" in got[0].body


def test_skip_reasons(spark):
    m = X.MIME
    rows = [
        ("folder", m["folder"], 1, True, None, "folder"), ("doc", m["doc"], 10**9, False, None, None), ("pdf", m["pdf"], 10, False, None, None), ("big", m["pdf"], 10**9, False, None, "too_large"), ("txt", "text/plain", None, False, None, None),
        ("zip", "application/zip", 1, False, None, "unsupported_mime"), ("s1", m["shortcut"], 1, False, None, "unsupported_mime"), ("s2", m["shortcut"], 1, False, ("t", m["folder"]), "unsupported_mime"), ("s3", m["shortcut"], 1, False, ("t", m["pdf"]), "shortcut_unverified_size"),
        ("s4", m["shortcut"], 1, False, ("t", m["doc"]), None), ("s5", m["shortcut"], 1, False, ("t", m["shortcut"]), "unsupported_mime"),
    ]
    df = spark.createDataFrame([r[:5] for r in rows], "id string, mime_type string, size long, is_folder boolean, shortcut struct<id:string,mime_type:string>")
    assert {r.id: r.why for r in df.select("id", X.skip_reason(1000).alias("why")).collect()} == {r[0]: r[5] for r in rows}


def test_extraction(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("word/document.xml", "<w:p><w:r><w:t>one</w:t></w:r><w:r><w:t> &amp; two</w:t></w:r></w:p><w:p><w:t>three</w:t></w:p>")
    rows = [("docx", X.MIME["docx"], buffer.getvalue()), ("bad", X.MIME["docx"], b"no zip"), ("html", "text/html", b"<p>a <b>b</b></p><script>x</script><p>c</p>"), ("txt", "text/plain", b"plain"), ("zip", "application/zip", b"")]
    df = spark.createDataFrame(rows, "id string, mime_type string, content binary").select("*", F.lit(1).cast("long").alias("size"), F.lit(False).alias("is_folder"), F.lit(None).cast("struct<id:string,mime_type:string>").alias("shortcut"))
    got = {r.id: (r.kind, r.reason, r.text) for r in X.extract(df, 1000).collect()}
    assert got["docx"][2] == "one & two\nthree" and got["bad"][:2] == ("skip", "parse_error") and got["html"][2] == "a b\nc" and got["txt"][2] == "plain" and got["zip"][:2] == ("skip", "unsupported_mime")


def test_only_native_documents_are_limited_by_characters(spark):
    m, long = X.MIME, b"x" * 2_000_001
    rows = [("text", "text/plain", long), ("over", m["doc"], long), ("at", m["sheet"], long[1:]), ("slides", m["slides"], b" \xe2\x80\x83 "), ("blank", "text/csv", " \u00a0\ufeff\n".encode()), ("trim", "text/plain", "\n a b\u3000".encode()), ("pdf", m["pdf"], b"p")]
    df = spark.createDataFrame(rows, "id string, mime_type string, content binary").select("*", F.lit(None).cast("long").alias("size"), F.lit(False).alias("is_folder"), F.lit(None).cast("struct<id:string,mime_type:string>").alias("shortcut"))
    readers = {m[k]: lambda c: c.decode() for k in X.NATIVE}
    got = {r.id: (r.kind, r.reason, r.n) for r in X.extract(df, X.MAX_BYTES, readers=readers).select("id", "kind", "reason", F.length("text").alias("n")).collect()}
    skip = lambda why: ("skip", why, None)
    assert got == {"text": ("ok", None, 2_000_001), "over": skip("too_many_chars"), "at": ("ok", None, 2_000_000), "slides": skip("empty"), "blank": skip("empty"), "trim": ("ok", None, 3), "pdf": skip("no_extractor")}


def test_flatteners(spark):
    df = spark.createDataFrame([([("p", "one", None), ("table", None, [["a", "b"], ["c"]]), ("p", " ", None)], [(False, "s1", "note"), (True, "hidden", None), (None, "s2", None)], [("T", [["1", "2"]])])], "blocks array<struct<kind:string,text:string,rows:array<array<string>>>>, slides array<struct<hidden:boolean,body:string,notes:string>>, sheets array<struct<title:string,rows:array<array<string>>>>")
    r = df.select(X.paragraphs_text(F.col("blocks")).alias("a"), X.slides_text(F.col("slides")).alias("b"), X.sheets_text(F.col("sheets")).alias("c")).first()
    assert (r.a, r.b, r.c) == ("one\na\tb\nc", "s1\n[Notes]\nnote\n\ns2", "# T\n1\t2")


def test_fixtures_must_pair(spark):
    gold, texts = spark.createDataFrame([("a", 1)], "id string, g int"), spark.createDataFrame([("a", "t"), ("b", "u")], "id string, text string")
    with pytest.raises(ValueError, match="b"):
        X.load_fixtures(gold, texts)
    assert X.load_fixtures(gold, texts.filter("id = 'a'")).count() == 1


class Flaky:
    def complete(self, step, prompt):
        raise RuntimeError("no " + prompt)


def test_completer(spark):
    prompts = spark.createDataFrame([("1", "interpret", "p"), ("2", "unknown", "q")], "id string, step string, prompt string")
    got = {r.id: r for r in completer.complete(prompts).collect()}
    assert '"deck_type": "other"' in got["1"].reply and got["2"].reply == "{}"
    assert {(r.reply, r.error, r.attempts) for r in completer.complete(prompts, Flaky()).collect()} == {(None, "no p", 3), (None, "no q", 3)}
    replies = spark.createDataFrame([("d", '{"deck_type":"pitch","ideas":[{"name":" A ","facets":["x ",""]},{"name":" ","facets":[]}]}'), ("e", '{"deck_type":"other","ideas":[{"name":"B","facets":[]}]}')], "id string, reply string")
    assert [(r.id, r.name, r.facets) for r in completer.gated_ideas(replies).collect()] == [("d", "A", ["x"])]


def test_listing(spark):
    schema = "id string, name string, mime_type string, parent_id string, created_time string, trashed boolean, position int, size long"
    rows = [("a", "A", S.FOLDER, "root", None, False, 0, 0), ("f", "F1", "text/plain", "a", "2", False, 1, 5), ("f", "F2", "text/plain", "root", "1", False, 2, 5), ("g", "G", "text/plain", "a", None, False, 3, 9), ("t", "T", "text/plain", "a", "0", True, 4, 1)]
    e = spark.createDataFrame(rows, schema)
    assert {r.id for r in S.children(e, "a").collect()} == {"f", "g"} and [r.id for r in S.subfolders(e, "root").collect()] == ["a"]
    below = S.files_below(e, spark.createDataFrame([("a",), ("root",)], "id string"), F.col("size") < 9).collect()
    assert [(r.id, r.name) for r in below] == [("f", "F1")]
    assert [r.name for r in S.oldest_files(e, 2).collect()] == ["G", "F2"]
    assert S.by_ids(e, spark.createDataFrame([("g",), ("zz",)], "id string")).count() == 1
    feed = spark.createDataFrame([(1, "f"), (5, "g")], "sequence int, file_id string")
    changes, token = S.changes_since(feed, 1, 0)
    assert changes.count() == 1 and token == 5 and S.changes_since(feed, 5, 0)[1] == 5
    with pytest.raises(S.ChangeTokenExpired):
        S.changes_since(feed, 1, 3)


EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def events(spark, *rows):
    return spark.createDataFrame([(i, t, 1, k, 1.0, '{"k": 3}') for i, t, k in rows], "event_id long, ts string, user_id long, event_type string, value double, props string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_forward_runs_take_only_what_is_new(spark, tmp_path):
    source, sink, check = (str(tmp_path / x) for x in ("in", "sink", "check"))
    events(spark, (1, "2024-01-01 10:00:00", "signup"), (2, "2024-01-01 10:01:00", "view"), (1, "2024-01-01 10:00:00", "signup")).coalesce(1).write.mode("append").parquet(source)
    total = lambda df: {str(r.day): r.edits for r in df.collect()}
    assert total(run_forward(spark, source, sink, check)) == {"2024-01-01": 1}
    assert total(run_forward(spark, source, sink, check)) == {"2024-01-01": 1}
    events(spark, (3, "2024-01-01 10:00:30", "purchase"), (4, "2024-01-02 00:00:00", "purchase")).coalesce(1).write.mode("append").parquet(source)
    assert total(run_forward(spark, source, sink, check)) == {"2024-01-01": 2, "2024-01-02": 1}


def test_daily_totals_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    events(spark, (1, "2024-01-01 10:00:00", "view"), (2, "2024-01-01 11:00:00", "view"), (3, "2024-01-03 00:00:00", "view")).write.parquet(source)
    out = daily_totals(spark.readStream.schema(EVENTS).parquet(source)).writeStream.format("memory").queryName("daily").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    out.awaitTermination()
    assert {(str(r.day), r.n) for r in spark.table("daily").collect()} == {("2024-01-01", 2), ("2024-01-03", 1)}


def test_scratch_tables_come_and_go(spark):
    scratch = Scratch(spark)
    saved = scratch.save(spark.range(3), "t")
    assert saved.count() == 3 and sinks.exists(spark, f"{scratch.root}/t")
    scratch.drop("t")
    assert not sinks.exists(spark, f"{scratch.root}/t")
