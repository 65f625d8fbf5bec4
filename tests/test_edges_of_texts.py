"""Functions at the edges: marks and compatibility forms, empty sections, parts with wrappers, e-mails, transient errors, deep chains."""

import pytest
from pyspark.sql import functions as F

from siltstone.functions import text as X
from siltstone.functions.validate import validated
from siltstone.operators import hierarchy as T, lifecycle as L, reports as P, resolution as R, scores as S
from siltstone.sources import completer, listing


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_unaccented_decomposes(spark):
    got = [one(spark, X.unaccented(F.lit(t).cast("string"))) for t in ("ế ệ ș ț", "ﬁne ﬂow", "ＦＵＬＬ", "Crème", "plain A-b", "", None, "ß ø", "é")]
    assert got == ["e e s t", "fine flow", "full", "creme", "plain a b", "", None, "ß ø", "e"]
    assert one(spark, X.unaccented_each(F.array(F.lit("É"), F.lit(None).cast("string"), F.lit("x")))) == ["e", None, "x"]


def test_empty_sections_are_null(spark):
    doc = F.lit("## Context\n \n## Transient\nx\n")
    assert one(spark, X.section(doc, "Context")) is None and one(spark, X.section(doc, "Transient")) == "x"


def test_parts_lose_their_wrappers(spark):
    reply = "=== GENERAL_CONTEXT ===\n```markdown\n## Context\n- a\n```\n=== GENERAL_TRANSIENT ===\n## At a glance\n- skip\n## Context\n- b\n=== SENSITIVE_CONTEXT ===\n- c\n"
    assert tuple(one(spark, X.synthesis_parts(F.lit(reply)))) == ("- a", "- b", "- c", "")
    assert tuple(one(spark, X.synthesis_parts(F.lit("## Context\nall of it")))) == ("", "", "all of it", "")


@pytest.mark.parametrize(("raw", "ok"), [("a.b@c.co", True), (".a@b.co", False), ("a..b@c.co", False), ("a@b", False), ("a.@b.co", False)])
def test_emails(spark, raw, ok):
    assert one(spark, validated(F.lit("account"), F.lit("primary_contact_email"), F.lit(raw))).ok == ok


ERRORS = [
    (("truncated", 503, "ECONNRESET", "fetch failed", None), False), (("timeout", None, None, None, None), True), (("api", 408, None, None, None), True), ((None, 408, None, None, None), False),
    ((None, 501, None, None, None), True), ((None, 599, None, None, None), True), ((None, 429, None, None, None), True), ((None, 403, None, None, ["rateLimitExceeded"]), True), ((None, 403, None, None, ["forbidden"]), False),
    ((None, 403, None, None, None), False), ((None, 404, "503", None, None), True), ((None, 503, "404", None, None), False), ((None, None, "ENETUNREACH", None, None), True), ((None, None, "ENOTFOUND", None, None), False),
    ((None, None, None, "Fetch Failed", None), True), ((None, None, None, "DEADLINE EXCEEDED", None), True), ((None, None, None, "overloaded", None), False), (("api", 400, None, "fetch failed", None), False),
    (("api", 400, None, "socket hang up", None), True), (("body-timeout", None, None, None, None), True), ((None, None, "P2024", None, None), True), ((None, None, "P2002", None, None), False), ((None, None, None, None, None), False),
]


def test_transient_errors(spark):
    rows = spark.createDataFrame([(i, e) for i, (e, _) in enumerate(ERRORS)], "i int, e struct<kind:string,status:int,code:string,message:string,reasons:array<string>>")
    got = {r.i: r.t for r in rows.select("i", L.is_transient(F.col("e")).alias("t")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(ERRORS)}


@pytest.mark.parametrize("depth", [300, 1000])
def test_chains_of_any_depth_reach_the_root(spark, depth):
    chain = [(f"f{i}", f"n{i}", f"f{i - 1}" if i else "root", i) for i in range(depth)]
    loop = [("a", "A", "b", 0), ("b", "B", "c", 0), ("c", "C", "a", 0), ("d", "D", "a", 0)]
    tree = T.resolve(spark.createDataFrame(chain + loop, "id string, name string, parent_id string, position int"), "root").cache()
    got = T.reach_counts(tree).first()
    assert (got.n_in, got.n_out, got.n_orphan, got.n_beyond_cap, got.deepest) == (depth, 0, 4, depth - 101, 101)
    stats = T.map_stats(spark.createDataFrame([("x", "f99", ["f99", "q"]), ("y", "f100", ["f100"]), ("z", "gone", ["gone"]), ("r", "root", ["root"])], "id string, parent_id string, parents array<string>"), tree, "root", None, "files").first()
    assert (stats.in_scope, stats.out_of_scope, stats.orphans, stats.multi_parent, stats.depth_cap) == (2, 0, 1, 1, 1)
    placed = T.parent_paths(spark.createDataFrame([("f0",), ("f100",), ("root",), (None,)], "parent_id string"), tree, "root", "Work")
    assert {r.parent_id: r.parent_path for r in placed.collect()} == {"f0": "Work / n0", "f100": None, "root": "Work", None: None}


def test_refusals_and_bad_folders(spark):
    rows = [("a", "A", "root", 0), ("b", "B", "a", 1), ("c", "C", "b", 2), ("d", "D", "root", 3)]
    entries = spark.createDataFrame([(*r, listing.FOLDER, False) for r in rows], "id string, name string, parent_id string, position int, mime_type string, trashed boolean")

    class Store:
        calls = 0

        def entries(self, spark):
            self.calls += 1
            if self.calls == 1:
                raise listing.ListingRefused("no sweep")
            return entries

    told, bad = [], []
    found = listing.gathered(Store(), spark, "root", spark.createDataFrame([("b",)], "id string"), told.append, lambda df: bad.extend(r.id for r in df.collect()))
    assert {r.id for r in found.collect()} == {"a", "b", "d"} and bad == ["b"] and len(told) == 1

    class Broken:
        def entries(self, spark):
            raise OSError("gone")

    with pytest.raises(OSError):
        listing.gathered(Broken(), spark, "root")


def test_votes_join_all_members_and_a_second_schedule_joins_more(spark):
    roster = spark.createDataFrame([(f"m{i:02}", None, None, i) for i in range(24)], "id string, folder_id string, markdown string, created_at int")

    def detector(window):
        ids = list(window["id"])
        out = [(a, [b], 0.9) for a, b in zip(ids, ids[1:]) if int(a[1:]) + 1 == int(b[1:]) and int(a[1:]) % 2 == 0]
        # canonical members of pairs are alike too
        return out + ([] if any(int(i[1:]) % 2 for i in ids) else [(ids[0], ids[1:], 0.95)])

    got = {r.node: r.component for r in R.clustered(roster, detector, 6).collect()}
    assert len(got) == 24 and set(got.values()) == {"m00"}
    assert {r.node: r.component for r in R.clustered(roster, detector, 6, schedules=1).collect()}["m03"] == "m02"
    assert R.clustered(roster.limit(1), detector).count() == 0
    three = spark.createDataFrame([(0, 0, "a", ["b", "c"], 0.9, None)], "window int, position int, canonical string, kept array<string>, confidence double, dropped string")
    assert {(r.a, r.b) for r in R.votes(three).collect()} == {("a", "b"), ("a", "c"), ("b", "c")}


@pytest.mark.parametrize(("members", "size"), [(9, 8), (20, 8), (33, 6), (7, 2)])
def test_windows_follow_the_circle_method(spark, members, size):
    got = {}
    for r in R.windows(spark, members, size).collect():
        got.setdefault((r.round, r.window), set()).add(r.block)
    want = {frozenset(p) for pairs in R.round_robin(-(-members // max(1, size // 2))) for p in pairs}
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want))


def test_plans_are_written_once_their_creations_have_ids(spark):
    decisions = spark.createDataFrame([("a", 1, 1, "create", ["x"]), ("a", 2, 1, "update", ["x", "y"]), ("a", 3, 2, "create", ["z"]), ("a", 4, 2, "update", ["z", "w"]), ("a", 5, 1, "noop", ["x", "y"])], "account string, position int, idea_no int, action string, facets array<string>")
    written, skipped = R.applied_plan(decisions, spark.createDataFrame([("a", 1, "uuid-1")], "account string, idea_no int, real_id string"))
    assert {(r.position, r.real_id) for r in written.collect()} == {(1, "uuid-1"), (2, "uuid-1")} and {r.position for r in skipped.collect()} == {3, 4}
    assert {(r.idea_no, tuple(r.facets), r.decks) for r in R.resolved_ideas(decisions).collect()} == {(1, ("x", "y"), 3), (2, ("z", "w"), 2)}


def test_merge_synthesis_asks_only_where_there_is_something(spark):
    rows = [(1, 0, "## Context\n- a\n\n## Transient\n- old [expires: 2020-01-01]\n", None), (1, 1, None, "## Context\n- s"), (2, 0, "no sections", None)]
    asked = []

    class Reply:
        def complete(self, step, prompt):
            assert step == "synthesize" and "- a" in prompt and "old" not in prompt
            return "=== GENERAL_CONTEXT ===\n- A\n=== SENSITIVE_CONTEXT ===\n- S\n"

    got = {r.id: (r.general, r.sensitive, r.skipped) for r in completer.merged_documents(spark.createDataFrame(rows, "id int, position int, status string, sensitive string"), "2024-01-01", Reply()).collect()}
    assert got == {"1": ("## Context\n- A", "## Context\n- S", False), "2": (None, None, True)} and not asked


def test_replies_of_a_wrong_shape_are_errors(spark):
    replies = spark.createDataFrame([("1", "match_idea", '{"match_index": 2, "merged_facets": ["a"]}', None), ("2", "match_idea", "no json", None), ("3", "match_idea", None, "down"), ("4", "cluster", "{}", None)], "id string, step string, reply string, error string")
    got = {r.id: (r.error, r.match_index, r.merged_facets) for r in completer.read_replies(replies, "match_idea").collect()}
    assert got == {"1": (None, 2, ["a"]), "2": ("unreadable", None, None), "3": ("down", None, None)}


def test_costs(spark):
    assert one(spark, S.worst_cost(F.lit("flash"), F.lit("a" * 10), F.lit(100))) == pytest.approx((4 * 0.3 + 100 * 2.5) / 1e6)
    charge = lambda p, o, t, total: one(spark, S.charge(F.lit("flash"), *(F.lit(x).cast("long") for x in (p, o, t, total)), F.lit(9.0)))
    assert charge(None, 5, 5, 10) == 9 and charge(10, None, 5, None) == 9
    assert charge(10, 5, None, 40) == pytest.approx((10 * 0.3 + 30 * 2.5) / 1e6) and charge(10, 5, 50, 40) == pytest.approx((10 * 0.3 + 55 * 2.5) / 1e6)


def test_tokens_differ_and_columns_go(spark):
    rows = P.with_token(spark.range(20)).collect()
    assert len({r.review_token for r in rows}) == 20 and all(len(r.review_token) == 32 for r in rows)
    assert P.without_columns(spark.range(1).withColumn("big", F.lit("x")), "big").columns == ["id"]
