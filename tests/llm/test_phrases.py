"""Phrase mining: the stack, chunks and slices against brute force, odd input."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltstone.llm import phrases
from tests.llm.cases import ODD_TEXTS, odd_docs


def brute(docs, longest=5, least=100, percent=100, top=2000):
    """The rows of ``mine`` for (text, lang) pairs."""
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    found = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        inside = (q for (g, q), b in f.items() if g == lang and len(q) > len(p) and b >= least and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q))))
        if next(inside, None):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -s) for lang, own in found.items() for rank, (s, a, p, left, right) in enumerate(sorted(own)[:top], 1))


def mined(docs, **kw):
    return sorted(map(tuple, phrases.mine(docs, **kw).collect()))


def texts(n, seed=0):
    rng = np.random.default_rng(seed)
    vocabulary = ["the", "The", "a", "of\x01x", "of", "of\x00", "of\x00the", "café", "日本", "x-y", "\x02", "re\x01"] + [f"w{i}" for i in range(30)]
    share = 1 / np.arange(1, len(vocabulary) + 1)
    ends = np.array([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", " ? "])
    for i in range(n):
        k = int(rng.integers(0, 60))
        words = rng.choice(vocabulary, k, p=share / share.sum())
        yield "".join(w + e for w, e in zip(words, rng.choice(ends, k))) + ("new york city hall" if i % 3 == 0 else "")


@pytest.mark.parametrize("least,percent,top", [(5, 100, 2000), (3, 60, 7)])
def test_rows_equal_brute_force(spark, least, percent, top):
    data = [(t, ["en", "de", None, "und", ""][i % 5]) for i, t in enumerate(texts(300))] + [(None, "en"), ("", "xx"), ("one", None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in data], "text string, lang string, phrase string, n int").repartition(5)
    assert mined(docs, least=least, percent=percent, top=top) == brute(data, least=least, percent=percent, top=top)


def words_of(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text)):
        yield re.findall(r"[^\x20\x09]+", piece)


@pytest.mark.parametrize("chunk,listed", [(7, True), (500, True), (phrases.CHUNK, True), (7, False), (phrases.CHUNK, False)])
def test_chunks_and_ranges_do_not_change_the_sums(spark, chunk, listed):
    data = [(" ".join(texts(40, i)), "en") for i in range(6)] + [("again and again " * 300, "en"), ("long" * 5000, "fr"), ("a b c", "fr")]
    docs = spark.createDataFrame(data, "text string, lang string").coalesce(1).select(F.col("lang").cast("binary"), F.col("text").cast("binary"))
    names = sorted({(lang, w) for t, lang in data for own in words_of(t) for w in own})
    if listed:
        numbers = {x: i for i, x in enumerate(names, 1)}
        lists = {g: phrases.Listed({w.encode(): i for (h, w), i in numbers.items() if h == g}) for g in ("en", "fr")}
        code = phrases.Coding(phrases.BITS, lists=spark.sparkContext.broadcast({g.encode(): x for g, x in lists.items()}))
    else:
        numbers = {x: phrases.hashed(x[0].encode(), x[1].encode(), 3) for x in names}
        code = phrases.Coding(phrases.HASHED, bitmap=spark.sparkContext.broadcast(np.full(phrases.WORDS, ~np.uint64(0))), seed=3)
    bounds = phrases.ends(docs, code, 5, 10**9 if chunk == 7 else 1, 9)
    got, of, want = Counter(), {}, Counter()
    for r in phrases.suffixes(docs, code, 5, bounds, chunk).collect():
        key = tuple(v for c, v in r.asDict().items() if c.startswith("k"))
        got[key] += r.n
        assert of.setdefault(key, r.part) == r.part == sum(key >= b for b in bounds)
    for text, lang in data:
        for w in words_of(text):
            for i in range(len(w)):
                own = [numbers[lang, x] for x in w[i : i + 5]]
                want[tuple(int(k[0]) for k in code.packed([np.array([x]) for x in own + [0] * (5 - len(own))]))] += 1
    assert got == want


def test_packed_suffixes_keep_their_order():
    rng = np.random.default_rng(1)
    code = phrases.Coding(phrases.BITS)
    columns = [rng.integers(0, 1 << phrases.BITS, 500) for _ in range(5)]
    columns[0][:] = columns[0] % 3
    keys = code.packed(columns)
    assert [c.tolist() for c in code.unpacked(keys, 5)] == [c.tolist() for c in columns]
    assert sorted(zip(*keys)) == [tuple(int(k[0]) for k in code.packed([np.array([x]) for x in row])) for row in sorted(zip(*columns))]
    wide = phrases.Coding(phrases.HASHED)
    hashes = [rng.integers(0, 1 << 62, 9) for _ in range(3)]
    assert [c.tolist() for c in wide.unpacked(wide.packed(hashes), 3)] == [c.tolist() for c in hashes]


@pytest.mark.parametrize("bits", [phrases.BITS, phrases.HASHED])
def test_distinct_rows_come_in_order(bits):
    rng = np.random.default_rng(2)
    columns = [rng.choice(rng.integers(0, 1 << bits - 1, 3), 400) for _ in range(5)]
    first, n = phrases.distinct(columns, bits)
    want = Counter(zip(*(c.tolist() for c in columns)))
    assert [tuple(int(c[i]) for c in columns) for i in first] == sorted(want) and n.tolist() == [want[x] for x in sorted(want)]


def test_slices_do_not_change_the_words(monkeypatch):
    text = " ".join(texts(40)).encode()
    whole = [w for part in phrases.slices(text) for w in part]
    monkeypatch.setattr(phrases, "SLICE", 100)
    assert [w for part in phrases.slices(text) for w in part] == whole and len(list(phrases.slices(text))) > 10


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_the_stack_over_any_batches(size):
    rng = np.random.default_rng(3)
    rows = Counter(tuple([*map(int, rng.integers(1, 5, k)), *[0] * (5 - k)]) for k in map(int, rng.integers(1, 6, 400)))
    ordered, bounds = sorted(rows, reverse=True), [(1, 3, 2, 0, 0), (2, 2, 0, 0, 0), (2, 2, 2, 1, 0)]
    want, code = Counter(), phrases.Coding(phrases.BITS)
    for r, n in rows.items():
        for k in range(1, 6):
            if r[k - 1]:
                want[(*r[:k], *[0] * (5 - k))] += n
    keys = code.packed([np.array(c) for c in zip(*ordered)])
    part = [sum(r >= b for b in bounds) for r in ordered]
    table = pa.table({"part": pa.array(part, pa.int32()), "k0": keys[0], "k1": keys[1], "n": pa.array([rows[r] for r in ordered], pa.int32())})
    got, small = Counter(), 0
    for b in phrases.beginnings(iter(table.to_batches(size)), code, 5, 12):
        for *c, f in zip(*(x.to_pylist() for x in b.columns)):
            got[tuple(c)] += f
            small += f < 12
    assert all(got[x] == f for x, f in want.items() if f >= 12) and all(want[x] == f for x, f in got.items()) and small <= 10 * (len(bounds) + 1)


def test_ranges_hand_on_their_edges(spark):
    docs = spark.createDataFrame([(f"the same start {i % 40} {i % 7}", "en") for i in range(2000)] + [("the other", "en")] * 300, "text string, lang string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert mined(docs.repartition(8)) == brute([tuple(r) for r in docs.collect()])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hashes_beyond_a_vocabulary_give_the_same_rows(spark):
    data = [(t, ["en", None][i % 2]) for i, t in enumerate(texts(200))]
    docs = spark.createDataFrame(data, "text string, lang string").repartition(3)
    assert mined(docs, least=4, vocabulary=5) == mined(docs, least=4) == brute(data, least=4)


def test_words_that_share_a_hash_are_noticed(spark):
    words = spark.createDataFrame([(b"en", b"a", 7, 9), (b"en", b"b", 7, 1), (b"en", b"c", 8, 9)], "lang binary, word binary, code long, n long")
    from siltstone.sources.scratch import Scratch

    assert phrases.coding(words, Scratch(spark), 5, 0, 1) is None and phrases.coding(words, Scratch(spark), 5, 0, 2)[0].lists is not None


def test_products_beyond_64_bits(spark):
    counted = spark.createDataFrame([("en", "a b", 2, 3 * 10**12), ("en", "a", 1, 4 * 10**12), ("en", "b", 1, 5 * 10**12)], "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("en", 7 * 10**13)], "lang string, n long")
    (row,) = phrases.scored(counted, totals, 100).collect()
    assert row.score == 1000 * 3 * 10**12 * 7 * 10**13 // (4 * 10**12 * 5 * 10**12)


def test_odd_texts_and_no_rows(spark):
    docs = odd_docs(spark).selectExpr("text", "n_tokens AS lang", "doc_id AS phrase")
    data = [(r.text, r.lang) for r in docs.collect()]
    assert len(data) > len(ODD_TEXTS) and mined(docs, least=2) == brute(data, least=2)
    assert mined(spark.createDataFrame([], "text string, lang string")) == [] and mined(docs) != mined(docs, least=10**6) == []
