"""Phrase collocations by sorted suffixes: all phrases of all lengths are counted with one shuffle and one stack.

A first pass counts words. A phrase is no more frequent than its words, so the second pass cuts pieces at words that are
too rare. The words that are left have numbers: as long as there are at most ``VOCABULARY`` of them, places in a sorted
list that is broadcast, of ``BITS`` bits each; beyond that hashes, with a bitmap of bounded size to tell words that are
certainly too rare. Every position then yields the suffix that starts there, cut off after ``longest`` words and packed
into few integers; a task adds up equal suffixes before they leave it.

Suffixes are dealt by language and first words into ranges of their order, whose ends a small sample of documents tells,
and sorted downwards. A first word, or a whole opening, that makes up much of a language thus spreads over many ranges,
and what is equal is one row a chunk of input. Going down a range, one stack holds the counts of the current suffix's
beginnings: where a word differs, the counts from there on are complete. Beginnings that reach over the ends of a range are
handed on as parts and added up. Counts are then joined to those of the parts of each phrase.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from siltstone.llm.batches import release
from siltstone.llm.marks import WORDS
from siltstone.sources.scratch import Scratch

#: Bytes that end a piece become this one, which is no part of a word; A-Z become small letters.
END = b"."
TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\rABCDEFGHIJKLMNOPQRSTUVWXYZ", END * 10 + b"abcdefghijklmnopqrstuvwxyz")
BOUNDARY = re.compile(rb"[ \t.]")
#: Bytes of a text that are split at once; suffixes that a task adds up at once; distinct words that it remembers.
SLICE, CHUNK, REMEMBERED = 1 << 20, 1 << 21, 200_000
#: Words that are numbered by a list, and the bits of such a number; else a number is a hash of ``HASHED`` bits.
VOCABULARY, BITS, HASHED = 1 << 19, 20, 63
#: Rows that leave Python at once; ranges a shuffle partition; words a range that the sample has; parts that a language's phrases are ranked in first.
ROWS, RANGES, SAMPLE, SALTS = 1 << 14, 4, 1000, 64
SPOTS = WORDS * 64


def slices(text: bytes) -> Iterator[list[bytes]]:
    """Words in their order with ``END`` between pieces, for a slice of the text at a time."""
    data, at = text.translate(TABLE), 0
    while at < len(data):
        cut = BOUNDARY.search(data, at + SLICE)
        upto = cut.start() if cut else len(data)
        yield data[at:upto].replace(END, b" " + END + b" ").split()
        at = upto


def hashed(lang: bytes, word: bytes, seed: int) -> int:
    """A number from 1 of ``HASHED`` bits."""
    return xxhash.xxh64_intdigest(lang + b" " + word, seed) % ((1 << HASHED) - 1) + 1


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """Rows (lang, word, code, n) for rows (lang, text), both binary; ``code`` is the word's hash."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[bytes, Counter] = defaultdict(Counter)

        def out() -> Iterator[pa.RecordBatch]:
            for lang, count in own.items():
                count.pop(END, None)
                words = list(count)
                for at in range(0, len(words), ROWS):
                    part = words[at : at + ROWS]
                    columns = [pa.array([lang] * len(part), pa.binary()), pa.array(part, pa.binary()), pa.array([hashed(lang, w, seed) for w in part], pa.int64()), pa.array([count[w] for w in part], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "code", "n"])
            own.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                for words in slices(text.as_py() or b""):
                    own[lang.as_py()].update(words)
                    if sum(map(len, own.values())) > REMEMBERED:
                        yield from out()
        yield from out()
        release()

    return docs.mapInArrow(counted, "lang binary, word binary, code long, n long").groupBy("lang", "word", "code").agg(F.sum("n").alias("n"))


class Listed(dict):
    """Numbers of the words of a language by a list; 0 for all others."""

    def __missing__(self, word: bytes) -> int:
        return 0


class Hashed(dict):
    """Hashes of the words of a language; 0 for those whose bit is not set, which are too rare."""

    def __init__(self, lang: bytes, bits: np.ndarray, seed: int):
        self.lang, self.bits, self.seed = lang, bits, seed
        self[END] = 0

    def __missing__(self, word: bytes) -> int:
        code = hashed(self.lang, word, self.seed)
        at = code % SPOTS
        found = code if self.bits[at >> 6] >> np.uint64(at & 63) & np.uint64(1) else 0
        if len(self) < REMEMBERED:
            self[word] = found
        return found


@dataclass
class Coding:
    """How words become numbers: by lists of the languages' words or by hashes and a bitmap, and how many bits they have."""

    bits: int
    lists: Broadcast | None = None
    bitmap: Broadcast | None = None
    seed: int = 0

    @property
    def per(self) -> int:
        """Words an integer of 63 bits holds."""
        return HASHED // self.bits

    def numbers(self, lang: bytes) -> dict:
        return self.lists.value.get(lang, Listed()) if self.lists else Hashed(lang, self.bitmap.value, self.seed)

    def packed(self, columns: list[np.ndarray]) -> list[np.ndarray]:
        """The columns in as few as hold them, in the same order."""
        keys = []
        for at in range(0, len(columns), self.per):
            key = np.zeros(len(columns[0]), np.int64)
            for i in range(self.per):
                key = key << self.bits | (columns[at + i] if at + i < len(columns) else 0) if self.per > 1 else columns[at]
            keys.append(key)
        return keys

    def unpacked(self, keys: list[np.ndarray], longest: int) -> list[np.ndarray]:
        shift = lambda d: self.bits * (self.per - 1 - d % self.per)
        return [keys[d // self.per] >> shift(d) & (1 << self.bits) - 1 for d in range(longest)]


def coding(words: DataFrame, scratch: Scratch, least: int, seed: int, vocabulary: int) -> tuple[Coding, DataFrame] | None:
    """How to number the words found ``least`` times or more, and rows (code, lang, word) of these; None if two words share a hash."""
    spark, often = words.sparkSession, words.filter(F.col("n") >= least)
    first = often.select("lang", "word").limit(vocabulary + 1).collect()
    if len(first) <= vocabulary:
        order = sorted((bytes(r["lang"]), bytes(r["word"])) for r in first)
        lists: dict[bytes, Listed] = {}
        for i, (lang, word) in enumerate(order, 1):
            lists.setdefault(lang, Listed())[word] = i
        named = pa.table({"code": pa.array(range(1, len(order) + 1), pa.int64()), "lang": pa.array([x for x, _ in order], pa.binary()), "word": pa.array([w for _, w in order], pa.binary())})
        return Coding(BITS, lists=spark.sparkContext.broadcast(lists)), scratch.save(spark.createDataFrame(named), "vocabulary")
    if not words.groupBy("code").count().filter("count > 1").isEmpty():
        return None
    place = F.expr(f"code % {SPOTS}L")
    marked = often.select(place.alias("spot")).groupBy(F.shiftright("spot", 6).cast("int").alias("at")).agg(F.expr("bit_or(shiftleft(1L, CAST(spot & 63 AS INT)))").alias("bits"))
    bits = np.zeros(WORDS, np.uint64)
    for r in marked.toLocalIterator():
        bits[r["at"]] = np.uint64(r["bits"] & (1 << 64) - 1)
    return Coding(HASHED, bitmap=spark.sparkContext.broadcast(bits), seed=seed), often.select("code", "lang", "word")


def distinct(columns: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct row of the columns, numbers of so many bits, first stands, in their order, and how often it does."""
    if bits > BITS:
        columns = [np.unique(c, return_inverse=True)[1] for c in columns]
        bits = len(columns[0]).bit_length()
    code, room = columns[0], bits
    for c in columns[1:]:
        if room + bits > 62:
            code = np.unique(code, return_inverse=True)[1]
            room = len(code).bit_length()
        code, room = (code << bits) | c, room + bits
    return np.unique(code, return_index=True, return_counts=True)[1:]


def places(keys: list[np.ndarray], bounds: list[tuple[int, ...]]) -> list[int]:
    """How many of the rows of ``keys``, which are in order, come before each bound."""
    found = []
    for bound in bounds:
        low, high = 0, len(keys[0])
        for key, x in zip(keys, bound):
            low, high = (low + int(np.searchsorted(key[low:high], x, side)) for side in ("left", "right"))
        found.append(low)
    return found


def suffixes(docs: DataFrame, code: Coding, longest: int, bounds: list[tuple[int, ...]] = [], chunk: int = CHUNK) -> DataFrame:
    """Rows (part, k0, k1, ..., n): packed suffixes of up to ``longest`` words, equal ones added up a chunk; ``part`` is the range between bounds."""
    keys = -(-longest // code.per)

    def out(x: np.ndarray, upto: int) -> Iterator[pa.RecordBatch]:
        """Adds up the suffixes that start before ``upto``."""
        columns = [x[:upto]]
        for k in range(1, longest):
            ahead = np.zeros(upto, x.dtype)
            ahead[: max(0, min(upto, len(x) - k))] = x[k : k + upto]
            columns.append(np.where(columns[-1] > 0, ahead, 0))
        some = columns[0] > 0
        columns = [c[some] for c in columns]
        first, n = distinct(columns, code.bits)
        packed = code.packed([c[first] for c in columns])
        part = np.repeat(np.arange(len(bounds) + 1, dtype=np.int32), np.diff([0, *places(packed, bounds), len(n)]))
        for at in range(0, len(n), ROWS):
            own = slice(at, at + ROWS)
            yield pa.RecordBatch.from_arrays([pa.array(part[own]), *(pa.array(k[own]) for k in packed), pa.array(n[own].astype(np.int32))], names=["part", *(f"k{i}" for i in range(keys)), "n"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, dict] = {}
        waiting: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                if (own := known.get(lang.as_py())) is None:
                    own = known[lang.as_py()] = code.numbers(lang.as_py())
                for part in slices(text.as_py() or b""):
                    waiting.append(np.fromiter(map(own.__getitem__, part), np.int64, len(part)))
                    size += len(part)
                    if size > 2 * chunk:  # within a long text, whose last words are yet to be followed by others
                        x = np.concatenate(waiting)
                        yield from out(x, size - longest + 1)
                        waiting, size = [x[size - longest + 1 :]], longest - 1
                waiting.append(np.zeros(1, np.int64))
                size += 1
                if size > chunk:
                    yield from out(np.concatenate(waiting), size)
                    waiting, size = [], 0
                    known.clear()
        if size:
            yield from out(np.concatenate(waiting), size)
        release()

    return docs.mapInArrow(cut, f"part int, {', '.join(f'k{i} long' for i in range(keys))}, n int")


def ends(docs: DataFrame, code: Coding, longest: int, words: int, ranges: int) -> list[tuple[int, ...]]:
    """Bounds that deal suffixes into about ``ranges`` even ranges, by a sample of at most 4 * ``SAMPLE`` suffixes a range; rows do not depend on them."""
    rate = min(1.0, SAMPLE * ranges / max(1, words))
    some = suffixes(docs.sample(rate, seed=1) if rate < 1 else docs, code, longest).drop("part", "n").limit(4 * SAMPLE * ranges)
    order = sorted(map(tuple, some.collect()))
    return sorted({order[i * len(order) // ranges] for i in range(1, ranges)} if order else [])


def beginnings(batches: Iterator[pa.RecordBatch], code: Coding, longest: int, least: int) -> Iterator[pa.RecordBatch]:
    """Counts f of all beginnings c0, c1, ... (0 after their ends) of suffixes in descending order: those of at least ``least``, and those at the ends of ranges, which may be parts."""
    held: list[int] = []
    held_part, counts, edge = -1, [0] * longest, [True] * longest
    names = [*(f"c{i}" for i in range(longest)), "f"]

    def rows(columns: list[np.ndarray], at: np.ndarray, d: int, f: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array(columns[i][at] if i <= d else np.zeros(len(at), np.int64)) for i in range(longest)), pa.array(f.astype(np.int64))], names=names)

    def last(d: int) -> pa.RecordBatch:
        return rows([np.array([x]) for x in held], np.arange(1), d, np.array([counts[d]]))

    for batch in batches:
        if not len(batch):
            continue
        columns = code.unpacked([batch.column(f"k{i}").to_numpy() for i in range(-(-longest // code.per))], longest)
        part, n = batch.column("part").to_numpy(), batch.column("n").to_numpy().astype(np.int64)
        starts = np.append(part[0] != held_part, part[1:] != part[:-1])
        changed = starts.copy()
        for d, own in enumerate(columns):
            changed[1:] |= own[1:] != own[:-1]
            changed[0] |= not held or own[0] != held[d]
            heads = np.flatnonzero(changed)
            if not changed[0]:
                heads = np.append(0, heads)
            sums, at_start = np.add.reduceat(n, heads), starts[heads]
            if not changed[0]:
                sums[0], at_start[0] = sums[0] + counts[d], edge[d]
            elif held and held[d] and (counts[d] >= least or edge[d] or starts[0]):
                yield last(d)
            ready = ((sums[:-1] >= least) | at_start[:-1] | starts[heads[1:]]) & (own[heads[:-1]] > 0)
            if ready.any():
                yield rows(columns, heads[:-1][ready], d, sums[:-1][ready])
            counts[d], edge[d] = int(sums[-1]), bool(at_start[-1])
        held, held_part = [int(c[-1]) for c in columns], part[-1]
    for d in range(longest if held else 0):
        if held[d]:
            yield last(d)


def count(docs: DataFrame, scratch: Scratch, longest: int, least: int, vocabulary: int = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words found ``least`` times, as rows (lang, phrase, size, f), and rows (lang, n); for rows (lang, text)."""
    spark, seed, found = docs.sparkSession, 0, None
    while found is None:
        words = scratch.save(word_counts(docs, seed), f"words-{seed}")
        found, seed = coding(words, scratch, least, seed, vocabulary), seed + 1
    code, named = found
    totals = scratch.save(words.groupBy("lang").agg(F.sum("n").alias("n")).select(F.col("lang").cast("string").alias("lang"), "n"), "totals")
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = ends(docs, code, longest, totals.agg(F.sum("n")).first()[0] or 0, ranges)
    dealt = suffixes(docs, code, longest, bounds).repartition("part")
    ordered = dealt.sortWithinPartitions(*(F.desc(c) for c in dealt.columns if c.startswith("k")))
    each = [f"c{i}" for i in range(longest)]
    parts = ordered.mapInArrow(lambda b: beginnings(b, code, longest, least), f"{', '.join(f'{c} long' for c in each)}, f long")
    whole = scratch.save(parts.groupBy(*each).agg(F.sum("f").alias("f")).filter(F.col("f") >= least), "coded")
    one = whole.select(*each, "f", F.posexplode(F.array(*each)).alias("at", "code")).filter("code > 0").join(named, "code")
    told = one.groupBy(*each, "f").agg(F.first("lang").cast("string").alias("lang"), F.array_sort(F.collect_list(F.struct("at", F.col("word").cast("string").alias("word")))).alias("w"))
    phrases = scratch.save(told.select("lang", F.array_join("w.word", " ").alias("phrase"), F.size("w").alias("size"), "f"), "phrases")
    scratch.drop(*(f"words-{i}" for i in range(seed)), "vocabulary", "coded")
    return phrases, totals


def scored(phrases: DataFrame, totals: DataFrame, percent: int) -> DataFrame:
    """Rows (lang, phrase, a, l, r, n, score) of the candidates that no longer one absorbs."""
    several = phrases.filter("size > 1").withColumn("words", F.split("phrase", " "))
    some = lambda low, n: F.array_join(F.slice("words", low, n), " ")
    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select("lang", "phrase", F.col("f").alias("a"), "k", some(F.lit(1), F.col("k")).alias("left"), some(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    left, right = (phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(f)) for side, f in (("left", "l"), ("right", "r")))
    met = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    wide = "CAST({} AS DECIMAL(18, 0))".format
    score = F.expr(f"(1000 * {wide('a')} * {wide('n')}) DIV ({wide('l')} * {wide('r')})").alias("score")
    lowest = met.select("lang", "phrase", "a", "k", "l", "r", "n", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("best"))
    # what lies within a longer candidate lies within one that is a word longer and no less frequent
    ends = F.array(some(F.lit(1), F.col("size") - 1), some(F.lit(2), F.col("size") - 1))
    longer = several.filter("size > 2").select("lang", F.explode(ends).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("within"))
    free = lowest.join(longer, ["lang", "phrase"], "left").filter(F.col("within").isNull() | (100 * F.col("within") < percent * F.col("best.a")))
    return free.select("lang", "phrase", *(F.col(f"best.{c}").alias(c) for c in ("a", "l", "r", "n", "score")))


def mine(docs: DataFrame, longest: int = 5, least: int = 100, percent: int = 100, top: int = 2000, lang_col: str = "lang", text_col: str = "text", vocabulary: int = VOCABULARY) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the ``top`` collocations of each language.

    Texts, A-Z lower-cased, are split at ``.,;:!?`` and line ends into pieces, these at blanks and tabs into words. A
    candidate is a run of 2 to ``longest`` words of a piece that is found at least ``least`` times (``a``) in its language;
    null is the language ``und``. Of all ways to cut it in two the one with the lowest floor(1000 * a * n / (l * r)) counts,
    the first of equals; l and r are the counts of the parts, n that of all words. Candidates within a longer one that is
    found at least ``percent`` times in a hundred of theirs are dropped. Ranks go by score and a, both descending, and
    phrase. Products are exact up to 38 digits. Null and empty texts have no words; equal rows count each; a language
    without candidates and an empty table give no rows. Columns other than these two are not read. Up to ``vocabulary``
    (at most 2^19) frequent words are numbered by a list, more by hashes; the rows are the same.
    """
    scratch = Scratch(docs.sparkSession)
    binary = lambda c, none: F.coalesce(F.col(c).cast("string"), F.lit(none)).cast("binary")
    phrases, totals = count(docs.select(binary(lang_col, "und").alias("lang"), binary(text_col, "").alias("text")), scratch, longest, least, vocabulary)
    found = scored(phrases, totals, percent).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    best = found.withColumn("rank", rank("lang", "salt")).filter(F.col("rank") <= top).withColumn("rank", rank("lang"))
    return best.filter(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), counts AS MATERIALIZED (
  SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase, count(*) AS f FROM starts, range(1, 6) s(size) WHERE i + size - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1
), cuts AS (
  SELECT lang, size, phrase, a, k, array_to_string(w[1 : k], ' ') AS left_, array_to_string(w[k + 1 :], ' ') AS right_ FROM candidates, range(1, 5) t(k) WHERE k < size
), scores AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n, CAST(1000 * CAST(a AS HUGEINT) * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = left_ JOIN counts y ON y.lang = c.lang AND y.phrase = right_ JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_ AS (
  SELECT lang, array_to_string(w[i : j], ' ') AS phrase, max(a) AS within FROM candidates, range(1, 6) p(i), range(1, 6) q(j) WHERE i < j AND j <= size AND j - i + 1 < size GROUP BY ALL
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM lowest LEFT JOIN inner_ USING (lang, phrase) WHERE within IS NULL OR 100 * within < 100 * a
) WHERE rank <= 2000
"""
