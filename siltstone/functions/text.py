"""Functions on names and texts."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

#: Fixed value: a job number in brackets, 2 to 10 capitals, then 4 to 14 digits.
JOB_NUMBER = r"\[([A-Z]{2,10}\d{4,14})\]"
#: How a note on a new entity is marked, and how a line tells when it expires.
CANDIDATE = r'^\[new campaign candidate "[^"]*"\] ?'
EXPIRES = r"\[expires:\s*(\d{4}-\d{2}-\d{2})\s*\]"


def collapse(name: Column) -> Column:
    """Trimmed, lower-cased, each run of white space one blank; null stays null."""
    return F.lower(F.regexp_replace(F.regexp_replace(name, r"^\s+|\s+$", ""), r"\s+", " "))


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; 1 for two empty strings."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longest)


def plain(text: Column) -> Column:
    """Lower-cased; anything but letters and digits becomes a blank. Accents stay, as in a trigram index."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


#: No mark comes before this character.
MAYBE_MARK = re.compile("[\u0300-\U0010ffff]")


def bare(text: str) -> str:
    """The text in compatibility decomposition, without marks."""
    return MAYBE_MARK.sub(lambda m: "" if unicodedata.category(m[0])[0] == "M" else m[0], unicodedata.normalize("NFKD", text))


@F.pandas_udf(StringType())
def _bare(texts: pd.Series) -> pd.Series:
    return texts.map(bare, na_action="ignore")


@F.pandas_udf(ArrayType(StringType()))
def _bare_each(lists: pd.Series) -> pd.Series:
    return lists.map(lambda texts: [None if t is None else bare(t) for t in texts], na_action="ignore")


def unaccented(text: Column) -> Column:
    """``plain`` without accents and with compatibility forms (ligatures, full-width letters) resolved.

    Spark has no Unicode normalisation, so texts beyond ASCII go through Python; of all others only a null does.
    """
    return plain(F.coalesce(_bare(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text))


def unaccented_each(texts: Column) -> Column:
    """``unaccented`` for the elements of an array."""
    return F.transform(_bare_each(texts), plain)


def ordered_trigrams(normalised: Column) -> Column:
    """The trigrams of a normalised text in their order: each word with two blanks before and one behind; none for no words."""
    words = F.filter(F.split(normalised, " "), lambda w: w != "")
    one = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)))
    return F.flatten(F.transform(words, one))


def trigrams(normalised: Column) -> Column:
    """The distinct trigrams of a normalised text."""
    return F.array_distinct(ordered_trigrams(normalised))


def shared_and_all(a: Column, b: Column) -> tuple[Column, Column]:
    """Counts of common and of all distinct elements of two sets."""
    both = F.size(F.array_intersect(a, b))
    return both, F.size(a) + F.size(b) - both


def trigram_similarity(a: Column, b: Column) -> Column:
    """Common over all trigrams of two trigram sets; 0 if either is empty."""
    both, every = shared_and_all(a, b)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / every)


def best_extent(own: set[str], text: list[str]) -> float:
    """The best share of common over all distinct trigrams of ``own`` and any run of ``text``; the best run starts and ends with a common one."""
    hits, best = [i for i, t in enumerate(text) if t in own], 0.0
    for i in hits:
        seen, common = set(), 0
        for t in text[i : hits[-1] + 1]:
            if t not in seen:
                seen.add(t)
                common += t in own
            best = max(best, common / (len(own) + len(seen) - common))
            if len(seen) * best >= len(own):  # no longer run can be better
                break
    return best


def ordered(normalised: str) -> list[str]:
    """``ordered_trigrams`` of one text."""
    return [f"  {w} "[i : i + 3] for w in normalised.split(" ") if w for i in range(len(w) + 1)]


@F.pandas_udf(DoubleType())
def _best_extents(own: pd.Series, text: pd.Series) -> pd.Series:
    return pd.Series([None if a is None or b is None else best_extent(set(ordered(a)), ordered(b)) for a, b in zip(own, text)], dtype=object)


def word_similarity(a: Column, b: Column) -> Column:
    """The greatest trigram similarity of ``a`` to any extent of the ordered trigrams of ``b`` (both normalised); null if either is.

    An extent may begin and end within words; trigrams that it repeats count once. Null and empty texts have none: 0 for empty.
    """
    return _best_extents(a, b)


def job_number(name: Column) -> Column:
    """The first bracketed job number, or null."""
    return F.nullif(F.regexp_extract(name, JOB_NUMBER, 1), F.lit(""))


def path_year(path: Column) -> Column:
    """The deepest segment of a path (joined by `` / ``) that is exactly four digits from 1900 to 2099, as an int; else null."""
    years = F.filter(F.transform(F.split(path, " / "), lambda s: F.trim(s)), lambda s: s.rlike(r"^(19|20)\d{2}$"))
    return F.try_element_at(years, F.lit(-1)).cast("int")


def render(template: Column, values: dict[str, Column]) -> Column:
    """Fills in {{name}}; names without a value, or with a null one, become nothing."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{{" + name + "}}"), F.coalesce(value.cast("string"), F.lit("")))
    return F.regexp_replace(template, r"\{\{\s*\w+\s*\}\}", "")


def clip(text: Column, most: int) -> Column:
    """The first ``most`` characters and a remark on how many were left out."""
    left_out = F.length(text) - most
    return F.when(left_out > 0, F.concat(F.left(text, F.lit(most)), F.lit("\n[... "), left_out.cast("string"), F.lit(" more characters]"))).otherwise(text)


def tail(text: Column, lines: int = 40, chars: int = 2000) -> Column:
    """The last lines of a log, and of those the last characters."""
    own = F.split(text, "\n")
    kept = F.array_join(F.slice(own, F.greatest(F.lit(1), F.size(own) - lines + 1), F.lit(lines)), "\n")
    return F.right(kept, F.lit(chars))


def section(document: Column, heading: str) -> Column:
    """The body under ``## heading`` up to the next heading of that level, trimmed; null if there is none or it is empty."""
    found = F.regexp_extract(document, rf"(?ms)^##[ \t]+\Q{heading}\E[ \t]*$\n?(.*?)(?=^##[ \t]|\z)", 1)
    return F.when(document.rlike(rf"(?m)^##[ \t]+\Q{heading}\E[ \t]*$"), F.nullif(F.regexp_replace(found, r"^\s+|\s+$", ""), F.lit("")))


def bullets(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n")


def escape_html(text: Column) -> Column:
    for plain_, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(plain_), F.lit(escaped))
    return text


def candidate_marker(name: Column) -> Column:
    return F.concat(F.lit('[new campaign candidate "'), name, F.lit('"]'))


def is_candidate(note: Column) -> Column:
    """Whether a note carries the marker of any candidate."""
    return F.startswith(note, F.lit('[new campaign candidate "'))


def strip_candidate(note: Column, name: Column) -> Column:
    """The note without the marker of this candidate; null if it is not marked for it."""
    prefix = F.concat(candidate_marker(name), F.lit(" "))
    return F.when(F.startswith(note, prefix), F.substr(note, F.length(prefix) + 1))


def unexpired(body: Column, as_of: Column) -> Column:
    """The lines of a body that are not blank and do not expire before ``as_of`` (YYYY-MM-DD); null if none is left."""
    date = lambda line: F.regexp_extract(line, EXPIRES, 1)
    kept = F.filter(F.split(body, "\n"), lambda line: (F.regexp_replace(line, r"^\s+|\s+$", "") != "") & ((date(line) == "") | (date(line) >= as_of)))
    return F.nullif(F.array_join(kept, "\n"), F.lit(""))


#: The parts of a synthesis, each begun by a line === NAME ===.
PARTS = ("GENERAL_CONTEXT", "GENERAL_TRANSIENT", "SENSITIVE_CONTEXT", "SENSITIVE_TRANSIENT")


def synthesis_parts(reply: Column) -> Column:
    """struct of the four parts of a synthesis; a reply without any marker is sensitive context as a whole.

    A marker has to be all of its line. Lines before the first marker drop out. A fence around the reply is taken off, and
    from each part its own fence, a heading ``Context`` at its start, and a section ``At a glance`` there.
    """
    strip = lambda c: F.regexp_replace(c, r"\A\s+|\s+\z", "")
    unfenced = lambda c: strip(F.regexp_replace(strip(c), r"(?s)\A```(?:markdown)?\s*\n(.+?)\n```\z", "$1"))
    headless = lambda c: strip(F.regexp_replace(c, r"\A##\s+Context\s*\n", ""))
    tidy = lambda c: headless(strip(F.regexp_replace(headless(unfenced(c)), r"(?s)\A##\s+At a glance.*?(?=\n##\s|\z)", "")))
    bare = unfenced(reply)
    marker = rf"(?m)^[ \t]*===[ \t]*({'|'.join(PARTS)})[ \t]*===[ \t]*\r?$"
    # each marker becomes one odd character and its name, so that a split gives the parts in order
    pieces = F.slice(F.split(F.regexp_replace(bare, marker, "\u0001$1\u0002"), "\u0001"), F.lit(2), F.lit(1 << 20))
    body = lambda name: tidy(F.array_join(F.transform(F.filter(pieces, lambda p: F.startswith(p, F.lit(name + "\u0002"))), lambda p: F.substr(p, F.lit(len(name) + 2))), "\n"))
    found = F.struct(*(body(name).alias(name.lower()) for name in PARTS))
    whole = F.struct(*((tidy(bare) if name == "SENSITIVE_CONTEXT" else F.lit("")).alias(name.lower()) for name in PARTS))
    return F.when(bare.rlike(marker), found).otherwise(whole)


def labelled_lines(pairs: list[tuple[str, Column]]) -> Column:
    """``label: value`` lines in the order given; null and empty values drop out."""
    return F.concat_ws("\n", *(F.when(value.cast("string") != "", F.concat(F.lit(label + ": "), value.cast("string"))) for label, value in pairs))


#: Prefixes of call tags and the kind of call each stands for.
CALL_TYPES = {
    "drive.file_extraction.": "interpret",
    "drive.distillation.": "distill",
    "drive.structure_resolution.": "classify",
    "drive.idea_extraction.": "idea_extract",
    "drive.idea_match_merge.": "idea_merge",
    "backfill.status-synthesis": "synthesis",
    "campaign_merge.": "campaign_merge",
    "campaign_cluster_detection.": "cluster",
    "drive.asset_folder.": "asset_folder",
    "drive.piece_derive.": "piece_derive",
    "drive.field_heal.": "heal",
    "drive.new_entity_extraction.": "discover",
}


def call_type(tag: Column) -> Column:
    """The kind of call of a tag; null for one outside the table."""
    return F.coalesce(*(F.when(F.startswith(tag, F.lit(prefix)), kind) for prefix, kind in CALL_TYPES.items()))


def union_ignoring_case(a: Column, b: Column) -> Column:
    """Trimmed elements of two arrays in order, the first of those that differ in case only; blank ones go."""
    every = F.filter(F.transform(F.concat(a, b), lambda x: F.trim(x)), lambda x: x != "")
    keyed = F.array_sort(F.transform(every, lambda x, i: F.struct(F.lower(x).alias("key"), i.alias("at"), x.alias("x"))))
    firsts = lambda s: F.filter(s, lambda e, i: (i == 0) | (e["key"] != F.get(s, i - 1)["key"]))
    kept = F.flatten(F.transform(F.array(keyed), firsts))  # the outer array binds the sorted one, so it is made once
    return F.transform(F.array_sort(F.transform(kept, lambda e: F.struct(e["at"].alias("at"), e["x"].alias("x")))), lambda e: e["x"])


def same_elements(a: Column, b: Column) -> Column:
    """Whether two arrays hold the same elements equally often, without regard to case and outer blanks."""
    tidy = lambda x: F.array_sort(F.transform(x, lambda e: F.lower(F.trim(e))))
    return tidy(a).eqNullSafe(tidy(b))


def money(amount: Column, sign: str = "$") -> Column:
    return F.when(amount.isNotNull(), F.concat(F.lit(sign), F.format_number(amount, 0)))


def json_body(reply: Column) -> Column:
    """The JSON in a reply: what a code fence holds, or else all from the first bracket to the last."""
    fenced = F.regexp_extract(reply, r"(?s)```(?:json)?\s*(.*?)```", 1)
    bare = F.regexp_extract(reply, r"(?s)([\[{].*[\]}])", 1)
    return F.coalesce(F.nullif(F.regexp_replace(fenced, r"^\s+|\s+$", ""), F.lit("")), F.nullif(bare, F.lit("")))


def content_hash(kind: str, *parts: Column) -> Column:
    """SHA-256 of a JSON tuple, with a prefix that names what was hashed; nulls count."""
    tuple_ = F.to_json(F.array(*(F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts)))
    return F.concat(F.lit(kind + ":"), F.sha2(tuple_, 256))
