"""From files to text: a dispatch on metadata in Spark's expressions, then extractors on the rows that are left."""

from __future__ import annotations

import html
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Media types that are told apart.
MIME = {
    "folder": "application/vnd.google-apps.folder",
    "shortcut": "application/vnd.google-apps.shortcut",
    "doc": "application/vnd.google-apps.document",
    "slides": "application/vnd.google-apps.presentation",
    "sheet": "application/vnd.google-apps.spreadsheet",
    "pdf": "application/pdf",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
}
#: The largest file that is downloaded, the longest text of a native document, and the white space that is trimmed.
MAX_BYTES, NATIVE_CHARS = 314_572_800, 2_000_000
SPACE = "\t\n\x0b\x0c\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
NATIVE, DOWNLOADED = ("doc", "slides", "sheet"), ("pdf", "docx", "pptx")


def skip_reason(max_bytes: int) -> Column:
    """Why a file (mime_type, size, is_folder, shortcut struct(id, mime_type)) is not read, from metadata alone; null if it may be.

    The rules in their order: folders; shortcuts without a target, to a folder or to a shortcut; a shortcut counts as its
    target of unknown size; native documents pass; downloads and texts pass up to ``max_bytes``, and not without a size
    behind a shortcut; nothing else passes.
    """
    is_shortcut, target = F.col("mime_type") == MIME["shortcut"], F.col("shortcut.mime_type")
    mime = F.when(is_shortcut, target).otherwise(F.col("mime_type"))
    size = F.when(~is_shortcut, F.col("size"))
    sized = mime.isin(*(MIME[m] for m in DOWNLOADED)) | F.startswith(mime, F.lit("text/"))
    return (
        F.when(F.col("is_folder"), "folder")
        .when(is_shortcut & (target.isNull() | target.isin(MIME["folder"], MIME["shortcut"])), "unsupported_mime")
        .when(mime.isin(*(MIME[m] for m in NATIVE)), None)
        .when(sized & (size > max_bytes), "too_large")
        .when(sized & is_shortcut, "shortcut_unverified_size")
        .when(sized, None)
        .otherwise("unsupported_mime")
    )


class _Text(HTMLParser):
    def __init__(self):
        super().__init__()
        self.parts, self.silent = [], 0

    def handle_starttag(self, tag, attrs):
        self.silent += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.silent -= tag in ("script", "style") and self.silent > 0
        if tag in ("p", "div", "li", "tr", "br", "h1", "h2", "h3", "title"):
            self.parts.append("\n")

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)


def html_text(raw: str) -> str:
    parser = _Text()
    parser.feed(raw)
    lines = (" ".join(x.split()) for x in "".join(parser.parts).split("\n"))
    return "\n".join(x for x in lines if x)


def office_text(content: bytes, pattern: str, paragraph: str) -> str:
    """The runs of text in the parts of an Office file whose names match, a line per paragraph."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = sorted((n for n in z.namelist() if re.fullmatch(pattern, n)), key=lambda n: [int(x) for x in re.findall(r"\d+", n)])
        lines = [re.sub(r"<[^>]+>", "", "".join(re.findall(r"<(?:w|a):t(?: [^>]*)?>([^<]*)</(?:w|a):t>", p))) for n in names for p in z.read(n).decode("utf-8", "replace").split(f"</{paragraph}>")]
    return "\n".join(html.unescape(x) for x in lines if x)


def read_one(mime: str, content: bytes, readers: dict[str, Callable[[bytes], str]] = {}) -> tuple[str, str | None, str | None]:
    """(kind, reason, text) of one file's bytes; ``readers`` has further extractors by media type."""
    try:
        if mime in readers:
            return "ok", None, readers[mime](content)
        if mime == MIME["docx"]:
            return "ok", None, office_text(content, r"word/document\.xml", "w:p")
        if mime == MIME["pptx"]:
            return "ok", None, office_text(content, r"ppt/slides/slide\d+\.xml", "a:p")
        if mime == "text/html":
            return "ok", None, html_text(content.decode("utf-8", "replace"))
        if mime.startswith("text/"):
            return "ok", None, content.decode("utf-8", "replace")
    except (zipfile.BadZipFile, ValueError, KeyError):
        return "skip", "parse_error", None
    return "skip", "no_extractor", None


def outcome(mime: str, content: bytes, native_chars: int, readers: dict[str, Callable[[bytes], str]]) -> tuple[str, str | None, str | None]:
    """As ``read_one``, trimmed; a blank text is skipped as ``empty``, one of a native document beyond ``native_chars`` as ``too_many_chars``."""
    kind, reason, text = read_one(mime, content, readers)
    if kind != "ok":
        return kind, reason, None
    if mime in map(MIME.get, NATIVE) and len(text) > native_chars:
        return "skip", "too_many_chars", None
    text = text.strip(SPACE)
    return ("ok", None, text) if text else ("skip", "empty", None)


#: What a batch for Python holds at most: files, and about so many bytes.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def extract(files: DataFrame, max_bytes: int, native_chars: int = NATIVE_CHARS, readers: dict[str, Callable[[bytes], str]] | None = None) -> DataFrame:
    """``files`` (id, mime_type, size, is_folder, shortcut, content) as (id, kind, reason, text).

    The dispatch runs before the bytes are handed to Python, so a skipped file costs nothing there. Downloads and texts are
    limited by their bytes alone; native documents have no size to check, so the length of their text is limited instead.
    PDF and native documents need an extractor among ``readers`` (by media type). A Python worker holds a batch of at most
    ``BATCH_ROWS`` files and about ``BATCH_BYTES``, for which the session's settings are changed, or one larger file.
    """
    files.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    files.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    reason = files.withColumn("reason", skip_reason(max_bytes))
    skipped = reason.filter("reason IS NOT NULL").select("id", F.lit("skip").alias("kind"), "reason", F.lit(None).cast("string").alias("text"))
    mime = F.coalesce(F.col("shortcut.mime_type"), F.col("mime_type"))
    further = readers or {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [outcome(m.as_py(), c.as_py() or b"", native_chars, further) for m, c in zip(batch.column("mime"), batch.column("content"))]
            kinds, reasons, texts = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(x, pa.string()) for x in (kinds, reasons, texts))], names=["id", "kind", "reason", "text"])
        pa.default_memory_pool().release_unused()  # the worker lives on for other tasks

    read = reason.filter("reason IS NULL").select(F.col("id").cast("string").alias("id"), mime.alias("mime"), "content").mapInArrow(run, "id string, kind string, reason string, text string")
    return skipped.unionByName(read)


def paragraphs_text(blocks: Column) -> Column:
    """Blocks (kind, text, rows array<array<string>>) of a document as text: tables as lines of tab-separated cells."""
    table = lambda b: F.array_join(F.transform(b["rows"], lambda r: F.array_join(r, "\t")), "\n")
    return F.array_join(F.filter(F.transform(blocks, lambda b: F.when(b["kind"] == "table", table(b)).otherwise(b["text"])), lambda x: F.length(F.trim(x)) > 0), "\n")


def slides_text(slides: Column) -> Column:
    """Slides (hidden, body, notes) as text: hidden ones drop out, notes stand in a section of their own."""
    shown = F.filter(slides, lambda s: ~F.coalesce(s["hidden"], F.lit(False)))
    one = lambda s: F.concat(F.coalesce(s["body"], F.lit("")), F.when(F.length(F.trim(s["notes"])) > 0, F.concat(F.lit("\n[Notes]\n"), s["notes"])).otherwise(""))
    return F.array_join(F.transform(shown, one), "\n\n")


def sheets_text(sheets: Column) -> Column:
    """Sheets (title, rows array<array<string>>) as titled blocks of tab-separated lines."""
    return F.array_join(F.transform(sheets, lambda s: F.concat(F.lit("# "), s["title"], F.lit("\n"), F.array_join(F.transform(s["rows"], lambda r: F.array_join(r, "\t")), "\n"))), "\n\n")


def load_fixtures(gold: DataFrame, texts: DataFrame) -> DataFrame:
    """Gold rows (id, ...) with their text (id, text); raises if one of a pair is missing."""
    both = gold.withColumn("_g", F.lit(True)).join(texts.withColumn("_t", F.lit(True)), "id", "full_outer")
    alone = both.filter("_g IS NULL OR _t IS NULL").select("id").limit(5).collect()
    if alone:
        raise ValueError(f"unpaired fixtures: {sorted(r['id'] for r in alone)}")
    return both.drop("_g", "_t")
