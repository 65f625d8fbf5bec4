"""Line dedup: the perfect hash, the drops against brute force, odd input."""

import re

import numpy as np
import pytest

from siltstone.llm import line_dedup
from tests.llm.cases import ODD_TEXTS, odd_docs, rows


def brute(docs, least=10):
    """(id, n_lines, n_dropped, kept) of (id, text) pairs; None is one id that comes last."""
    keyed = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    order = lambda i: (i is None, i or 0)
    holders = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            holders.setdefault(keyed(line), set()).add(i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(keyed(x)) < least or len(holders[keyed(x)]) < 2 or i == min(holders[keyed(x)], key=order)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 2, 7, 64, 5000])
def test_slots_are_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    a, b = rng.integers(0, 1 << 63, n), rng.integers(-(1 << 62), 1 << 62, n)
    a[: n // 2] = a[0]  # equal first numbers are told apart by the second
    slots = line_dedup.Slots.build(a, b)
    assert sorted(slots.find(a, b)) == list(range(n))
    again = line_dedup.Slots(slots.sizes, slots.bits)
    assert (again.find(a, b) == slots.find(a, b)).all()
    others = again.find(a, b + 1)
    assert ((others >= -1) & (others < n)).all()


def test_no_hashes():
    assert len(line_dedup.Slots.build(np.zeros(0, np.int64), np.zeros(0, np.int64)).find(np.arange(3), np.arange(3))) == 3


def test_length_counts_code_points():
    assert line_dedup.long_enough("日本語日本語日本語日".encode(), 10) and not line_dedup.long_enough("日本語日本語日本語".encode(), 10)
    assert line_dedup.long_enough(b"0123456789", 10) and not line_dedup.long_enough(b"012345678", 10)
    assert line_dedup.long_enough("😀".encode() * 10, 10) and not line_dedup.long_enough("😀".encode() * 9, 10)


def test_drops_equal_brute_force(spark):
    common, rare = "This line is common", "  a line\tthat three hold \r"
    data = [(i, "\n".join([f"own line number {i}", common.upper() if i % 2 else common, "short", common, "\x00 nul \x00 line"][: 1 + i % 5])) for i in range(400)]
    data += [(1000 + i, f"{rare}\n{rare.strip()}\n\n{'é' * 9}\n{'é' * 10}") for i in range(3)]
    data += [(-5, common), (-5, rare), (7, common), (7, None), (None, rare), (None, "only without id"), (None, "only without id"), (2000, "only here twice\nonly here twice")]
    data += [(3000, "一" * 10), (3001, " " + "一" * 10), (3002, "x" * 70_000), (3003, "X" * 70_000), (3004, "\n" * 1000)]
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in data], "doc_id long, text string, kept string, n_lines int, `a.b` string")
    got = line_dedup.dedup_lines(docs.repartition(5))
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    assert rows(got, *got.columns) == brute(data)


def test_a_line_of_most_documents_and_ids_of_text(spark):
    data = [(f"d{i:05}", f"a line of all documents\nanother {i % 900} of some documents\n{i}") for i in range(4000)]
    got = line_dedup.dedup_lines(spark.createDataFrame(data, "doc_id string, text string"))
    assert rows(got, *got.columns) == brute(data)


def test_odd_texts(spark):
    docs = odd_docs(spark)
    data = [(r.doc_id, r.text) for r in docs.collect()]
    got = line_dedup.dedup_lines(docs, least=1)
    assert rows(got, *got.columns) == brute(data, least=1) and len(data) > len(ODD_TEXTS)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.dedup_lines(none).count() == 0
