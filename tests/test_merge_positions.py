"""Positions of the merge scores come from each row alone."""

import types

from siltstone.plans.entities import merge_scoring


def test_no_row_numbers_over_an_account(spark):
    row = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string"
    lines = [(1, 1, 1, 1, 1.0, 1.0, "A"), (1, 2, 1, 1, 1.0, 1.0, "A"), (2, 1, 1, 1, 1.0, 1.0, "A"), (2, 2, 2, 1, 1.0, 1.0, "A")]
    got = merge_scoring(types.SimpleNamespace(lineitem=spark.createDataFrame(lines, row)))
    assert "row_number" not in got._jdf.queryExecution().toString()
    r = got.first()
    assert (r.decisions, r.correct, r.false_merges, r.missed) == (4, 1, 1, 1)
