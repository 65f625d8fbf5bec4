"""Known pieces by the registered query."""

import types
from datetime import date

from siltstone.plans.entities import derived_pieces


def test_all_parts_are_known_pieces_of_their_first_customer(spark):
    orders = spark.createDataFrame([(1, 10, date(2024, 1, 1)), (2, 20, date(2024, 1, 2)), (3, 10, date(2024, 1, 3))], "o_orderkey long, o_custkey long, o_orderdate date")
    lines = [(1, 1, 5001), (1, 1, 5001), (2, 1, 5001), (3, 1, 5005), (3, 2, 77 * 90), (2, 2, 5005), (2, 3, 5005)]
    lineitem = spark.createDataFrame([(*x, 1, 1.0, 1.0) for x in lines], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double")
    part = spark.createDataFrame([(5001,), (5005,), (77 * 90,), (9999,)], "p_partkey long")
    got = derived_pieces(types.SimpleNamespace(orders=orders, lineitem=lineitem, part=part)).collect()
    assert sorted((r.account, r.position, r.piece_id, r.via) for r in got) == [
        ("10", 1, "p5001", "name"), ("10", 2, "p5001", "name"), ("10", 3, "new-10-3", "new"), ("10", 4, "p6930", "job_number"),
        ("20", 1, "new-20-1", "new"), ("20", 2, "p5005", "job_number"), ("20", 3, "p5005", "job_number"),
    ]
