"""The line of an order that staging keeps, found before the joins."""

from __future__ import annotations

from datetime import datetime

import pytest

from jobsignals.lens.postings import first_lines


@pytest.mark.parametrize("known, kept", [([7, 8, 9], {(1, 9), (2, 7)}), ([7, 8], {(1, 8), (2, 7)})])
def test_a_line_without_its_part_is_no_sighting(spark, known, kept):
    day = datetime(1995, 1, 1)
    # 'Brisbane' sorts first, but the part 9 may be missing.
    rows = [(1, 7, 1, 1, "N", day), (1, 8, 1, 2, "A", day), (1, 9, 1, 3, "R", day), (2, 7, 1, 1, "A", day), (2, None, 1, 2, "R", day), (None, 7, 1, 1, "A", day)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_shipdate timestamp")
    parts = spark.createDataFrame([(k,) for k in known], "p_partkey long")
    assert {(r.l_orderkey, r.l_partkey) for r in first_lines(lines, parts).collect()} == kept
