"""Every registered query against its SQL on the smallest data."""

from __future__ import annotations

import pytest

from conftest import plan_text
from jobsignals.lens import all_oracles, all_queries
from oracle import compare, connect

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("key", sorted(all_queries()))
def test_query(spark, con, key):
    df = all_queries()[key](spark, SMALL)
    assert not {kind for _, kind in df.dtypes} & {"date", "timestamp", "timestamp_ntz"}
    if key in all_oracles():
        assert compare(df, con, all_oracles()[key]) == ""
    else:
        assert df.count() > 0


def test_entry_module():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", ["postings_supply_demand", "postings_experience_barrier", "postings_skills_demand", "supply_demand"])
def test_marts_stay_in_the_jvm_and_never_cross_join(spark, key):
    plan = plan_text(all_queries()[key](spark, SMALL))
    for operator in ("MapInPandas", "EvalPython", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in plan


def test_marts_read_only_the_columns_they_use(spark):
    plan = plan_text(all_queries()["supply_demand"](spark, SMALL))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "l_partkey" in line)
    assert "l_shipdate" not in scan and "l_tax" not in scan
    assert "PushedFilters: [IsNotNull(l_partkey)]" in scan
