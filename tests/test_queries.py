"""Every registered query against DuckDB on the smallest tables."""

import sys
from pathlib import Path

import pytest
from conftest import plan_of

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry_points  # noqa: E402
import compare  # noqa: E402
from millrace.session import drop_workspaces  # noqa: E402
from millrace.workloads import ORACLES, QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.views(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    frame = QUERIES[name](spark, SF_DIR)
    plan = plan_of(frame)
    for slow in ["EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"]:
        assert slow not in plan
    assert compare.differences(frame, connection.sql(ORACLES[name])) == []
    drop_workspaces()


def test_entry_points_agree(spark):
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLES.items() <= entry_points.oracle_sql().items()
    assert entry_points.entry(spark).count() > 0
