"""Every catalog query against its check SQL, and what its plan must not hold."""

import pytest

from gridloom.catalog import CHECKS, QUERIES
from tests.compare import difference, duck

FOLDER = "/root/testdata/sf0.001"
WRITING = [n for n in QUERIES if n.startswith(("write_", "stream_", "append_", "upsert_", "insert_"))]
# Too few rows at this scale; checked at the next one.
SPARSE = {"solar_ref", "splitting_input", "align_inner", "solar_input", "solar_input_radius", "rejected_jobs"}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_equals_check(spark, con, name):
    note = difference(QUERIES[name](spark, FOLDER), con, CHECKS[name])
    if name in SPARSE and note == "equal, but both are empty":
        return
    assert note is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in CHECKS])
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITING])
def test_plan_has_no_all_pairs_join(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
