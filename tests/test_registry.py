"""Every registered query against its SQL counterpart, over the smallest tables."""

import re
from pathlib import Path

import pytest
from compare import connect, duck_result, spark_result
from conftest import ROOT, SF_SMALL

import __spark_entry__ as entry
from workload.oracle import ORACLE
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SF_SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    columns, rows = spark_result(QUERIES[name](spark, SF_SMALL))
    expected_columns, expected = duck_result(duck, ORACLE[name])
    assert columns == expected_columns
    assert rows == expected


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


def test_driver_sees_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["zone_matches", "silver_positions", "state_transitions", "vessel_sessions", "asof_state"])
def test_plans_have_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|NestedLoopJoin|Python|ArrowEval|InPandas", plan)
    assert "ReadSchema" in plan


def test_library_has_no_local_checkpoint_or_row_udf():
    paths = Path(ROOT, "harborflow").rglob("*.py")
    for path in (p for p in paths if "llm" not in p.parts):
        text = path.read_text()
        assert not re.search(r"localCheckpoint|crossJoin|\.udf\(|\.rdd\b|toPandas", text), path
