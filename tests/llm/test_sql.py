"""Queries of the llm subpackage that SQL can express, against DuckDB on the given tables."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLE = {n: s for n, s in registry.oracle_sql().items() if n.startswith("op") and n[2].isdigit()}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches(spark, name):
    assert differences(registry.queries()[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) == []


def test_every_operator_has_a_query():
    names = [n for n in registry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in registry.queries()


@pytest.mark.parametrize("name", ["op4_url_filter", "op6_chat_format"])
def test_native_operators_stay_in_the_jvm(spark, name):
    plan = registry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
