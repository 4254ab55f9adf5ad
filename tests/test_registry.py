"""Every registered query against DuckDB, on the given tables."""

import os
import re

import pytest
from compare import connect, differences
from frames import plan_of
from pyspark.sql import functions as F

import __spark_entry__ as registry
from estrato.plans import starschema

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLE = registry.oracle_sql()
# Those of the llm subpackage have their own tests.
QUERIES = {n: q for n, q in registry.queries().items() if n != "pipeline" and not re.match(r"op\d", n)}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")

WRITES = {
    "year_on_year", "year_rank", "gold_evolucao_alfabetizacao_uf", "quality_checks", "best_evolving_states",
    "regional_inequality", "stream_ingest_roundtrip", "stream_mirror_roundtrip", "batch_and_stream_silver",
    "bronze_batch_ingest", "bronze_partitioned_roundtrip", "rebuild_all_layers", "shared_bronze_silver",
    "reject_roundtrip", "catalog_roundtrip", "stored_gold_metas", "stored_gold_evolucao", "stored_quality_results",
    "dry_run", "stream_redelivery", "catalog_by_date", "incremental_silver", "incremental_report", "step_statistics",
    "measured_quality_results", "stream_newest",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_statement():
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) == []


def test_entry(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITES])
def test_plans_stay_in_the_jvm_and_never_pair_all_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for unwanted in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(QUERIES["priority_band"](spark, SF_DIR))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("l_comment" not in s and "l_partkey" not in s and "l_orderkey" not in s for s in scans)


def test_every_row_of_lineitem_is_delivered_whatever_its_flag(spark):
    rows = starschema.table(spark, SF_DIR, "lineitem").limit(9).withColumn(
        "l_returnflag", F.element_at(F.array(F.lit("R"), F.lit(None), F.lit("Z")), (F.col("l_linenumber") % 3 + 1).cast("int"))
    )
    flags = rows.select("l_orderkey", "l_linenumber", "l_returnflag")
    found = spark.sql(starschema.BRONZE_SQL["alunos"], lineitem=rows)
    assert found.count() == 9 + flags.where("l_returnflag = 'R'").count()
