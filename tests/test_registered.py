"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from envlake.queries import expected_sql, registered
from tests.compare import differences, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registered(), expected_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


# one row, one per file, or the first five: the only results that a single task may bring together
SMALL_RESULT = {
    "bronze_refresh", "dataset_summary", "job_preview", "job_status", "summary_by_part", "missing_window_count", "preview_top5",
    "sort_breaks",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    frame = QUERIES[name](spark, SF_DIR)
    assert differences(frame, con, SQL[name]) == ""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow", "ExistingRDD", "collect_list"):
        assert forbidden not in plan
    assert name in SMALL_RESULT or "SinglePartition" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_sql_has_rows(con, name):
    assert con.execute(SQL[name]).fetchone() is not None


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "provincia", "municipio", "estacion", "magnitud", "punto_muestreo", "fecha", "uom",
        "uom_value",
    ]
