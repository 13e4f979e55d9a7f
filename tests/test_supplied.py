"""Registered queries against their SQL, and the shape of their plans."""

from __future__ import annotations

import os

import pytest
from tests.oracle import connect, differences

from parcelmart.supplied import ORACLE, QUERIES

FOLDER = os.environ.get("PARCELMART_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables not found")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, name):
    found, _ = differences(spark, QUERIES[name], ORACLE[name], FOLDER, con)
    assert not found, found


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("mart_")])
def test_plans_stay_scalable(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "CollectLimit", "SinglePartition"):
        assert bad not in plan, f"{bad} in {name}"


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["window_since_ist"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan
    plan = QUERIES["distinct_parts_per_supplier"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan


@pytest.mark.parametrize("name", ["second_last_event", "log_semijoin_rank", "collect_types", "any_value_dedupe", "mart_stock"])
def test_rows_do_not_depend_on_partitioning(spark, name):
    def rows(partitions: str):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        return sorted(map(tuple, QUERIES[name](spark, FOLDER).collect()), key=repr)

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert rows("2") == rows("7")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
