"""Lookups of rows with NULL and hot keys: the same rows, spread evenly."""

from __future__ import annotations

from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from parcelmart.operators.lookup import DEALT, INNER, deal, enrich, hot_keys

PLAIN_JOINS = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def left(spark):
    # of 20,000 rows 90 % have no key, and half of the others one key
    key = F.when(F.col("id") % 10 > 0, None).when(F.col("id") % 20 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 700))
    return spark.range(20_000).select("id", key.alias("k"), F.create_map(F.lit("a"), "id").alias("m"))


@pytest.fixture(scope="module")
def dim(spark):
    rows = [("hot", "x"), ("hot", "y"), (None, "none"), *[(f"k{i}", f"name {i}") for i in range(0, 700, 3)], ("k30", "twice")]
    return spark.createDataFrame(rows, "key string, name string")


def rows_of(df):
    return sorted(df.drop("m", DEALT).collect(), key=repr)


@pytest.mark.parametrize("how", ["left", INNER])
@pytest.mark.parametrize("share", [None, 0.1, 0.001])
def test_same_rows(left, dim, how, share):
    rows, dealt = deal(left, ["k"], share, copies=8)
    assert rows_of(enrich(rows, dim, {"key": "k"}, {"name": "name"}, how, dealt=dealt)) == rows_of(enrich(left, dim, {"key": "k"}, {"name": "name"}, how))
    odd = F.col("id") % 40 == 0
    got = enrich(rows, dim, {"key": "k"}, {"name": "name"}, how, when=odd, dealt=dealt)
    assert rows_of(got) == rows_of(enrich(left, dim, {"key": "k"}, {"name": "name"}, how, when=odd))


def test_tasks_are_even(spark, left, dim):
    with settings(spark, PLAIN_JOINS):

        def largest(df):
            held = Counter(r[0] for r in df.select(F.spark_partition_id()).collect())
            return max(held.values()) / (sum(held.values()) / 16)

        rows, dealt = deal(left, ["k"], 0.1)
        assert largest(enrich(left, dim, {"key": "k"})) > 10
        assert largest(enrich(rows, dim, {"key": "k"}, dealt=dealt)) < 2


def test_lookups_by_one_key_share_a_shuffle(spark, left, dim):
    with settings(spark, PLAIN_JOINS):
        rows, dealt = deal(left.drop("m"), ["k"])
        twice = enrich(enrich(rows, dim, {"key": "k"}, {"a": "name"}, dealt=dealt), dim, {"key": "k"}, {"b": "name"}, dealt=dealt)
        plan = twice._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(k") <= 3


def test_hot_keys_and_composite_keys(spark, left, dim):
    assert len(hot_keys(left, ["k"], 0.1)) == 1
    assert hot_keys(left.where("k is null"), ["k"], 0.1) == () == hot_keys(left.limit(0), ["k"], 0.1)
    rows, dealt = deal(left.withColumn("j", F.col("id") % 3), ["k", "j"], 0.1, copies=4)
    both = dim.crossJoin(spark.range(3).withColumnRenamed("id", "n"))
    on = {"key": "k", "n": "j"}
    assert len(dealt.hot) == 3
    assert rows_of(enrich(rows, both, on, dealt=dealt)) == rows_of(enrich(rows.drop(DEALT), both, on))


def test_other_types_and_columns_are_refused(spark, left):
    rows, dealt = deal(left, ["id"], 0.5)
    narrow = spark.createDataFrame([(1, "x")], "key int, name string")
    with pytest.raises(ValueError, match="dealt key"):
        enrich(rows, narrow, {"key": "id"}, dealt=dealt)
    with pytest.raises(ValueError, match="dealt by"):
        enrich(left, narrow, {"key": "id"}, dealt=dealt)
