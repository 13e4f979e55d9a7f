"""Packs and staged chains of lookups: the same rows, few logs at a time, nothing left behind."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from tests.conftest import domain
from tests.test_marts import PARAMS, STATUS, item, tables

from parcelmart.operators.lookup import enrich
from parcelmart.operators.pack import Chain, add_for_tuples, columns_read, completed, pack, part, unstaged
from parcelmart.operators.publish import discard, stage
from parcelmart.plans.legs import legs
from parcelmart.plans.returns import SHIPMENT_COLUMNS, returns
from parcelmart.plans.shipments import LEG_COLUMNS, shipments
from parcelmart.plans.stock import stock
from parcelmart.plans.support import support, support_core


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (3, "b")], "id int, k string")


@pytest.fixture(scope="module")
def dims(spark):
    first = spark.createDataFrame([("a", 1), ("a", 2), (None, 9), ("c", 3)], "k string, x int")
    second = spark.createDataFrame([("a", "p"), ("b", "q"), ("b", None)], "key string, y string")
    return first, second


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_pack_gives_the_rows_of_the_chain(rows, dims):
    first, second = dims
    chained = enrich(enrich(rows, first, {"k": "k"}), second, {"key": "k"}, {"z": "y"})
    packed = pack(rows.select("k"), "k", [(first, "k"), (second, "key", {"z": "y"})])
    assert sorted_rows(enrich(rows, packed, {"k": "k"})) == sorted_rows(chained)
    assert sorted_rows(enrich(rows, part(packed, ["k"]), {"k": "k"})) == sorted_rows(chained)


def test_only_what_is_read_is_staged(rows, dims):
    assert part(dims[0], ["k"], read={"id"}) is None
    assert part(dims[0], ["k"], read={"x"}).columns == ["k", "x"]
    made = lambda df: df.withColumn("s", F.col("id") + 1).select((F.col("s") * F.col("s")).alias("q"), F.lit(1).alias("one"))
    assert columns_read(rows, lambda df: made(df).distinct()) == {"id"}
    assert columns_read(rows, lambda df: df) == {"id", "k"}
    assert completed(rows.select("k"), rows).filter("id is null").count() == rows.count()


def test_tuples_match_nulls_and_repeats(rows, dims):
    found = add_for_tuples(rows, ["k", "id"], lambda ids: enrich(ids, dims[1], {"key": "k"}, {"y": "y"}), stage)
    assert sorted_rows(found.select("id", "k", "y")) == sorted_rows(enrich(rows, dims[1], {"key": "k"}, {"y": "y"}).select("id", "k", "y"))


def test_a_cut_chain_leaves_one_table(spark, shared_dir, rows, dims):
    before = {f for f in os.listdir(shared_dir) if f.startswith("stage-")}
    chain = Chain(stage, {"x", "z"}, ["k"])
    done = chain.add(rows, dims[0], {"k": "k"})
    done = chain.cut(chain.add(done, dims[1], {"key": "k"}, {"z": "y"}))
    assert done.columns == ["k", "x", "z"]
    assert len({f for f in os.listdir(shared_dir) if f.startswith("stage-")} - before) == 1
    discard(done, rows)
    assert {f for f in os.listdir(shared_dir) if f.startswith("stage-")} == before
    lazy = Chain(unstaged, None, ["k"])
    assert lazy.cut(lazy.add(rows, dims[0], {"k": "k"})).columns == ["k", "id", "x"]


def test_tables_of_a_run_are_not_discarded(spark, rows):
    from parcelmart.operators.publish import run

    with run(spark):
        kept = stage(rows)
        discard(kept)
        assert kept.count() == rows.count()


def test_staged_marts_have_the_rows_of_the_whole_ones(spark):
    t = tables(spark)
    whole = legs(t, PARAMS)
    staged = legs(t, PARAMS, put=stage)
    assert sorted_rows(staged) == sorted_rows(whole) and whole.count() > 0
    assert plan_of(staged).count("Join") < 4 < 20 < plan_of(whole).count("Join")
    some = legs(t, PARAMS, LEG_COLUMNS, stage)
    assert sorted_rows(some) == sorted_rows(whole.select(*LEG_COLUMNS).distinct())

    core = support_core(t)
    every = stage(shipments(t, PARAMS, whole, core))
    few = shipments(t, PARAMS, some, core, SHIPMENT_COLUMNS)
    assert sorted_rows(few) == sorted_rows(every.select(*SHIPMENT_COLUMNS).distinct()) and every.count() > 0
    assert plan_of(few).count("Join") < 8

    whole = returns(t, PARAMS, every)
    assert sorted_rows(returns(t, PARAMS, few, put=stage)) == sorted_rows(whole) and whole.count() > 0
    columns = ["return_id", "rev_vendor", "fwd_vendor", "return_vendor", "rev_attempt_count", "buyer_name"]
    last = returns(t, PARAMS, every, columns, stage)
    assert sorted_rows(last) == sorted_rows(whole.select(*columns).distinct())
    assert plan_of(last).count("Join") < 4 < 20 < plan_of(whole).count("Join")


def test_support_shuffles_the_orders_it_is_about(spark):
    t = tables(spark)
    done = support(t, stage(shipments(t, PARAMS, legs(t, PARAMS), support_core(t))))
    assert plan_of(done).count("LeftSemi") == 2


def test_staged_stock_has_the_rows_of_the_whole_one(spark):
    rows: dict[str, list[dict]] = {}
    for n, ((note, state, more), _) in enumerate(STATUS, start=10):
        for table, listed in item(n, note, state, **more).items():
            rows.setdefault(table, []).extend(listed)
    t = domain(spark, **rows)
    whole, columns = stock(t), ["sku_item_id", "sku_status", "order_line_id"]
    staged = stock(t, put=stage)
    assert sorted_rows(staged) == sorted_rows(whole) and whole.count() > 0
    assert plan_of(staged).count("Join") < 3 < 10 < plan_of(whole).count("Join")
    assert sorted_rows(stock(t, columns, stage)) == sorted_rows(whole.select(*columns).distinct())
