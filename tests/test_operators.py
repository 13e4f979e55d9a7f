from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F
from tests.conftest import ist, values

from parcelmart.operators.collect import counted, gather
from parcelmart.operators.ids import explode_ids
from parcelmart.operators.lookup import INNER, enrich
from parcelmart.operators.rows import current_rows, latest, since
from parcelmart.operators.timeline import attempts, first_last, state_timeline


def log(spark):
    rows = [
        ("a", "X", 10, "p"),
        ("a", "X", 30, "q"),
        ("a", "Y", 20, None),
        ("b", "Y", 5, "r"),
        ("b", "Y", 5, "s"),  # tie
        (None, "X", 99, "n"),
    ]
    return spark.createDataFrame(rows, "id string, state string, t bigint, note string")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_current_rows(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "id int, current_active int")
    assert values(current_rows(df), "id") == [1]


def test_since_matches_day_text(spark):
    times = [ist("2018-09-10 23:59:59"), ist("2018-09-11 00:00"), ist("2018-09-11 05:29:59"), ist("2018-09-11 05:30")]
    df = spark.createDataFrame([(t,) for t in [*times, None]], "t bigint")
    day = F.from_unixtime((F.col("t") + 19_800_000) / 1000, "yyyy-MM-dd")
    assert values(since(df, "t", date(2018, 9, 18), 7), "t") == values(df.filter(day >= "2018-09-11"), "t") == times[1:]
    assert values(since(df, "t", date(2018, 9, 18), 7, shift_ms=0), "t") == times[3:]


def test_since_on_dates_and_timestamps(spark):
    df = spark.sql("SELECT DATE'2018-09-11' d, TIMESTAMP'2018-09-10 18:30:00' t, TIMESTAMP_NTZ'2018-09-10 18:29:59' n")
    assert since(df, "d", date(2018, 9, 18), 7).count() == 1
    assert since(df, "t", date(2018, 9, 18), 7).count() == 1
    assert since(df, "n", date(2018, 9, 18), 7).count() == 0


def test_since_is_pushed_to_files(spark, tmp_path):
    spark.range(10).withColumn("t", F.col("id") * 1000).write.parquet(str(tmp_path / "x"))
    plan = plan_of(since(spark.read.parquet(str(tmp_path / "x")), "t", date(1970, 1, 1), 0, shift_ms=0).select("t"))
    assert "GreaterThanOrEqual(t,0)" in plan


def test_latest(spark):
    df = log(spark)
    assert values(latest(df, ["id"], "t"), "id", "state", "t", "note") == [("a", "X", 30, "q"), ("b", "Y", 5, "r")]
    assert values(latest(df, ["id"], "t", ascending=True), "id", "t") == [("a", 10), ("b", 5)]
    assert values(latest(df, ["id"], "t", n=2), "id", "t", "note") == [("a", 20, None), ("b", 5, "s")]
    assert values(latest(df, ["id", "state"], "t", n=2), "id", "note") == [("a", "p"), ("b", "s")]


@pytest.mark.parametrize("n", [1, 2])
def test_latest_limits_before_the_shuffle(spark, n):
    plan = plan_of(latest(log(spark), ["id"], "t", n=n))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_first_last_and_timeline(spark):
    df = log(spark).dropna(subset=["id"])
    assert values(first_last(df, ["id"], "t"), "id", "first", "last") == [("a", 10, 30), ("b", 5, 5)]
    outputs = {"x1": ("X", "first"), "x2": ("X", "last"), "y2": ("Y", "last"), "z": ("Z", "first")}
    got = state_timeline(df, ["id"], "state", "t", outputs)
    assert values(got, "id", "x1", "x2", "y2", "z") == [("a", 10, 30, 20, None), ("b", None, None, 5, None)]
    only_x = {"x1": ("X", "first")}
    assert values(state_timeline(df, ["id"], "state", "t", only_x), "id") == ["a"]
    assert values(state_timeline(df, ["id"], "state", "t", only_x, only_listed=False), "id") == ["a", "b"]


def test_attempts(spark):
    df = log(spark).dropna(subset=["id"])
    assert values(attempts(df, ["id"], F.col("state") == "Y"), "id", "attempts") == [("a", 1), ("b", 2)]
    assert values(attempts(df, ["id"], F.col("state") == "Y", day=F.col("t")), "id", "attempts") == [("a", 1), ("b", 1)]


def test_gather_forms(spark):
    df = log(spark).withColumn("n", F.lit(2).cast("bigint")).dropna(subset=["id"])
    df = df.unionByName(spark.createDataFrame([("c", "Z", 1, None, 2)], df.schema))
    assert values(gather(df, ["id"], "note", "v"), "id", "v") == [("a", ["p", "q"]), ("b", ["r", "s"]), ("c", [])]
    assert values(gather(df, ["id"], "state", "v", how="set"), "v") == [["X", "Y"], ["Y"], ["Z"]]
    assert values(gather(df, ["id"], "note", "v", how="text"), "v") == ["", "p,q", "r,s"]
    assert values(gather(df, ["id"], "state", "v", times="n"), "v") == [["X", "X", "X", "X", "Y", "Y"], ["Y"] * 4, ["Z", "Z"]]


def test_gather_gives_one_row_per_key_and_loses_nothing(spark):
    rnd = random.Random(7)
    rows = [("hot", f"v{rnd.randrange(40)}") for _ in range(3000)] + [("hot", "same")] * 2500 + [("cold", "x"), ("cold", None), ("hot", None)]
    df = spark.createDataFrame(rows, "k string, v string")
    expected = defaultdict(Counter)
    for k, v in rows:
        expected[k].update([v] if v else [])
    got = gather(df, ["k"], "v", "v").collect()
    assert len(got) == 2 and all(r.v == sorted(r.v) for r in got)
    assert {r.k: Counter(r.v) for r in got} == expected
    long = defaultdict(Counter)
    for r in counted(df, ["k"], "v").where("value is not null").collect():
        long[r.k][r.value] = r.n
    assert long == expected


def test_gather_has_no_limit_per_key(spark):
    df = spark.range(1_200_000).select(F.lit("hot").alias("k"), (F.col("id") % 3).alias("v"))
    (row,) = gather(df, ["k"], "v", "v").select("k", F.size("v").alias("n")).collect()
    assert row.n == 1_200_000


def test_enrich(spark):
    left = spark.createDataFrame([(1, "u"), (2, "v"), (None, "w")], "k int, mode string")
    dim = spark.createDataFrame([(1, "one"), (1, "uno"), (3, "three"), (None, "null")], "id int, name string")
    assert values(enrich(left, dim, {"id": "k"}), "mode", "name") == [("u", "one"), ("u", "uno"), ("v", None), ("w", None)]
    assert values(enrich(left, dim, {"id": "k"}, how=INNER), "mode", "name") == [("u", "one"), ("u", "uno")]
    kept = enrich(left, dim, {"id": "k"}, {"n": "name"}, when=F.col("mode") == "v")
    assert values(kept, "mode", "n") == [("u", None), ("v", None), ("w", None)]
    by_expression = enrich(left, dim, {"id": F.col("k") + 2}, {"n": F.upper("name")})
    assert values(by_expression, "mode", "n") == [("u", "THREE"), ("v", None), ("w", None)]
    roles = enrich(enrich(left, dim, {"id": "k"}, {"a": "name"}), dim, {"id": "k"}, {"b": "name", "id": "id"})
    assert roles.columns == ["k", "mode", "a", "b", "id"] and roles.count() == 6


def test_enrich_guard(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    good = spark.createDataFrame([(1, "a"), (2, "b"), (None, "x"), (None, "y")], "id int, name string")
    assert enrich(left, good, {"id": "k"}, unique=True).count() == 2
    bad = spark.createDataFrame([(1, "a"), (1, "b")], "id int, name string")
    with pytest.raises(Exception, match="duplicate key"):
        enrich(left, bad, {"id": "k"}, unique=True).collect()


def test_explode_ids(spark):
    rows = [(1, '["SR1","SR2","SR1"]'), (2, None), (3, "[]"), (4, '["XX1","SR9 "]')]
    df = spark.createDataFrame(rows, "id int, txt string")
    assert values(explode_ids(df, "txt", "SR", "sr"), "id", "sr") == [(1, "SR1"), (1, "SR2"), (2, None), (4, "SR9")]
