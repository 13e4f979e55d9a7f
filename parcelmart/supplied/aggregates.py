"""Aggregations on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelmart.functions.text import json_text
from parcelmart.functions.times import IST_MS, ISO_DAY, ist_format, ms_of, ntz_ms
from parcelmart.operators.collect import counted, gather
from parcelmart.operators.timeline import attempts, first_last, state_timeline
from parcelmart.supplied.registry import query

EVENT_STATES = ("signup", "view", "click", "purchase", "error")


@query("""
SELECT user_id, event_type, min(epoch_us(ts) // 1000) AS first, max(epoch_us(ts) // 1000) AS last
FROM events GROUP BY user_id, event_type
""")
def first_last_by_state(t):
    return first_last(t.events, ["user_id", "event_type"], ntz_ms("ts"))


@query("""
SELECT user_id,
  min(CASE WHEN event_type = 'signup' THEN ms END) AS first_signup, max(CASE WHEN event_type = 'signup' THEN ms END) AS last_signup,
  min(CASE WHEN event_type = 'view' THEN ms END) AS first_view, max(CASE WHEN event_type = 'view' THEN ms END) AS last_view,
  min(CASE WHEN event_type = 'click' THEN ms END) AS first_click, max(CASE WHEN event_type = 'click' THEN ms END) AS last_click,
  min(CASE WHEN event_type = 'purchase' THEN ms END) AS first_purchase, max(CASE WHEN event_type = 'purchase' THEN ms END) AS last_purchase,
  min(CASE WHEN event_type = 'error' THEN ms END) AS first_error, max(CASE WHEN event_type = 'error' THEN ms END) AS last_error
FROM (SELECT *, epoch_us(ts) // 1000 AS ms FROM events) GROUP BY user_id
""", name="state_timeline")
def state_timeline_by_user(t):
    """One row per user with first and last time of every state."""
    outputs = {f"{which}_{s}": (s, which) for s in EVENT_STATES for which in ("first", "last")}
    return state_timeline(t.events, ["user_id"], "event_type", ntz_ms("ts"), outputs)


@query("""
SELECT o_custkey, min(epoch_us(o_orderdate) // 1000) AS first, max(epoch_us(o_orderdate) // 1000) AS last
FROM orders GROUP BY o_custkey
""")
def first_last_order(t):
    return first_last(t.orders, ["o_custkey"], ntz_ms("o_orderdate"))


@query("SELECT user_id, count(*) AS attempts FROM events WHERE event_type = 'error' GROUP BY user_id")
def attempts_by_event(t):
    return attempts(t.events, ["user_id"], F.col("event_type") == "error")


@query("""
SELECT user_id, count(DISTINCT strftime(ts + INTERVAL 19800 SECOND, '%Y-%m-%d')) AS attempts
FROM events WHERE event_type = 'error' GROUP BY user_id
""")
def attempts_by_day(t):
    """Distinct IST days with an attempt."""
    return attempts(t.events, ["user_id"], F.col("event_type") == "error", day=ist_format(ntz_ms("ts"), ISO_DAY))


@query("SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY l_suppkey")
def distinct_parts_per_supplier(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("n_parts"))


@query("""
SELECT l_orderkey, l_returnflag, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) / 100.0::DOUBLE AS amount
FROM lineitem GROUP BY l_orderkey, l_returnflag
""")
def amount_by_flag(t):
    """Money summed as integer paisa, so the result does not depend on the order of addition."""
    paisa = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return t.lineitem.groupBy("l_orderkey", "l_returnflag").agg((F.sum(paisa) / 100).alias("amount"))


@query("""
SELECT user_id, count(*) AS n, array_to_string(list_sort(list(event_type)), '|') AS types
FROM events GROUP BY user_id
""")
def collect_types(t):
    """All states of a user, sorted, with repeats; shown as text at the end."""
    found = gather(t.events, ["user_id"], "event_type", "types")
    return found.select(
        "user_id", F.size("types").cast("bigint").alias("n"), F.array_join("types", "|").alias("types")
    )


@query("""
SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), '|') AS types
FROM events GROUP BY user_id
""")
def collect_set_types(t):
    found = gather(t.events, ["user_id"], "event_type", "types", how="set")
    return found.withColumn("types", F.array_join("types", "|"))


@query("""
SELECT user_id, event_type AS value, count(*) AS n FROM events GROUP BY user_id, event_type
""")
def counted_types(t):
    """The long form of gathered values."""
    return counted(t.events, ["user_id"], "event_type")


@query("""
SELECT l_orderkey, array_to_string(list_sort(list(concat(l_returnflag, l_linestatus))), ',') AS tags
FROM lineitem GROUP BY l_orderkey
""")
def joined_tags(t):
    """Tags of an order's lines joined into one text."""
    return gather(t.lineitem, ["l_orderkey"], F.concat("l_returnflag", "l_linestatus"), "tags", how="text")


@query("""
SELECT o_custkey, count(o_orderkey) AS n_orders, CASE WHEN count(o_orderkey) > 3 THEN 'Mature' ELSE 'New' END AS maturity
FROM orders GROUP BY o_custkey
""")
def maturity_label(t):
    counted = t.orders.groupBy("o_custkey").agg(F.count("o_orderkey").alias("n_orders"))
    return counted.withColumn("maturity", F.when(F.col("n_orders") > 3, "Mature").otherwise("New"))


@query("""
SELECT l_orderkey, l_suppkey, max(l_shipdate)::DATE::VARCHAR AS shipped, max(l_linestatus) AS linestatus
FROM (SELECT DISTINCT l_orderkey, l_suppkey, l_shipdate, l_linestatus FROM lineitem)
GROUP BY l_orderkey, l_suppkey
""")
def any_value_dedupe(t):
    """One value per key out of near-duplicates; the maximum, so that it is always the same one."""
    return t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(
        F.date_format(F.max("l_shipdate"), ISO_DAY).alias("shipped"), F.max("l_linestatus").alias("linestatus")
    )


@query("""
SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM events GROUP BY 1
""")
def group_by_json(t):
    k = json_text("props", "$.k").try_cast("bigint").alias("k")
    return t.events.groupBy(k).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents")
    )


@query("""
SELECT user_id, max(epoch_us(ts) // 1000 + 19800000) AS last_ist, max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS max_k
FROM events GROUP BY user_id
""")
def agg_of_expr(t):
    """Maximum of a shifted time, and of digits kept as text (compared as numbers)."""
    return t.events.groupBy("user_id").agg(
        F.max(ntz_ms("ts") + IST_MS).alias("last_ist"), F.max(ms_of(json_text("props", "$.k"))).alias("max_k")
    )


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_returnflag, array_to_string(tags, '|') AS tags FROM (
  SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_quantity, l_returnflag, [l_returnflag, l_linestatus] AS tags FROM lineitem)
""")
def distinct_wide(t):
    """Distinct over a wide row that holds an array."""
    wide = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", F.array("l_returnflag", "l_linestatus").alias("tags")
    )
    return wide.distinct().withColumn("tags", F.array_join("tags", "|"))
