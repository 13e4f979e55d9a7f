"""Joins and set operations on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelmart.functions.text import json_text, part_of
from parcelmart.functions.times import ntz_ms
from parcelmart.operators.ids import explode_ids
from parcelmart.operators.lookup import INNER, enrich
from parcelmart.operators.rows import latest
from parcelmart.supplied.registry import query


def _places(t):
    """Nation with its region name."""
    return enrich(t.nation, t.region, {"r_regionkey": "n_regionkey"}, {"region": "r_name"}, unique=True)


@query("""
SELECT l.l_orderkey, l.l_partkey, l.l_quantity, nb.n_name AS buyer_nation, rb.r_name AS buyer_region,
  ns.n_name AS seller_nation, rs.r_name AS seller_region
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation nb ON nb.n_nationkey = c.c_nationkey LEFT JOIN region rb ON rb.r_regionkey = nb.n_regionkey
LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
LEFT JOIN nation ns ON ns.n_nationkey = s.s_nationkey LEFT JOIN region rs ON rs.r_regionkey = ns.n_regionkey
""")
def enrich_left(t):
    """One dimension in two roles: where the buyer is and where the seller is."""
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_suppkey")
    rows = enrich(lines, t.orders, {"o_orderkey": "l_orderkey"}, {"o_custkey": "o_custkey"})
    rows = enrich(rows, t.customer, {"c_custkey": "o_custkey"}, {"buyer_nationkey": "c_nationkey"})
    rows = enrich(rows, t.supplier, {"s_suppkey": "l_suppkey"}, {"seller_nationkey": "s_nationkey"})
    for role in ("buyer", "seller"):
        rows = enrich(
            rows, _places(t), {"n_nationkey": f"{role}_nationkey"}, {f"{role}_nation": "n_name", f"{role}_region": "region"}
        )
    return rows.drop("l_suppkey", "o_custkey", "buyer_nationkey", "seller_nationkey")


@query("""
SELECT o_orderkey, l_partkey, l_suppkey, l_quantity FROM orders
LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R'
""")
def left_join_cond_right(t):
    """Constant condition on the looked-up side: orders without a match stay."""
    returned = t.lineitem.filter(F.col("l_returnflag") == "R")
    rows = enrich(
        t.orders.select("o_orderkey"),
        returned,
        {"l_orderkey": "o_orderkey"},
        {c: c for c in ("l_partkey", "l_suppkey", "l_quantity")},
    )
    return rows


@query("""
SELECT o_orderkey, o_orderstatus, c_name, c_mktsegment FROM orders
LEFT JOIN customer ON c_custkey = o_custkey AND o_orderstatus = 'F'
""")
def left_join_cond_left(t):
    """Condition on the kept side: orders that fail it stay without a match."""
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_custkey")
    rows = enrich(
        orders,
        t.customer,
        {"c_custkey": "o_custkey"},
        {"c_name": "c_name", "c_mktsegment": "c_mktsegment"},
        when=F.col("o_orderstatus") == "F",
    )
    return rows.drop("o_custkey")


@query("""
SELECT o_orderkey, l_partkey, l_linestatus FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
WHERE l_linestatus = 'F' AND l_quantity > 10
""")
def left_then_where(t):
    """A left join whose right side is then filtered is an inner join; the filter goes first."""
    finished = t.lineitem.filter((F.col("l_linestatus") == "F") & (F.col("l_quantity") > 10))
    return enrich(
        t.orders.select("o_orderkey"),
        finished,
        {"l_orderkey": "o_orderkey"},
        {"l_partkey": "l_partkey", "l_linestatus": "l_linestatus"},
        how=INNER,
    )


@query("""
SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey
""")
def left_then_inner(t):
    """A left join followed by an inner join over its columns is inner as a whole."""
    rows = enrich(
        t.customer.select("c_custkey", "c_nationkey"),
        t.nation,
        {"n_nationkey": "c_nationkey"},
        {"n_name": "n_name", "n_regionkey": "n_regionkey"},
        how=INNER,
    )
    rows = enrich(rows, t.region, {"r_regionkey": "n_regionkey"}, {"r_name": "r_name"}, how=INNER)
    return rows.select("c_custkey", "n_name", "r_name")


@query("""
SELECT DISTINCT o_orderkey, l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'A'
""")
def equi_not_cross(t):
    """Payer per order found by key, where a join without a condition would pair everything."""
    accepted = t.lineitem.filter(F.col("l_returnflag") == "A")
    rows = enrich(
        t.orders.select("o_orderkey"), accepted, {"l_orderkey": "o_orderkey"}, {"l_suppkey": "l_suppkey"}, how=INNER
    )
    return rows.distinct()


@query("""
SELECT o_orderkey, c_custkey, c_name, n_name AS brand_nation, p_partkey FROM orders
LEFT JOIN customer ON CAST(split_part(trim(c_name), '#', 2) AS BIGINT) = o_custkey AND starts_with(c_name, 'Customer')
LEFT JOIN part ON p_partkey = o_orderkey
LEFT JOIN nation ON n_nationkey = TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER)
""")
def expr_key_join(t):
    """Keys cut out of text before the join, so that the join stays an equality."""
    customers = t.customer.filter(F.col("c_name").startswith("Customer")).select(
        part_of(F.trim("c_name"), "#", 1).try_cast("bigint").alias("key"), "c_custkey", "c_name"
    )
    parts = t.part.select("p_partkey", part_of("p_brand", "#", 1).try_cast("int").alias("brand_no"))
    rows = enrich(t.orders.select("o_orderkey", "o_custkey"), customers, {"key": "o_custkey"})
    rows = enrich(rows, parts, {"p_partkey": "o_orderkey"}, {"p_partkey": "p_partkey", "brand_no": "brand_no"})
    rows = enrich(rows, t.nation, {"n_nationkey": "brand_no"}, {"brand_nation": "n_name"})
    return rows.drop("o_custkey", "brand_no")


@query("""
SELECT event_id, n_name FROM events LEFT JOIN nation ON n_nationkey = CAST(json_extract_string(props, '$.k') AS INTEGER)
""")
def json_key_join(t):
    """Join key read from a JSON column."""
    rows = t.events.select("event_id", json_text("props", "$.k").try_cast("int").alias("k"))
    return enrich(rows, t.nation, {"n_nationkey": "k"}, {"n_name": "n_name"}).drop("k")


@query("""
SELECT o_orderkey, n_lines, qty FROM orders LEFT JOIN (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
""")
def agg_subquery_join(t):
    """Aggregate first, then join one row per key."""
    totals = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty"))
    return enrich(t.orders.select("o_orderkey"), totals, {"l_orderkey": "o_orderkey"})


@query("""
SELECT user_id, event_id, event_type, ts_ms FROM (
  SELECT e.*, row_number() OVER (PARTITION BY e.user_id ORDER BY ts_ms DESC, event_id) AS rn
  FROM (SELECT *, epoch_us(ts) // 1000 AS ts_ms FROM events) e
  JOIN (SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND value > 20) q ON q.user_id = e.user_id
  WHERE e.event_type NOT LIKE '%sign%') WHERE rn = 2
""")
def log_semijoin_rank(t):
    """Log restricted to qualifying entities, then ranked; the second row is taken."""
    bad = t.events.filter((F.col("event_type") == "error") & (F.col("value") > 20)).select("user_id").distinct()
    log = t.events.filter(~F.col("event_type").contains("sign")).select(
        "user_id", "event_id", "event_type", ntz_ms("ts").alias("ts_ms")
    )
    return latest(log.join(bad, "user_id", "left_semi"), ["user_id"], "ts_ms", n=2, tie=["event_id"])


@query("""
SELECT o_orderkey, count(*) AS n, min(epoch_us(l_shipdate) // 1000) AS first_hit FROM lineitem
JOIN orders ON o_orderkey = l_orderkey
WHERE lower(o_orderpriority) LIKE '%' || CAST(l_linenumber AS VARCHAR) || '%' GROUP BY o_orderkey
""")
def pattern_residual_join(t):
    """Equality on the key, and a text of one side that must occur in a text of the other."""
    rows = enrich(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate"),
        t.orders,
        {"o_orderkey": "l_orderkey"},
        {"o_orderkey": "o_orderkey", "o_orderpriority": "o_orderpriority"},
        how=INNER,
    )
    hit = F.lower("o_orderpriority").contains(F.col("l_linenumber").cast("string"))
    return rows.filter(hit).groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.min(ntz_ms("l_shipdate")).alias("first_hit")
    )


@query("""
SELECT l_orderkey, l_partkey, l_quantity, o_custkey, c_mktsegment, n_name, r_name, p_brand FROM lineitem
LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
LEFT JOIN part ON p_partkey = l_partkey
""")
def snowflake_chain(t):
    """Each lookup uses a key the one before brought in."""
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    rows = enrich(rows, t.orders, {"o_orderkey": "l_orderkey"}, {"o_custkey": "o_custkey"})
    rows = enrich(
        rows, t.customer, {"c_custkey": "o_custkey"}, {"c_mktsegment": "c_mktsegment", "c_nationkey": "c_nationkey"}
    )
    rows = enrich(rows, t.nation, {"n_nationkey": "c_nationkey"}, {"n_name": "n_name", "n_regionkey": "n_regionkey"})
    rows = enrich(rows, t.region, {"r_regionkey": "n_regionkey"}, {"r_name": "r_name"})
    rows = enrich(rows, t.part, {"p_partkey": "l_partkey"}, {"p_brand": "p_brand"})
    return rows.drop("c_nationkey", "n_regionkey")


@query("""
SELECT s_nationkey AS nationkey, s_suppkey AS supplier_id, CAST(NULL AS BIGINT) AS customer_id, s_name AS name FROM supplier
UNION SELECT c_nationkey, NULL, c_custkey, c_name FROM customer
""")
def union_padded(t):
    """Distinct union of two shapes, lined up with NULL columns."""
    nothing = F.lit(None).cast("bigint")
    suppliers = t.supplier.select(
        F.col("s_nationkey").alias("nationkey"),
        F.col("s_suppkey").alias("supplier_id"),
        nothing.alias("customer_id"),
        F.col("s_name").alias("name"),
    )
    customers = t.customer.select(
        F.col("c_nationkey").alias("nationkey"),
        nothing.alias("supplier_id"),
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
    )
    return suppliers.unionByName(customers).distinct()


@query("""
SELECT DISTINCT conv_id, turn, token FROM (
  SELECT conv_id, turn, unnest(string_split(text, ' ')) AS token FROM conversations WHERE role <> 'system')
WHERE starts_with(token, 'an')
UNION SELECT conv_id, turn, NULL FROM conversations WHERE role = 'system'
""")
def union_explode_rest(t):
    """One row per id listed in a text, and the rows that have no text to list from."""
    said = F.when(F.col("role") != "system", F.col("text"))
    rows = t.conversations.select("conv_id", "turn", said.alias("said"))
    return explode_ids(rows, "said", "an", "token", separator=" ").drop("said").distinct()
