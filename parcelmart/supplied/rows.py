"""Row selection on the supplied tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from parcelmart.functions.times import ISO_DAY, ist_format, ntz_ms
from parcelmart.operators.rows import current_rows, latest, since
from parcelmart.supplied.registry import AS_OF, WINDOW_DAYS, query


def _events(t):
    return t.events.withColumn("ts_ms", ntz_ms("ts")).select(
        "user_id", "event_type", "event_id", "ts_ms", "value", "props"
    )


@query("""
SELECT user_id, event_type, event_id, ts_ms, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts_ms DESC, event_id) AS rn
  FROM (SELECT *, epoch_us(ts) // 1000 AS ts_ms FROM events)) WHERE rn = 1
""")
def latest_event(t):
    """Last event per user and type."""
    return latest(_events(t), ["user_id", "event_type"], "ts_ms", tie=["event_id"])


@query("""
SELECT user_id, event_type, event_id, ts_ms FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, event_id) AS rn
  FROM (SELECT *, epoch_us(ts) // 1000 AS ts_ms FROM events)) WHERE rn = 1
""")
def first_event_per_user(t):
    rows = _events(t).select("user_id", "event_type", "event_id", "ts_ms")
    return latest(rows, ["user_id"], "ts_ms", ascending=True, tie=["event_id"])


@query("""
SELECT user_id, event_type, event_id, ts_ms FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id) AS rn
  FROM (SELECT *, epoch_us(ts) // 1000 AS ts_ms FROM events)) WHERE rn = 2
""")
def second_last_event(t):
    """The event before the last one of each user."""
    rows = _events(t).select("user_id", "event_type", "event_id", "ts_ms")
    return latest(rows, ["user_id"], "ts_ms", n=2, tie=["event_id"])


@query("""
SELECT event_id, user_id, event_type, strftime(ts + INTERVAL 19800 SECOND, '%Y-%m-%d') AS ist_day
FROM events WHERE CAST(ts + INTERVAL 19800 SECOND AS DATE) >= DATE '2024-01-30' - 7
""")
def window_since_ist(t):
    """Events of the last days, counted in IST days."""
    rows = since(t.events, "ts", AS_OF, WINDOW_DAYS)
    return rows.select("event_id", "user_id", "event_type", ist_format(ntz_ms("ts"), ISO_DAY).alias("ist_day"))


@query("""
SELECT 'event' AS source, event_id AS id FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-30' - 7
UNION ALL
SELECT 'order', o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '2001-08-01' - 90
""")
def window_since_utc(t):
    """Unshifted window on a time column and on a date column."""
    events = since(t.events, "ts", AS_OF, WINDOW_DAYS, shift_ms=0)
    orders = since(t.orders, "o_orderdate", date(2001, 8, 1), 90, shift_ms=0)
    return events.select(F.lit("event").alias("source"), F.col("event_id").alias("id")).unionByName(
        orders.select(F.lit("order").alias("source"), F.col("o_orderkey").alias("id"))
    )


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus <> 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_custkey IS NOT NULL
""")
def current_orders(t):
    """Live versions in a status list."""
    flagged = t.orders.withColumn("current_active", F.when(F.col("o_orderstatus") != "P", 1).otherwise(0))
    live = current_rows(flagged)
    return live.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_custkey").isNotNull()).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
