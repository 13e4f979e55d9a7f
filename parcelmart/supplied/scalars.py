"""Column expressions and rules on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelmart.functions import rules as R
from parcelmart.functions.rules import Rule
from parcelmart.functions.text import extract_id, json_fields, json_text, part_of, without_breaks
from parcelmart.functions.times import (
    DAY,
    DAY_MS,
    DAY_TIME,
    ISO_DAY,
    ISO_TIME,
    floor_zero,
    ist_format,
    ist_format_s,
    ist_midnight,
    month_day_label,
    ntz_ms,
    parse_seconds,
    parse_time,
    whole_days,
)
from parcelmart.operators.lookup import enrich
from parcelmart.supplied.registry import query


@query("""
SELECT event_id, strftime(ist, '%Y-%m-%d %H:%M:%S') AS iso_time, strftime(ist, '%d-%m-%Y %H:%M:%S') AS day_time,
  strftime(ist, '%d-%m-%Y') AS day, strftime(ist, '%Y-%m-%d 00:00:00') AS midnight, strftime(ist, '%Y-%m-%d') AS iso_day
FROM (SELECT event_id, ts + INTERVAL 19800 SECOND AS ist FROM events)
""")
def ist_formats(t):
    ms = ntz_ms("ts")
    return t.events.select(
        "event_id",
        ist_format(ms, ISO_TIME).alias("iso_time"),
        ist_format_s(F.floor(ms / 1000), DAY_TIME).alias("day_time"),
        ist_format(ms, DAY).alias("day"),
        F.date_format(F.timestamp_millis(ist_midnight(ms)), ISO_TIME).alias("midnight"),
        F.date_format(parse_time(ist_format(ms, DAY), DAY), ISO_DAY).alias("iso_day"),
    )


@query("""
SELECT o_orderkey, epoch_us(o_orderdate) // 1000000 AS parsed, CAST(NULL AS BIGINT) AS bad,
  CAST(epoch_us(date_trunc('day', o_orderdate)) // 1000 AS BIGINT) AS midnight_ms,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS INTEGER) AS age_days,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') / 7 AS DOUBLE) AS age_weeks,
  strftime(o_orderdate, '%m/ %d') AS day_label
FROM orders
""")
def parse_midnight_days(t):
    """Text to time (bad text gives NULL), truncation to midnight, day differences, day label."""
    text = F.date_format("o_orderdate", DAY_TIME)
    seconds = parse_seconds(text, DAY_TIME)
    end = F.lit("2001-08-01")
    shifted = seconds * 1000 - 19_800_000
    return t.orders.select(
        "o_orderkey",
        seconds.alias("parsed"),
        parse_seconds(F.concat(text, F.lit("x")), DAY_TIME).alias("bad"),
        ist_midnight(shifted).alias("midnight_ms"),
        F.datediff(end, F.to_date(parse_time(text, DAY_TIME))).alias("age_days"),
        (floor_zero(whole_days(parse_seconds(end, ISO_DAY) * 1000, seconds * 1000)) / 7).alias("age_weeks"),
        month_day_label(F.to_date("o_orderdate")).alias("day_label"),
    )


@query("""
SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag AS flag, CAST(l_partkey AS VARCHAR) AS first_id,
  CAST(l_suppkey AS VARCHAR) AS root_second, l_linestatus AS nested, CAST(NULL AS VARCHAR) AS missing,
  concat('["', l_returnflag, '","', l_linestatus, '"]') AS part_text, CAST(l_linenumber AS DOUBLE) / 1000 AS number,
  CAST(l_suppkey AS VARCHAR) AS from_map
FROM lineitem
""")
def json_shapes(t):
    """Simple, indexed, root-indexed, nested and missing paths, sub-documents, a map lookup."""
    inner = F.to_json(F.struct(F.col("l_linestatus").alias("status")))
    document = F.to_json(
        F.struct(
            F.struct(F.col("l_returnflag").alias("flag"), F.array("l_partkey", "l_suppkey").alias("ids")).alias("data"),
            inner.alias("kept"),
            F.array("l_returnflag", "l_linestatus").alias("flags"),
            F.col("l_linenumber").alias("n"),
        )
    )
    rows = t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        document.alias("doc"),
        F.to_json(F.array("l_partkey", "l_suppkey")).alias("root"),
        F.create_map(F.lit("supplier"), F.col("l_suppkey").cast("string")).alias("attributes"),
    )
    fields = json_fields(
        "doc", {"flag": "$.data.flag", "first_id": "$.data.ids[0]", "missing": "$.data.none", "part_text": "$.flags"}
    )
    return rows.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        *fields,
        json_text("root", "$[1]").alias("root_second"),
        json_text("doc", "$.kept", "$.status").alias("nested"),
        (json_text("doc", "$.n").try_cast("double") / 1000).alias("number"),
        F.col("attributes")["supplier"].alias("from_map"),
    )


@query("""
SELECT o_orderkey, split_part(task, '"', 4) AS consignment, length(task) AS n FROM (
  SELECT o_orderkey, unnest(string_split(substr(txt, 2, length(txt) - 2), ',')) AS task FROM (
    SELECT o_orderkey, concat('[{"consignmentId":"C', o_orderkey, '"},{"consignmentId":"D', o_custkey, '"},{"other":"x"}]') AS txt
    FROM orders)) WHERE task LIKE '%consignmentId%'
""")
def task_tokens(t):
    """Brackets cut off a text list, split, the wanted entries kept and their value picked."""
    text = F.concat(
        F.lit('[{"consignmentId":"C'),
        F.col("o_orderkey"),
        F.lit('"},{"consignmentId":"D'),
        F.col("o_custkey"),
        F.lit('"},{"other":"x"}]'),
    )
    inside = text.substr(F.lit(2), F.length(text) - 2)
    rows = t.orders.select("o_orderkey", F.explode(F.split(inside, ",")).alias("task"))
    rows = rows.filter(F.col("task").contains("consignmentId"))
    return rows.select(
        "o_orderkey", part_of("task", '"', 3).alias("consignment"), F.length("task").cast("bigint").alias("n")
    )


@query("""
SELECT o_orderkey, concat('OD', lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS order_id,
  CASE WHEN o_orderstatus = 'F' THEN concat('RT', lpad(CAST(o_custkey AS VARCHAR), 12, '0')) END AS return_id,
  CAST(NULL AS VARCHAR) AS issue_id
FROM orders
""")
def extract_ids(t):
    """Ids found in free text by key and checked by prefix."""
    prefix = F.when(F.col("o_orderstatus") == "F", "RT").otherwise("XX")
    text = F.concat(
        F.lit('{"orderId":"OD'),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0"),
        F.lit('","returnId":"'),
        prefix,
        F.lpad(F.col("o_custkey").cast("string"), 12, "0"),
        F.lit('"}'),
    )
    rows = t.orders.select("o_orderkey", text.alias("note"))
    return rows.select(
        "o_orderkey",
        extract_id("note", "orderId", "OD", 14).alias("order_id"),
        extract_id("note", "returnId", "RT", 14).alias("return_id"),
        extract_id("note", "issueId", "SI", 9).alias("issue_id"),
    )


@query(r"""
SELECT doc_id, length(clean) AS n, md5(clean) AS digest, concat(lang, '/', source) AS origin,
  clean LIKE '%the%' AS has_the, clean NOT LIKE 'The%' AS not_the_first
FROM (SELECT *, regexp_replace(text, '\r|\t|\n', '', 'g') AS clean FROM documents)
""")
def text_clean(t):
    """Control characters removed from whole texts, constant patterns tested."""
    rows = t.documents.select("doc_id", "lang", "source", without_breaks("text").alias("clean"))
    return rows.select(
        "doc_id",
        F.length("clean").cast("bigint").alias("n"),
        F.md5("clean").alias("digest"),
        F.concat("lang", F.lit("/"), "source").alias("origin"),
        F.col("clean").contains("the").alias("has_the"),
        (~F.col("clean").startswith("The")).alias("not_the_first"),
    )


@query("""
SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) / 100.0::DOUBLE AS rupees, coalesce(n, 0) AS n_lines,
  CASE WHEN n IS NOT NULL THEN 'lines' WHEN o_orderstatus IS NOT NULL THEN o_orderstatus END AS first_known,
  round(o_totalprice / 1000, 0) AS thousands, CAST(trunc(o_totalprice / 1000) AS BIGINT) AS whole_thousands
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
""")
def scaling_round(t):
    """Paisa to rupee, rounding, truncation, defaults for missing values."""
    counts = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    rows = enrich(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), counts, {"l_orderkey": "o_orderkey"})
    return rows.select(
        "o_orderkey",
        (F.round(F.col("o_totalprice") * 100).cast("bigint") / 100).alias("rupees"),
        F.coalesce("n", F.lit(0)).alias("n_lines"),
        F.when(F.col("n").isNotNull(), F.lit("lines")).otherwise(F.col("o_orderstatus")).alias("first_known"),
        F.round(F.col("o_totalprice") / 1000, 0).alias("thousands"),
        (F.col("o_totalprice") / 1000).cast("bigint").alias("whole_thousands"),
    )


@query("""
SELECT l_orderkey, l_partkey, days, CASE WHEN days <= lim THEN 'Within_SLA' WHEN days > lim THEN 'Outside_SLA' END AS ship_sla,
  CASE WHEN l_returnflag = 'R' AND days > lim THEN 'YES' WHEN l_returnflag = 'R' THEN 'NO' END AS late_return
FROM (
  SELECT l_orderkey, l_partkey, l_returnflag, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days,
    CASE o_orderpriority WHEN '1-URGENT' THEN 6 WHEN '2-HIGH' THEN 13 WHEN '3-MEDIUM' THEN 18 END AS lim
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey)
""")
def sla_flags(t):
    """Days taken against the limit of the group; no limit, no flag."""
    rows = enrich(
        t.lineitem.select("l_orderkey", "l_partkey", "l_returnflag", "l_shipdate"),
        t.orders,
        {"o_orderkey": "l_orderkey"},
        {"o_orderdate": "o_orderdate", "o_orderpriority": "o_orderpriority"},
    )
    days = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    limit = R.by_group(F.col("o_orderpriority"), {"1-URGENT": 6, "2-HIGH": 13, "3-MEDIUM": 18})
    rows = rows.select("l_orderkey", "l_partkey", "l_returnflag", days.alias("days"), limit.alias("limit"))
    late = F.when(F.col("l_returnflag") == "R", F.when(F.col("days") > F.col("limit"), "YES").otherwise("NO"))
    return rows.select(
        "l_orderkey",
        "l_partkey",
        "days",
        R.sla_flag(F.col("days") <= F.col("limit")).alias("ship_sla"),
        late.alias("late_return"),
    )


_ZONES = R.LOCAL_LANES + R.ZONAL_LANES + R.NATIONAL_LANES


@query("""
SELECT c_custkey, CASE WHEN z IN ('LU', 'LU_MED', 'LU_NEAR', 'LU_FAR') THEN 'LU' ELSE z END AS lane,
  CASE WHEN z IN ('LU', 'LU_MED', 'LU_NEAR', 'LU_FAR') THEN 'Local' WHEN z IN ('ZR', 'ZSU', 'ZU') THEN 'Zonal' ELSE 'National' END AS zone
FROM (SELECT c_custkey, ['LU', 'LU_MED', 'LU_NEAR', 'LU_FAR', 'ZR', 'ZSU', 'ZU', 'NR', 'NSU', 'NU', 'NM'][c_nationkey + 1] AS z FROM customer)
""")
def lane_zone(t):
    """Zone per nation number; a nation without a zone counts as national."""
    zone = F.get(F.array(*[F.lit(z) for z in _ZONES]), F.col("c_nationkey"))
    return t.customer.select("c_custkey", R.lane_name(zone).alias("lane"), R.lane_zone(zone).alias("zone"))


def _event_rules() -> dict[str, list[Rule]]:
    return {
        "error": [
            Rule("has", "99", "Ninety nine"),
            Rule("head", "k=10", "Ten"),
            Rule("is", "k=2:error", "Two"),
            Rule("is", "k=3:error", "Two"),
            Rule("starts", "k=1", "One and teens"),
            Rule("has", "7", None),
        ],
        "click": [Rule("second", "click", F.col("event_type"))],
        "view": [Rule("head", "k=5", "Five"), Rule("has", "5", "Some five")],
    }


@query("""
SELECT event_id, CASE
  WHEN event_type = 'error' AND txt LIKE '%99%' THEN 'Ninety nine'
  WHEN event_type = 'error' AND split_part(txt, ':', 1) = 'k=10' THEN 'Ten'
  WHEN event_type = 'error' AND txt IN ('k=2:error', 'k=3:error') THEN 'Two'
  WHEN event_type = 'error' AND txt LIKE 'k=1%' THEN 'One and teens'
  WHEN event_type = 'error' AND txt LIKE '%7%' THEN NULL
  WHEN event_type = 'click' AND split_part(txt, ':', 2) = 'click' THEN event_type
  WHEN event_type = 'view' AND split_part(txt, ':', 1) = 'k=5' THEN 'Five'
  WHEN event_type = 'view' AND txt LIKE '%5%' THEN 'Some five'
  ELSE 'Miscellaneous' END AS reason
FROM (SELECT event_id, event_type, concat('k=', json_extract_string(props, '$.k'), ':', event_type) AS txt FROM events)
""")
def taxonomy(t):
    """First matching rule of the group, in order."""
    text = F.concat(F.lit("k="), json_text("props", "$.k"), F.lit(":"), F.col("event_type"))
    reason = R.classify(F.col("event_type"), text, _event_rules(), default="Miscellaneous")
    return t.events.select("event_id", reason.alias("reason"))


@query("""
SELECT o_orderkey, CASE
  WHEN r IS NOT NULL AND rs = 'O' THEN 'RETURN_OPEN' WHEN r IS NOT NULL AND rs = 'F' THEN 'RETURN_DONE'
  WHEN n IS NOT NULL AND ns = 'F' THEN 'SHIPPED' WHEN n IS NOT NULL AND ns = 'O' AND o_orderstatus = 'P' THEN 'SHIPPING'
  WHEN a IS NOT NULL THEN 'ACCEPTED'
  WHEN o_orderstatus = 'O' THEN 'ORDER_OPEN' WHEN o_orderstatus = 'F' THEN 'ORDER_DONE' END AS status
FROM orders LEFT JOIN (
  SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS r, max(CASE WHEN l_returnflag = 'R' THEN l_linestatus END) AS rs,
    max(CASE WHEN l_returnflag = 'N' THEN l_partkey END) AS n, min(CASE WHEN l_returnflag = 'N' THEN l_linestatus END) AS ns,
    max(CASE WHEN l_returnflag = 'A' THEN l_partkey END) AS a
  FROM lineitem WHERE l_quantity > 30 GROUP BY l_orderkey) ON l_orderkey = o_orderkey
""")
def waterfall_status(t):
    """Status of the furthest entity that exists and is in a known state."""

    def of(flag, column, pick):
        return pick(F.when(F.col("l_returnflag") == flag, F.col(column)))

    lines = t.lineitem.filter(F.col("l_quantity") > 30).groupBy("l_orderkey").agg(
        of("R", "l_partkey", F.max).alias("r"),
        of("R", "l_linestatus", F.max).alias("rs"),
        of("N", "l_partkey", F.max).alias("n"),
        of("N", "l_linestatus", F.min).alias("ns"),
        of("A", "l_partkey", F.max).alias("a"),
    )
    rows = enrich(t.orders.select("o_orderkey", "o_orderstatus"), lines, {"l_orderkey": "o_orderkey"})
    c = F.col
    pending = F.when(c("o_orderstatus") == "P", c("ns"))
    status = R.waterfall(
        [
            (c("r"), c("rs"), {"O": "RETURN_OPEN", "F": "RETURN_DONE"}),
            (c("n"), c("ns"), {"F": "SHIPPED"}),
            (c("n"), pending, {"O": "SHIPPING"}),
            (c("a"), c("a"), {"*": "ACCEPTED"}),
            (c("o_orderkey"), c("o_orderstatus"), {"O": "ORDER_OPEN", "F": "ORDER_DONE"}),
        ]
    )
    return rows.select("o_orderkey", status.alias("status"))


@query("""
SELECT event_id, CASE WHEN d < 1 THEN '0' WHEN d < 2 THEN '1' WHEN d < 5 THEN '2_5' WHEN d >= 5 THEN '5+' END AS spread,
  CASE WHEN round(d, 0) < 14 THEN 'New' ELSE 'Old' END AS new_old
FROM (SELECT event_id, (1706659200000 - epoch_us(ts) // 1000) / 86400000::DOUBLE AS d FROM events)
""")
def age_buckets(t):
    """Age of an event at a fixed instant, in buckets."""
    days = (F.lit(1_706_659_200_000) - ntz_ms("ts")) / F.lit(DAY_MS)
    return t.events.select(
        "event_id",
        R.spread(days).alias("spread"),
        F.when(F.round(days, 0) < 14, "New").otherwise("Old").alias("new_old"),
    )
