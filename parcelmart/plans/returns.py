"""The returns mart: each return request with its reverse shipment, refund and replacement."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.functions import rules as R
from parcelmart.functions.text import json_fields, json_text
from parcelmart.functions.times import (
    DAY,
    DAY_MS,
    DAY_TIME,
    days_between,
    ist_date,
    ist_format,
    ist_ms,
    ms_of,
    parse_time,
)
from parcelmart.operators.collect import gather
from parcelmart.operators.fold import Figure, First, Last, count, fold, merge, newest
from parcelmart.operators.lookup import DEALT, deal, enrich
from parcelmart.operators.pack import Chain, Put, columns_read, completed, pack, unstaged
from parcelmart.operators.publish import discard, stage
from parcelmart.operators.rows import current_rows, latest
from parcelmart.operators.timeline import count_when, first_when, last_when
from parcelmart.params import RunParams
from parcelmart.plans import vendors as V

Tables = Mapping[str, DataFrame]

# A seller with more settled returns than this counts as mature.
MATURE_RETURNS = 3
SETTLED = ("REJECTED", "COMPLETE", "APPROVED")
PICKUP_PROMISE_DAYS = 4
# Days between (ready to ship + grace) and the first pickup attempt that still count as in time.
ATTEMPT_GRACE_DAYS = 2
ATTEMPT_LIMIT_DAYS = 2
# Shown where the replacement has no shipment (fixed value).
NO_SHIPMENT = "order_status"

# What the mart reads of the shipment mart, of the forward shipment and of the replacement's.
OF_FORWARD = """
    fm_service seller_city seller_state seller_pincode seller_mobile_number seller_address buyer_city buyer_state
    buyer_pincode buyer_mobile_number buyer_address category sub_category vertical lane weight shipment_amount
    logistics_amount payment_mode
""".split()
OF_FORWARD_RENAMED = {
    "fwd_order_id": "seller_order_id",
    "fwd_vendor": "vendor",
    "fwd_awb_number": "awb_number",
    "fwd_listing_titles": "listing_title",
    "fwd_order_date": "order_date",
    "fwd_rts": "rts_date",
    "fwd_shipped": "first_shipped_date",
    "fwd_rto": "rto_date",
    "fwd_del": "del_date",
    "fwd_promise": "fwd_promise_date",
    "slc_promise": "slc_promise_at",
}
OF_REPLACEMENT = {
    "return_shipment_id": "shipment_group_id",
    "return_shipment_amount": "shipment_amount",
    "return_logistics_amount": "logistics_amount",
    "return_awb_number": "awb_number",
    "return_listing_titles": "listing_title",
    "return_vendor": "vendor",
    "return_order_type": "order_type",
    "return_order_date": "order_date",
    "return_rts_date": "rts_date",
    "return_shipped_date": "first_shipped_date",
    "return_delivered_date": "del_date",
}
SHIPMENT_COLUMNS = tuple(dict.fromkeys((*OF_FORWARD, *OF_FORWARD_RENAMED.values(), *OF_REPLACEMENT.values())))


def first_requests(t: Tables) -> DataFrame:
    """First version of each request."""
    return t["ds_sqls_returns"].groupBy("return_id").agg(F.min("created_at").alias("requested_at"))


def request_log(t: Tables) -> DataFrame:
    """Approval, cancellation, rejection and dispute times out of the return transition log."""
    value, at = F.col("new_value"), F.col("created_at")
    dispute = (F.col("attribute") == "dispute") & (value == "true")
    log = t["ds_sqls_return_state_transitions"].filter(value.isin("APPROVED", "CANCELLED", "REJECTED") | dispute)
    return log.groupBy("return_id").agg(
        first_when(value == "APPROVED", at).alias("approved_at"),
        first_when(value == "CANCELLED", at).alias("request_cancelled_ms"),
        first_when(value == "REJECTED", at).alias("rejected_at"),
        last_when(dispute, at).alias("disputed_at"),
    )


def refund_conversions(t: Tables) -> DataFrame:
    """Last conversion to refund by each person who made one."""
    log = t["ds_sqls_return_state_transitions"].filter(F.col("new_value") == "REFUND")
    return log.groupBy("return_id", F.col("created_by").alias("refund_converted_by")).agg(
        F.max("created_at").alias("converted_at")
    )


def reverse_events(t: Tables) -> DataFrame:
    """Reported event times of shipments, and when the delivery was marked."""
    state, at = F.col("state"), F.col("reported")
    states = ("SHIPMENT_RAD", "SHIPMENT_IN_TRANSIT", "SHIPMENT_RTO", "SHIPMENT_DELIVERED", "SHIPMENT_CANCELLED")
    log = t["ds_sqls_shipment_group_metadata"].filter((F.col("key_attrib") == "event_time") & state.isin(*states))
    log = log.withColumn("reported", ms_of("value"))
    return log.groupBy("shipment_group_id").agg(
        first_when(state == "SHIPMENT_RAD", at).alias("first_arrived"),
        first_when(state == "SHIPMENT_IN_TRANSIT", at).alias("first_shipped"),
        first_when(state == "SHIPMENT_RTO", at).alias("first_rto"),
        last_when(state == "SHIPMENT_DELIVERED", at).alias("delivered_at"),
        last_when(state == "SHIPMENT_DELIVERED", F.col("created_at")).alias("delivery_marked_at"),
        last_when(state == "SHIPMENT_CANCELLED", at).alias("shipment_cancelled_at"),
    )


def ready_to_ship(t: Tables) -> DataFrame:
    log = t["ds_sqls_shipment_group_state_transition"].filter(F.col("new_state") == "SHIPMENT_RTS")
    return log.groupBy("shipment_group_id").agg(
        F.min("created_at").alias("first_rts"), F.max("created_at").alias("last_rts")
    )


def reverse_shipments(t: Tables) -> DataFrame:
    """Live shipments with status, waybill and vendor, and the logs of those that are live."""
    live = current_rows(t["ds_sqls_shipment_group"]).select(
        "shipment_group_id",
        F.col("shipment_status").alias("rev_current_status"),
        F.col("awb_number").alias("rev_awb_number"),
        "third_party_provider_id",
    )
    by_shipment = {"shipment_group_id": "shipment_group_id"}
    rows = enrich(live, ready_to_ship(t), by_shipment)
    rows = enrich(rows, reverse_events(t), by_shipment)
    return enrich(rows, t["ds_sqls_orgs"], {"org_id": "third_party_provider_id"}, {"rev_vendor": "display_name"})


def scan_states(t: Tables) -> tuple[DataFrame, dict[str, Figure]]:
    """The vendor scan log, read once: states of all its figures per shipment and waybill."""
    c = F.col
    code, at = c("status_external"), c("date_time")
    ready = c("status_internal") == "SHIPMENT_RTS"
    figures: dict[str, Figure] = {
        "ready": newest(at, {"awb": c("awb")}, ready),
        "failure": newest(at, {"ndr_reason": c("comment")}, code == V.PICKUP_SCHEDULED),
    }
    for group, attempt in V.PICKUP_ATTEMPT_CODES.items():
        figures[f"first_{group}"] = First(at, code == attempt)
        figures[f"last_{group}"] = Last(at, code == attempt)
        figures[f"attempts_{group}"] = count(code == attempt)
    keys = ["shipment_group_id", "awb"]
    return stage(fold(t["ds_sqls_vendor_shipment_details"], keys, figures, present=["shipment_group_id"])), figures


def reschedules(t: Tables, states: DataFrame) -> DataFrame:
    """Distinct waybills a return was made ready under."""
    links = t["ds_sqls_return_items"].select("return_id", "return_shipment_id").distinct()
    scans = states.filter(F.col("ready").isNotNull()).select("shipment_group_id", "awb")
    rows = enrich(links, scans, {"shipment_group_id": "return_shipment_id"}, {"awb": "awb"}, how="inner")
    rows = rows.select("return_id", "return_shipment_id", "awb").distinct()
    return rows.groupBy("return_id").agg(F.count("awb").alias("reschedule_count"))


def pickup_attempts(t: Tables, states: DataFrame, figures: dict[str, Figure]) -> DataFrame:
    """First and last pickup attempt per reverse shipment, by the code of its vendor."""
    times = {n: f for n, f in figures.items() if n.startswith(("first_", "last_"))}
    scans = merge(states.filter(F.coalesce(*times).isNotNull()), ["shipment_group_id"], times)
    # Only shipments of returns that are live count.
    live = current_rows(t["ds_sqls_returns"]).select("return_id").distinct()
    of_return = t["ds_sqls_return_items"].join(live, "return_id", "left_semi").select("return_shipment_id").distinct()
    return scans.join(of_return, scans["shipment_group_id"] == of_return["return_shipment_id"], "left_semi")


def pickup_attempt_counts(t: Tables, states: DataFrame, figures: dict[str, Figure]) -> DataFrame:
    """Pickup attempts on the latest waybill of each reverse shipment, per shipment they were scanned for."""
    c = F.col
    current = merge(states.filter(c("ready").isNotNull()), ["shipment_group_id"], {"ready": figures["ready"]}).select("shipment_group_id", "ready.awb")
    of_return = t["ds_sqls_return_items"].select("return_shipment_id").distinct()
    current = enrich(
        of_return, current, {"shipment_group_id": "return_shipment_id"}, {"current_awb": "awb"}, how="inner"
    )
    names = [f"attempts_{group}" for group in V.PICKUP_ATTEMPT_CODES]
    counted = states.filter(reduce(lambda a, b: a | b, [c(n) > 0 for n in names]))
    # Only the different counts under a waybill matter, so they are reduced to those before the join:
    # a placeholder waybill on very many shipments still is one row.
    per_awb = counted.groupBy("awb").agg(*[F.collect_set(F.when(c(n) > 0, c(n))).alias(n) for n in names])
    rows = enrich(current, per_awb, {"awb": "current_awb"}, {n: n for n in names}, how="inner")
    # Each count of one code goes with each count of the other.
    for n in names:
        rows = rows.withColumn(n, F.explode_outer(n))
    return rows.drop("current_awb")


def pickup_failures(states: DataFrame, figures: dict[str, Figure]) -> DataFrame:
    """Comment of the latest rescheduled pickup."""
    rows = merge(states.filter(F.col("failure").isNotNull()), ["shipment_group_id"], {"failure": figures["failure"]})
    return rows.select("shipment_group_id", "failure.ndr_reason")


def reverse_hub_tasks(t: Tables) -> DataFrame:
    """First hub in-scan, first and last run out and number of runs."""
    state, at = F.col("hub_task_state"), F.col("updated_at")
    log = t["ds_sqls_hub_task"].filter(state.isin("IN_SCAN", "OUT_SCAN"))
    out = state == "OUT_SCAN"
    return log.groupBy("shipment_id").agg(
        first_when(state == "IN_SCAN", at).alias("hub_in_at"),
        first_when(out, at).alias("first_out_at"),
        last_when(out, at).alias("last_out_at"),
        count_when(out).alias("lm_rvp_attempt"),
    )


def seller_maturity(t: Tables) -> DataFrame:
    settled = current_rows(t["ds_sqls_returns"]).filter(F.col("state").isin(*SETTLED))
    label = F.when(F.count("return_id") > MATURE_RETURNS, "Mature").otherwise("New")
    return settled.groupBy("seller_id").agg(label.alias("seller_maturity"))


def undelivered_reasons(t: Tables) -> DataFrame:
    failed = t["ds_sqls_delivery_task"].filter(F.col("state") == "COMPLETE_REATTEMPT")
    return gather(failed, ["shipment_id"], "comments", "rvp_undel_reason")


def order_states(t: Tables) -> DataFrame:
    """Latest state of each order."""
    log = t["ds_sqls_seller_order_state_transition"].select(
        "order_id", "created_at", F.col("new_state").alias("replacement_status")
    )
    return latest(log, ["order_id"], "created_at").drop("created_at")


def account_details(document: str) -> list[Column]:
    """Bank account of a buyer in one text, and its holder."""
    number, code, bank, kind, holder = json_fields(
        document,
        {
            "number": "$.bank_detail.account_number[0]",
            "ifsc": "$.bank_detail.ifsc_code",
            "bank": "$.bank_detail.bank_name",
            "kind": "$.bank_detail.acc_type",
            "holder": "$.bank_detail.acc_holder_name[0]",
        },
    )
    text = F.concat(
        F.lit("Account_Number- "),
        number,
        F.lit(", IFSC_Code- "),
        code,
        F.lit(", Bank Name- "),
        bank,
        F.lit(", Account_Type- "),
        kind,
    )
    return [text, holder]


#: What the lookups go by; the rest is left out of what is staged unless it is read.
KEYS = frozenset(
    "return_id repayment_mode seller_id buyer_id fwd_shipment_id repay_id rev_shipment_id return_shipment_id lane".split()
)


def _looked_up(
    t: Tables, shipments: DataFrame, scans: tuple[DataFrame, dict[str, Figure]], put: Put, read: Collection[str] | None
) -> DataFrame:
    """Live returns with all that is looked up for them; ``read`` names the columns that are read of the result (default: all).

    ``put`` may stage what is looked up, and the rows on their way, so that the logs of few lookups are on disk at a time.
    """
    c = F.col
    chain = Chain(put, read, KEYS)
    states, figures = scans
    rows = current_rows(t["ds_sqls_returns"]).select(
        "return_id",
        c("state").alias("current_status"),
        "seller_id",
        "buyer_id",
        c("repay_mode").alias("repayment_mode"),
        "reverse_pickup_required",
        (c("return_goods_value_paise") / 100).alias("return_goods_value"),
        "repay_id",
        c("raised_dispute").alias("dispute_flag"),
        c("shipment_id").alias("fwd_shipment_id"),
        c("reason").alias("return_reason"),
        "non_listed_items",
    )
    # Keyed by return.
    by_return = {"return_id": "return_id"}
    items = t["ds_sqls_return_items"].select(
        "return_id", c("return_shipment_id").alias("rev_shipment_id"), c("created_at").alias("item_created_at")
    ).distinct()
    actions = t["npr_data2"].select(
        "return_id", c("npr_date").alias("npr_action_date"), c("comment").alias("npr_action"), c("type").alias("npr_bucket_type")
    )
    of_return = (first_requests(t), request_log(t), refund_conversions(t), reschedules(t, states), actions, items)
    rows = chain.add(rows, pack(rows.select("return_id"), "return_id", [(log, "return_id") for log in of_return]), by_return)
    rows = chain.cut(rows)
    # Keyed by the reverse shipment, which returns without pickup have not: their rows are spread.
    ids = rows.select("rev_shipment_id")
    live_tasks = current_rows(t["ds_sqls_hub_task"]).select("shipment_id", "hub_task_state").distinct()
    packs = (
        [(reverse_shipments(t), "shipment_group_id")],
        [
            (pickup_attempts(t, states, figures), "shipment_group_id"),
            (pickup_attempt_counts(t, states, figures), "return_shipment_id"),
            (pickup_failures(states, figures), "shipment_group_id"),
        ],
        [
            (reverse_hub_tasks(t), "shipment_id"),
            (undelivered_reasons(t), "shipment_id"),
            (live_tasks, "shipment_id", {"rev_hub_status": "hub_task_state"}),
        ],
    )
    rows, dealt = deal(rows, ["rev_shipment_id"])
    for lookups in packs:
        rows = chain.add(rows, pack(ids, "rev_shipment_id", lookups), {"rev_shipment_id": "rev_shipment_id"}, dealt=dealt)
    rows = chain.cut(rows.drop(DEALT))
    # Keyed by the forward shipment.
    of_forward = {**{n: n for n in OF_FORWARD}, **OF_FORWARD_RENAMED}
    rows = enrich(rows, shipments, {"shipment_group_id": "fwd_shipment_id"}, of_forward)
    # Keyed by what was given for the return: a refund, or a replacement order.
    is_replacement, is_refund = c("repayment_mode") == "REPLACEMENT", c("repayment_mode") == "REFUND"
    rows, dealt = deal(rows, ["repay_id"])
    rows = enrich(rows, shipments, {"seller_order_id": "repay_id"}, OF_REPLACEMENT, when=is_replacement, dealt=dealt)
    by_order = {"order_id": "repay_id"}
    rows = chain.add(rows, order_states(t), by_order, when=is_replacement, dealt=dealt)
    refunds = current_rows(t["ds_sqls_refund_line"])
    paid = {"refund_amount": c("refund_amount_paise") / 100}
    rows = chain.add(rows, refunds, {"refund_line_id": "repay_id"}, paid, when=is_refund, dealt=dealt)
    holds = t["ds_sqls_seller_order"].select(
        "order_id", *json_fields("extra_data", {"hold_reason": "$.hold_reason", "hold_till": "$.hold_till_millis"})
    ).distinct()
    rows = chain.add(rows, holds, by_order, dealt=dealt)
    rows = chain.cut(rows.drop(DEALT))
    live = current_rows(t["ds_sqls_shipment_group"])
    rows = chain.add(rows, live, {"shipment_group_id": "return_shipment_id"}, {"replacement_shipment_status": "shipment_status"})
    # Dimensions.
    account, holder = account_details("data")
    rows = chain.add(rows, t["ds_sqls_orgs"], {"org_id": "seller_id"}, {"seller_name": "display_name"})
    rows = chain.add(rows, seller_maturity(t), {"seller_id": "seller_id"})
    rows = chain.cut(rows)
    rows = enrich(
        rows,
        t["ds_sqls_orgs"],
        {"org_id": "buyer_id"},
        {"buyer_name": "display_name", "account_details": account, "account_holder_name": holder},
    )
    return enrich(rows, t["ds_sqls_lane_sla"].distinct(), {"zone": "lane"}, {"max_sla": "sla_max"})


def _finished(rows: DataFrame, p: RunParams) -> DataFrame:
    """The mart's columns of the joined rows."""
    c = F.col
    is_replacement = c("repayment_mode") == "REPLACEMENT"
    today = F.lit(p.today_ms)
    state, group = c("current_status"), V.vendor_group(c("rev_vendor"))
    # One of the two vendors of the second group has pickups.
    picks_up = {"delhivery": group == "delhivery", "ecom": c("rev_vendor") == V.ECOM[0]}

    def by_vendor(pattern: str) -> Column:
        return F.when(picks_up["delhivery"], c(pattern.format("delhivery"))).when(picks_up["ecom"], c(pattern.format("ecom")))

    day = lambda ms: ist_format(ms, DAY)
    shown = lambda ms: ist_format(ms, DAY_TIME)
    first_attempt = by_vendor("first_{}")
    grace_left = F.datediff(F.date_add(ist_date("last_rts"), ATTEMPT_GRACE_DAYS), ist_date(first_attempt))
    pending_days = F.when(state == "CONFIRMATION_PENDING", (today - ist_ms("requested_at")) / F.lit(DAY_MS))
    resolved_days = F.when(state == "APPROVED", days_between("approved_at", "requested_at"))
    way_back_days = F.when(c("delivered_at").isNotNull(), days_between("delivered_at", "first_shipped"))
    replacement_days = F.datediff(
        F.to_date(parse_time("return_delivered_date", DAY)), F.to_date(parse_time("return_shipped_date", DAY))
    ).cast("double")
    pick_up_days = days_between("first_shipped", "first_rts")
    same = """
        return_id current_status seller_id seller_name seller_maturity buyer_id buyer_name account_details account_holder_name
        repayment_mode refund_converted_by reverse_pickup_required refund_amount return_goods_value repay_id dispute_flag
        fwd_shipment_id max_sla return_reason non_listed_items rev_shipment_id reschedule_count rev_vendor rev_awb_number
        rev_current_status rev_hub_status rvp_undel_reason ndr_reason npr_action_date npr_action npr_bucket_type hold_reason
    """.split()
    return rows.select(
        *same,
        *OF_FORWARD,
        *OF_FORWARD_RENAMED,
        *OF_REPLACEMENT,
        F.when(c("converted_at").isNotNull(), "REFUND").alias("current_repay_mode"),
        day("converted_at").alias("refund_conversion_date"),
        day("disputed_at").alias("dispute_date"),
        day("requested_at").alias("request_created_at"),
        day("approved_at").alias("request_approved_at"),
        day("request_cancelled_ms").alias("request_cancelled_at"),
        day("rejected_at").alias("request_rejected_at"),
        F.datediff(F.lit(p.today), ist_date("requested_at")).alias("request_aging"),
        resolved_days.alias("resolution_time"),
        F.round((today - ist_ms("last_rts")) / F.lit(DAY_MS), 0).alias("rev_aging"),
        F.when((state != "CONFIRMATION_PENDING") | state.isNull(), day("item_created_at")).alias("rev_created_at"),
        shown("last_rts").alias("rev_rts_date"),
        F.date_format(F.date_add(ist_date("last_rts"), PICKUP_PROMISE_DAYS), DAY).alias("rev_pickup_promise_date"),
        F.when(grace_left <= ATTEMPT_LIMIT_DAYS, "within").otherwise("outside").alias("pick_attempt_breach"),
        shown(first_attempt).alias("rev_fpa_date"),
        shown(by_vendor("last_{}")).alias("rev_lpa_date"),
        shown("first_arrived").alias("rad_date"),
        by_vendor("attempts_{}").alias("rev_attempt_count"),
        day("first_shipped").alias("rev_shipped_date"),
        day("shipment_cancelled_at").alias("cancelled_at"),
        day("first_rto").alias("rev_rto_date"),
        day("hub_in_at").alias("rev_inscan_date"),
        day("first_out_at").alias("rev_first_ofd_date"),
        day("last_out_at").alias("rev_last_ofd_date"),
        day("delivered_at").alias("rev_del_date"),
        day("delivery_marked_at").alias("rev_del_mark_date"),
        F.coalesce("lm_rvp_attempt", F.lit(0)).alias("lm_rvp_attempt"),
        day(ms_of("hold_till")).alias("hold_till_date"),
        F.when(is_replacement, c("repay_id")).alias("return_order_id"),
        F.when(is_replacement, c("replacement_status")).alias("return_order_current_status"),
        F.coalesce("replacement_shipment_status", F.lit(NO_SHIPMENT)).alias("return_shipment_current_status"),
        R.spread(pending_days).alias("pendency_spread"),
        R.spread(resolved_days).alias("resolution_spread"),
        R.sla_flag(way_back_days <= c("max_sla")).alias("rev_sla_met"),
        R.sla_flag(replacement_days <= c("max_sla")).alias("return_sla_met"),
        way_back_days.alias("rev_s2d"),
        F.when(pick_up_days < 0, F.lit(0.0)).otherwise(pick_up_days).alias("rev_pick_up_time"),
        replacement_days.alias("return_s2d"),
    )


def returns(
    t: Tables, p: RunParams, shipments: DataFrame, only: Sequence[str] | None = None, put: Put = unstaged
) -> DataFrame:
    """One row per live return request and reverse shipment.

    ``only`` names the columns that are read of the mart (all by default): the rows are the distinct rows of these. With
    ``put=stage`` what is looked up is staged on the way, as far as it is read.
    """

    def finished(rows: DataFrame) -> DataFrame:
        done = _finished(rows, p)
        return (done.select(*only) if only else done).distinct()

    scans = scan_states(t)
    draft = _looked_up(t, shipments, scans, unstaged, None)
    if put is unstaged:
        return finished(draft)
    done = finished(completed(_looked_up(t, shipments, scans, put, columns_read(draft, finished)), draft))
    discard(scans[0])
    return done
