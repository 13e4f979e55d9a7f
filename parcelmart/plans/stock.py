"""Warehouse stock: each item from receipt to dispatch."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.functions.rules import waterfall
from parcelmart.functions.text import json_text, part_of
from parcelmart.functions.times import ISO_TIME, ist_format, ms_of
from parcelmart.operators.lookup import DEALT, deal, enrich
from parcelmart.operators.pack import Chain, Put, columns_read, completed, part, unstaged
from parcelmart.operators.publish import discard
from parcelmart.operators.rows import current_rows, latest

# Kinds of warehouse document, told by their id (fixed values).
RESERVATION_DOC = "FRES"
PUTLIST_DOC = "PUL"
PICKLIST_DOC = "PIL"
DISPATCH_DOC = "DOO"

# Status labels by entity state, from the last step of the flow to the first (fixed values).
OUTWARD_STATUS = {"DISPATCHED": "DISPATCHED", "DISPATCHING": "DISPATCHING"}
PICKLIST_STATUS = {
    "PICKED": "PICKLIST_PICKED",
    "PICKING": "PICKLIST_PICKING",
    "DISPATCHED": "PICKLIST_DISPATCHED",
    "CREATED": "PICKLIST_CREATED",
}
RESERVATION_STATUS = {
    "RESERVED": "RESERVED",
    "REQUESTED": "RESERVATION_REQUESTED",
    "CANCELLED": "RESERVATION_CANCELLED",
}
PUTLIST_STATUS = {"SUGGESTED": "PUTLIST_SUGGESTED", "STOCKED": "PUTLIST_STOCKED"}
INWARD_STATUS = {
    "STOCKED": "INWARD_NOTE_STOCKED",
    "STOCKING": "INWARD_NOTE_STOCKING",
    "ABANDONED": "INWARD_NOTE_ABANDONED",
}
REJECT_STATUS = {"*": "REJECTED"}
RECEIVE_STATUS = {
    "PROCESSED": "RECEIVE_ORDER_PROCESSED",
    "ACCEPTED": "RECEIVED_ORDER_ACCEPTED",
    "CANCELLED": "RECEIVE_ORDER_CANCELLED",
}


def received_items(t: Mapping[str, DataFrame]) -> DataFrame:
    """Items on reject notes and on inward notes, one shape for both."""
    nothing = F.lit(None).cast("string")
    rejected = t["ds_sqls_wh_stock_reject_note"].select(
        "receive_order_id", F.col("id").alias("reject_order_note"), nothing.alias("inward_order_note"), F.col("id").alias("note_id")
    )
    inwarded = t["ds_sqls_wh_stock_inward_note"].select(
        "receive_order_id", nothing.alias("reject_order_note"), F.col("id").alias("inward_order_note"), F.col("id").alias("note_id")
    )
    rows = rejected.unionByName(inwarded)
    rows = enrich(rows, t["ds_sqls_wh_document_skuitems"], {"document_id": "note_id"}, {"sku_item_id": "sku_item_id"})
    rows = enrich(
        rows,
        t["ds_sqls_wh_inventory_skuitems"],
        {"sid": "sku_item_id"},
        {"sku_id": "sku_id", "sku_item_state": "state", "sku_item_created": "created_at", "sku_item_updated": "updated_at"},
    )
    rows = enrich(
        rows,
        t["ds_sqls_wh_inventory_sku"],
        {"id": "sku_id"},
        {"sku_name": "name", "sku_wt": "capacity_consumed", "sku_storage_profile": "storage_profile"},
    )
    return rows.drop("note_id").distinct()


def put_away(t: Mapping[str, DataFrame]) -> DataFrame:
    """Latest putlist of each stocked item, with its inward note."""
    rows = t["ds_sqls_wh_stock_inward_note"].select(
        F.col("id").alias("inward_note_id"),
        F.col("created_at").alias("inward_created_at"),
        F.col("updated_at").alias("inward_updated_at"),
        F.col("state").alias("inward_note_state"),
    )
    rows = enrich(rows, t["ds_sqls_wh_document_skuitems"], {"document_id": "inward_note_id"}, {"item": "sku_item_id"})
    # Only items in the inventory are ranked: a missing id can match no item later.
    inventory = t["ds_sqls_wh_inventory_skuitems"].select("sid").distinct()
    rows = enrich(rows, inventory, {"sid": "item"}, {"sku_item_id": "sid"}, how="inner").drop("item")
    listed = t["ds_sqls_wh_puttables_pickables"].filter(F.col("document_id").contains(PUTLIST_DOC))
    rows = enrich(rows, listed, {"skuitem_id": "sku_item_id"}, {"putlist_id": "document_id"})
    rows = enrich(
        rows,
        t["ds_sqls_wh_putlist"],
        {"putlist_id": "putlist_id"},
        {
            "putlist_created_at": "created_at",
            "putlist_processed_at": "updated_at",
            "putlist_state": "state",
            "putlist_type": "type",
        },
    )
    return latest(rows, ["sku_item_id"], "putlist_created_at")


def sent_out(t: Mapping[str, DataFrame]) -> DataFrame:
    """Latest reservation of each item, with the picklist, dispatch order and outward note behind it."""
    reserved = t["ds_sqls_wh_document_skuitems"].filter(F.col("document_id").contains(RESERVATION_DOC))
    rows = enrich(
        reserved.select("sku_item_id", "document_id"),
        t["ds_sqls_wh_sku_reservation"],
        {"id": "document_id"},
        {
            "reservation_id": "id",
            "reservation_state": "state",
            "reservation_created": "created_at",
            "reservation_updated": "updated_at",
        },
    )
    # Ranked before the documents of all the item's reservations multiply the rows.
    rows = latest(rows, ["sku_item_id"], "reservation_created")
    picked = t["ds_sqls_wh_puttables_pickables"].filter(F.col("document_id").contains(PICKLIST_DOC))
    rows = enrich(rows, picked, {"skuitem_id": "sku_item_id"}, {"picklist_doc": "document_id"})
    rows = enrich(
        rows,
        t["ds_sqls_wh_picklist"],
        {"picklist_id": "picklist_doc"},
        {
            "picklist_id": "picklist_id",
            "picklist_created": "created_at",
            "picklist_updated": "updated_at",
            "picklist_type": "type",
            "picklist_state": "state",
        },
    )
    ordered = t["ds_sqls_wh_sku_quantities"].filter(F.col("document_id").startswith(DISPATCH_DOC))
    rows = enrich(rows, ordered, {"reservation_id": "document_id"}, {"dispatch_doc": "document_id"})
    rows = enrich(
        rows,
        t["ds_sqls_wh_dispatch_order"],
        {"id": "dispatch_doc"},
        {
            "dispatch_order": "id",
            "do_type": "type",
            "do_state": "state",
            "dispatch_order_created": "created_at",
            "dispatch_order_updated": "updated_at",
        },
    )
    rows = enrich(
        rows,
        t["ds_sqls_wh_stock_outward_note"],
        {"document_id": "dispatch_doc"},
        {
            "outward_note": "id",
            "outward_note_type": "type",
            "outward_note_created": "created_at",
            "outward_note_updated": "updated_at",
            "outward_note_state": "state",
        },
    )
    rows = rows.drop("document_id", "picklist_doc", "dispatch_doc")
    newest = F.struct("outward_note_created", "picklist_created", "dispatch_order_created")
    return latest(rows, ["sku_item_id"], newest)


def picked_up(t: Mapping[str, DataFrame]) -> DataFrame:
    """Last completed pickup per shipment."""
    done = t["ds_sqls_pickup_task"].filter(F.col("state") == "PICKED_UP")
    return done.groupBy("shipment_id").agg(F.max("updated_at").alias("picked_up_at"))


def first_transport_leg(t: Mapping[str, DataFrame]) -> DataFrame:
    legs = t["ds_sqls_shipment_execution"].filter(F.col("leg_type") == "TRANSPORT")
    legs = legs.select("shipment_id", "sequence_number", F.col("from_org_unit_id").alias("first_hub"))
    return latest(legs, ["shipment_id"], "sequence_number", ascending=True).drop("sequence_number")


def delivered(t: Mapping[str, DataFrame]) -> DataFrame:
    log = t["ds_sqls_shipment_group_metadata"]
    log = log.filter((F.col("key_attrib") == "event_time") & (F.col("state") == "SHIPMENT_DELIVERED"))
    return log.groupBy("shipment_group_id").agg(F.max(ms_of("value")).alias("delivered_at"))


def ordered(t: Mapping[str, DataFrame]) -> DataFrame:
    """Order lines by reservation, with the order, its shipment and how far that got: looked up while rows are narrow."""
    rows = current_rows(t["ds_sqls_seller_order_line"]).select(
        json_text("misc_info", "$.ff_res_id").alias("reserved_as"), F.col("seller_order_id").alias("order_id")
    )
    rows = enrich(
        rows.filter(F.col("reserved_as").isNotNull()),
        current_rows(t["ds_sqls_seller_order"]),
        {"order_id": "order_id"},
        {"so_id": "order_id", "order_status": "order_status", "so_created": "created_at"},
    )
    rows = enrich(
        rows,
        current_rows(t["ds_sqls_shipment_group"]),
        {"seller_order_id": "so_id"},
        {"shipment_group_id": "shipment_group_id"},
    )
    # Lines without a shipment, or a shipment without a hub, find nothing from there on.
    rows, dealt = deal(rows, ["shipment_group_id"])
    rows = enrich(rows, picked_up(t), {"shipment_id": "shipment_group_id"}, dealt=dealt)
    rows = enrich(rows, first_transport_leg(t), {"shipment_id": "shipment_group_id"}, dealt=dealt)
    rows = enrich(rows, delivered(t), {"shipment_group_id": "shipment_group_id"}, dealt=dealt).drop(DEALT)
    rows, dealt = deal(rows, ["first_hub"])
    hub = {"tc_hub": "unit_name", "hub_org_unit_id": "org_unit_id"}
    return enrich(rows, t["ds_sqls_org_units"], {"org_unit_id": "first_hub"}, hub, dealt=dealt).drop(DEALT)


#: What the lookups go by; the rest is left out of what is staged unless it is read.
KEYS = frozenset("receive_order_id reject_order_note sku_item_id sku_id reservation_id".split())


def _looked_up(t: Mapping[str, DataFrame], put: Put, read: Collection[str] | None) -> DataFrame:
    """Received items with all that is looked up for them; ``read`` names the columns that are read of the result (default: all).

    What has several steps is looked up for the narrow side first: the warehouse and seller of a receive order, the order behind
    a reservation, the listing of a sku. ``put`` may stage these and the rows on their way.
    """
    c = F.col
    chain = Chain(put, read, KEYS)
    received = {
        "ro_id": "id",
        "warehouse_id": "wh_id",
        "seller_org_id": "org_id",
        "ro_created": "created_at",
        "ro_updated": "updated_at",
        "receive_order_state": "state",
        "receive_order_type": "type",
    }
    orders = t["ds_sqls_wh_receive_order"].select(*[c(x).alias(out) for out, x in received.items()])
    orders = enrich(orders, t["ds_sqls_wh_warehouse"], {"id": "warehouse_id"}, {"warehouse_name": "name"})
    orders = enrich(orders, t["ds_sqls_orgs"], {"org_id": "seller_org_id"}, {"seller_name": "display_name"})
    rows = chain.cut(received_items(t))
    of_order = {**{out: out for out in received}, "warehouse_name": "warehouse_name", "seller_name": "seller_name"}
    rows = chain.add(rows, orders.withColumn("_order", c("ro_id")), {"_order": "receive_order_id"}, of_order)
    rejected = {"reject_order_state": "state", "rj_created": "created_at", "rj_updated": "updated_at"}
    # Most items are on no reject note, and most have no reservation; they find nothing and lie anywhere.
    rows, dealt = deal(rows, ["reject_order_note"])
    rows = chain.add(rows, t["ds_sqls_wh_stock_reject_note"], {"id": "reject_order_note"}, rejected, dealt=dealt).drop(DEALT)
    rows = chain.cut(rows)
    out, dealt = deal(sent_out(t), ["reservation_id"])
    found = part(ordered(t), ["reserved_as"], put, None if read is None else {*read, *KEYS})
    out = (out if found is None else enrich(out, found, {"reserved_as": "reservation_id"}, dealt=dealt)).drop(DEALT)
    rows = chain.add(rows, put_away(t), {"sku_item_id": "sku_item_id"})
    rows = chain.add(rows, out, {"sku_item_id": "sku_item_id"})
    rows = chain.cut(rows)
    if found is not None and put is not unstaged:
        discard(found)
    listings = t["ds_azure_table_managedffskus_prod"].select(
        "row_key", json_text(c("props")["ListingDetails"], "$[0]", "$.listingId").alias("ListingID")
    )
    listings = enrich(
        listings,
        t["ds_stream_listing"],
        {"listing_id": "ListingID"},
        {
            "Listing_status": "status",
            "Listing_per_unit_price_with_tax": "unit_price_wth_tax",
            "Listing_details": "title",
            "category": "category",
            "sub_category": "sub_category",
            "vertical": "vertical",
        },
    )
    return chain.add(rows, listings, {"row_key": "sku_id"})


def _finished(rows: DataFrame) -> DataFrame:
    """The mart's columns of the joined rows."""
    c = F.col
    status = waterfall(
        [
            (c("outward_note"), c("outward_note_state"), OUTWARD_STATUS),
            (c("picklist_id"), c("picklist_state"), PICKLIST_STATUS),
            (c("reservation_id"), c("reservation_state"), RESERVATION_STATUS),
            (c("putlist_id"), c("putlist_state"), PUTLIST_STATUS),
            (c("inward_note_id"), c("inward_note_state"), INWARD_STATUS),
            (c("reject_order_note"), c("reject_order_state"), REJECT_STATUS),
            (c("ro_id"), c("receive_order_state"), RECEIVE_STATUS),
        ]
    )
    times = {
        "receive_order_created_at": "ro_created",
        "receive_order_updated_at": "ro_updated",
        "reject_order_created": "rj_created",
        "reject_note_updated": "rj_updated",
        "inward_note_created_at": "inward_created_at",
        "inward_updated_at": "inward_updated_at",
        "putlist_created_at": "putlist_created_at",
        "putlist_processed_at": "putlist_processed_at",
        "dispatch_order_created": "dispatch_order_created",
        "dispatch_order_updated": "dispatch_order_updated",
        "order_date": "so_created",
        "tc_picked_up_time": "picked_up_at",
        "del_date": "delivered_at",
        "sku_item_created": "sku_item_created",
        "sku_item_updated": "sku_item_updated",
        "reservation_created": "reservation_created",
        "reservation_updated": "reservation_updated",
        "picklist_created": "picklist_created",
        "picklist_updated": "picklist_updated",
        "outward_note_created": "outward_note_created",
        "outward_note_updated": "outward_note_updated",
    }
    plain = """
        warehouse_id warehouse_name seller_org_id seller_name receive_order_state receive_order_type reject_order_note
        reject_order_state inward_note_id inward_note_state putlist_id putlist_type putlist_state reservation_id order_id
        shipment_group_id order_status tc_hub hub_org_unit_id sku_item_id sku_item_state ListingID Listing_status
        Listing_per_unit_price_with_tax sku_id sku_storage_profile sku_name Listing_details category sub_category vertical
        sku_wt reservation_state picklist_id picklist_type picklist_state outward_note outward_note_type outward_note_state
    """.split()
    return rows.select(
        c("ro_id").alias("receive_order_id"),
        *plain,
        c("dispatch_order").alias("dispatch_order_id"),
        c("do_type").alias("dispatch_order_type"),
        c("do_state").alias("dispatch_order_state"),
        part_of("reservation_id", "-", 1).alias("order_line_id"),
        *[ist_format(source, ISO_TIME).alias(out) for out, source in times.items()],
        status.alias("sku_status"),
    )


def stock(t: Mapping[str, DataFrame], only: Sequence[str] | None = None, put: Put = unstaged) -> DataFrame:
    """One row per received item with where it stands.

    ``only`` names the columns that are read of the mart (all by default): the rows are the distinct rows of these. With
    ``put=stage`` what is looked up is staged on the way, as far as it is read.
    """

    def finished(rows: DataFrame) -> DataFrame:
        done = _finished(rows)
        return (done.select(*only) if only else done).distinct()

    draft = _looked_up(t, unstaged, None)
    if put is unstaged:
        return finished(draft)
    return finished(completed(_looked_up(t, put, columns_read(draft, finished)), draft))
