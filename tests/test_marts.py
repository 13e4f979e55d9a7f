"""All marts from a tiny set of source tables, through a full published run."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from tests.conftest import domain, ist, values

from parcelmart.params import RunParams
from parcelmart.plans import legs as legs_plan
from parcelmart.plans import shipment_logs as logs
from parcelmart.plans.build import build
from parcelmart.plans.returns import pickup_attempt_counts, reschedules, scan_states
from parcelmart.plans.stock import stock

# 2018-09-20, 15:30 IST; the window starts on 2018-07-22.
PARAMS = RunParams.at(datetime(2018, 9, 20, 10), 60)


def event(shipment, state, at, key="event_time", value=None):
    return {
        "shipment_group_id": shipment,
        "state": "SHIPMENT_" + state,
        "created_at": ist(at),
        "key_attrib": key,
        "value": value or str(ist(at)),
    }


def scan(shipment, vendor, code, at, comment="c", internal="SHIPMENT_IN_TRANSIT", location="x", awb=None):
    return {
        "shipment_group_id": shipment,
        "vendor_org_id": vendor,
        "status_external": code,
        "date_time": ist(at),
        "comment": comment,
        "status_internal": internal,
        "location": location,
        "awb": awb,
    }


def shipment(name, order, vendor, status, to="P2", **more):
    return {
        "shipment_group_id": name,
        "current_active": 1,
        "seller_order_id": order,
        "created_at": ist("2018-09-04 12:00"),
        "third_party_provider_id": vendor,
        "shipfrom_org_unit_id": "US",
        "shipto_org_unit_id": "UB",
        "shipfrom_pincode": "P1",
        "shipto_pincode": to,
        "shipment_status": "SHIPMENT_" + status,
        "eta": ist("2018-09-08 09:00"),
        "awb_number": "A" + name,
        "box_details": '{"number_of_boxes":2,"weight_per_box_grams":[1500]}',
        "snapshot": "{}",
        **more,
    }


def order(name, at, status="SELLER_ORDER_OPEN"):
    return {
        "order_id": name,
        "created_at": ist(at),
        "order_type": "B2B",
        "order_status": status,
        "current_active": 1,
        "extra_data": '{"selected_payment_method":"COD","hold_reason":"h"}',
    }


def tables(spark):
    od1, od2, od3, od4 = ("OD" + str(n) * 12 for n in (1, 2, 3, 4))
    address = json.dumps({"city": "Pune", "state": "MH", "pincode": "P1", "address_line1": "a", "address_line2": "b", "address_line3": "c"})
    return domain(
        spark,
        ds_sqls_shipment_group=[
            shipment("S1", od1, "VD", "DELIVERED"),
            shipment("S2", od2, "VE", "RTO", to="P3"),
            shipment("S3", od3, "VO", "IN_TRANSIT"),
            shipment("S1", od1, "VD", "RTS", current_active=0, eta=ist("2018-09-07 09:00")),
            shipment("OLD", od1, "VD", "DELIVERED", created_at=ist("2018-07-21 23:59")),
            shipment("LOST", od1, "VD", "DELIVERED", to="nowhere"),
            shipment("R1", od4, "VD", "DELIVERED"),
        ],
        ds_sqls_orgs=[
            {"org_id": "VD", "display_name": "Delhivery"},
            {"org_id": "VE", "display_name": "ECOM Express"},
            {"org_id": "VO", "display_name": "Own_Express"},
            {"org_id": "OS", "display_name": "Seller", "head_office_org_unit_ref": "US", "created_at": ist("2018-09-01")},
            {
                "org_id": "OB",
                "display_name": "Buyer",
                "user_id_owner": "U1",
                "head_office_org_unit_ref": "UB",
                "created_at": ist("2018-01-01"),
                "data": '{"bank_detail":{"account_number":["9"],"ifsc_code":"I","bank_name":"B","acc_type":"S","acc_holder_name":["H"]}}',
            },
        ],
        ds_sqls_org_units=[
            {"org_unit_id": "US", "org_id": "OS", "unit_address": address, "unit_name": "Seller unit"},
            {
                "org_unit_id": "UB",
                "org_id": "OB",
                "unit_address": '{"city":"agra","state":"UP","pincode":"P2"}',
                "unit_name": "Buyer unit",
                "created_at": ist("2018-08-06 10:00"),
                "data": '{"mobile_number":{"value":"77"}}',
            },
        ],
        ds_sqls_users=[{"user_id": "U1", "mobile_primary": "88"}],
        ds_sqls_logistics_pincode_cluster_master=[{"pincode": "P1", "pick_up_cluster": "K", "current_active": 1}],
        ds_sqls_logistics_route_vsl_master=[
            {"vsl_id": "V1", "pick_up_cluster": "K", "dest_pincode": "P2", "zone": "LU_FAR", "current_active": 1},
            {"vsl_id": "V2", "pick_up_cluster": "K", "dest_pincode": "P3", "zone": "NR", "current_active": 1},
            {"vsl_id": "V3", "pick_up_cluster": "K", "dest_pincode": "P3", "zone": "ZR", "current_active": 0},
        ],
        ds_sqls_logistics_serviceability=[{"route_id": "V1", "serviceability_id": "SV", "service_name": "Sur\tface\r\n", "enabled": 1}],
        ds_sqls_service_providers=[
            {
                "serviceability_id": "SV",
                "service_provider_org_id": "VD",
                "enabled": 1,
                "service_provider_properties": '{"properties":{\n"min_wt":500,"max_wt":"30000","multi_box_enabled":"true"}}',
            }
        ],
        ds_sqls_lane_sla=[{"zone": "LU", "sla_max": 3}, {"zone": "NR", "sla_max": 12}],
        ds_sqls_seller_order=[
            order(od1, "2018-09-03 09:00"),
            order(od2, "2018-08-30 09:00"),
            order(od3, "2018-09-03 09:00", "SELLER_ORDER_DRAFT"),
            order("RP", "2018-09-15 09:00"),
        ],
        ds_sqls_shipment_group_metadata=[
            event("S1", "RTS", "2018-09-05 10:00"),
            event("S1", "RTS", "2018-09-04 10:00", key="other", value="not a time"),
            event("S1", "PACKED", "2018-09-04 08:00"),
            event("S1", "PACKED", "2018-09-04 09:00"),
            event("S1", "IN_TRANSIT", "2018-09-06 10:00"),
            event("S1", "DELIVERED", "2018-09-08 18:00"),
            event("S1", "RTS", "2018-09-05 10:00", key="ops_reason", value="late truck"),
            event("S1", "RTO", "2018-09-05 11:00", key="ops_reason", value="flood"),
            event("S2", "RTS", "2018-09-05 10:00"),
            event("S2", "IN_TRANSIT", "2018-09-05 00:10"),
            event("S2", "RTO", "2018-09-10 10:00"),
            event("R1", "IN_TRANSIT", "2018-09-12 10:00"),
            event("R1", "DELIVERED", "2018-09-16 10:00"),
        ],
        ds_sqls_vendor_shipment_details=[
            scan("S1", "VD", "RAD", "2018-09-07 08:00"),
            scan("S1", "VD", "UD_Dispatched", "2018-09-07 10:00"),
            scan("S1", "VD", "UD_Dispatched", "2018-09-07 20:00"),
            scan("S1", "VD", "UD_Dispatched", "2018-09-08 10:00"),
            scan("S1", "VD", "UD_Pending", "2018-09-07 21:00", comment="Bad Address"),
            scan("S1", "VD", "UD_Pending", "2018-09-08 11:00", comment="Reached maximum attempt count"),
            scan("S2", "VE", "1225", "2018-09-08 10:00", comment="1225 - instructed"),
            scan("S2", "VE", "219", "2018-09-07 10:00", comment="219 - absent"),
            scan("S2", "VE", "003", "2018-09-06 10:00", location="Agra Service Center"),
            scan("S2", "VE", "006", "2018-09-12 10:00", internal="SHIPMENT_RTO"),
            scan("S2", "VE", "6", "2018-09-13 10:00", internal="SHIPMENT_RTO", location="faraway"),
            scan("R1", "VD", "PP_Dispatched", "2018-09-11 10:00", awb="AR1"),
            scan("R1", "VD", "PP_Dispatched", "2018-09-12 09:00", awb="AR1"),
            scan("R1", "VD", "none", "2018-09-10 10:00", internal="SHIPMENT_RTS", awb="AR1"),
            scan("R1", "VD", "none", "2018-09-09 10:00", internal="SHIPMENT_RTS", awb="AR0"),
            scan("R1", "VD", "PP_Scheduled", "2018-09-11 12:00", comment="closed"),
        ],
        ds_csv_ecom_city_map=[{"pincode": "P3", "city": "Agra"}],
        mis_table=[
            {
                "order_id": od1,
                "category": "B",
                "sub_category": "s",
                "unit_qty": 3,
                "total_line_amount": 10.5,
                "listing_title": "pen",
                "listing_id": "L1",
                "order_line_id": "OL1",
                "order_date": datetime(2018, 9, 3).date(),
                "order_status": "open",
                "seller_org_id": "OS",
                "buyer_org_id": "OB",
                "payment_mode": "COD",
            },
            {"order_id": od1, "category": "A", "unit_qty": 1, "total_line_amount": 2.0, "listing_title": "ink", "listing_id": "L2",
             "order_line_id": "OL2", "order_date": datetime(2018, 9, 3).date()},
            {"order_id": od2, "category": "C", "unit_qty": 9, "listing_id": "L2", "order_date": datetime(2018, 1, 1).date()},
        ],
        ds_stream_listing=[{"listing_id": "L1", "config": '{"dtr_config":"direct to retail"}', "status": "LIVE"}],
        ds_sqls_wh_sku_reservation=[{"id": "FRES1-OL1", "state": "RESERVED", "created_at": 1}, {"id": "FRES2-XX1"}],
        ds_sqls_invoice=[
            {"invoice_id": "I1", "invoice_type": "GOODS", "amount_in_paisa": 12345, "created_at": ist("2018-09-04"), "num_of_items": 4, "current_active": 1},
            {"invoice_id": "I2", "invoice_type": "LOGISTIC_SERVICE", "amount_in_paisa": 700, "created_at": ist("2018-09-04"), "buyer_org_id": "OS"},
            {"invoice_id": "I9", "invoice_type": "LOGISTIC_SERVICE", "amount_in_paisa": 1, "created_at": ist("2018-09-04"), "buyer_org_id": "OB"},
        ],
        ds_sqls_invoice_shipment_group_association=[
            {"shipment_group_id": "S1", "invoice_id": "I1", "created_at": ist("2018-09-04")},
            {"shipment_group_id": "S1", "invoice_id": "I2", "created_at": ist("2018-09-04")},
            {"shipment_group_id": "S2", "invoice_id": "I9", "created_at": ist("2018-09-04")},
        ],
        ds_sqls_pickup_task=[
            {"shipment_id": "S1", "state": "PICKED_UP", "updated_at": ist("2018-09-05 20:00"), "hub_org_unit_id": "US"},
            {"shipment_id": "S1", "state": "OUT_FOR_PICKUP", "updated_at": ist("2018-09-05 19:00")},
            {"shipment_id": "S1", "state": "PICKUP_ATTEMPTED", "updated_at": ist("2018-09-05 18:00"), "comments": "shut"},
        ],
        ds_sqls_delivery_task=[
            {"shipment_id": "S2", "state": "OUT_FOR_DELIVERY", "type": "SELLER_RTO_DROP", "updated_at": ist("2018-09-14 10:00"), "comments": "b"},
            {"shipment_id": "S2", "state": "OUT_FOR_DELIVERY", "type": "SELLER_RTO_DROP", "updated_at": ist("2018-09-13 10:00"), "comments": "a"},
            {"shipment_id": "S3", "state": "OUT_FOR_DELIVERY", "type": "DELIVERY", "updated_at": ist("2018-09-08 10:00")},
            {"shipment_id": "R1", "state": "COMPLETE_REATTEMPT", "comments": "nobody", "updated_at": ist("2018-09-15 10:00")},
        ],
        # Legs of S3, in a bag on a trip.
        ds_sqls_shipment_execution=[
            {"shipment_id": "S3", "leg_id": "G1", "leg_type": "FWD_DELIVERY", "state": "DONE", "sequence_number": 2, "created_at": ist("2018-09-06 10:00"),
             "eta": ist("2018-09-09 10:00"), "from_org_unit_id": "US", "to_org_unit_id": "UB", "vendor_org_id": "N1", "current_active": 1},
            {"shipment_id": "S3", "leg_id": "G2", "leg_type": "RTO_DELIVERY", "state": "NEW", "sequence_number": 3, "created_at": ist("2018-09-07 10:00"),
             "from_org_unit_id": "US", "to_org_unit_id": "UB", "vendor_org_id": "N1", "current_active": 1},
            {"shipment_id": "S1", "leg_id": "G3", "leg_type": "PICKUP", "created_at": ist("2018-09-07 10:00"), "current_active": 1},
        ],
        ds_sqls_vendor=[{"vendor_id": "N1", "name": "Own Express"}],
        ds_sqls_vendor_serviceability=[
            {"vendors": '[{"vendorId":"N1","vendorProperties":"{\\"sla\\":\\"2\\"}"}]', "from_pincode": "P1", "to_pincode": "P2"}
        ],
        ds_sqls_shipment_leg_status=[
            {"shipment_id": "S3", "leg_id": "G1", "internal_state": s, "current_active": a, "leg_status_metadata": json.dumps(m)}
            for s, a, m in [
                ("IN_TRANSIT", 0, {"eventTime": str(ist("2018-09-06 12:00"))}),
                ("ATTEMPTED_UNDELIVERED", 0, {"eventTime": str(ist("2018-09-08 12:00")), "attemptCount": "9", "vendorComments": "shut"}),
                ("ATTEMPTED_UNDELIVERED", 0, {"eventTime": str(ist("2018-09-09 12:00")), "attemptCount": "10"}),
                ("DELIVERED", 1, {"eventTime": str(ist("2018-09-10 12:00"))}),
            ]
        ],
        ds_sqls_hub_task=[
            {"shipment_id": "S3", "hub_org_unit_id": "US", "hub_task_state": s, "updated_at": ist(at), "third_party_org_id": tp, "current_active": 0}
            for s, at, tp in [("IN_SCAN", "2018-09-06 08:00", "T"), ("IN_SCAN", "2018-09-06 07:00", None), ("SORT", "2018-09-06 09:00", None)]
        ],
        ds_sqls_location=[{"location_id": "X1", "org_unit_id": "US"}, {"location_id": "X2", "org_unit_id": "UB"}],
        ds_sqls_bag=[
            {"bag_id": "B1", "vendor_id": "N1", "state": s, "source_location_id": "X1", "destination_location_id": "X2", "updated_at": ist(at),
             "properties": '{"bagWeight":2500,"sealIntact":true}', "current_active": a}
            for s, at, a in [("CREATED", "2018-09-06 11:00", 0), ("OUTSCAN", "2018-09-06 13:00", 1)]
        ],
        ds_sqls_bag_shipment_mapping=[
            {"bag_id": "B1", "vendor_id": "N1", "shipment_id": "S3", "shipment_validated": 1, "current_active": 1},
        ],
        ds_sqls_consignment_shipment_mapping=[
            {"consignment_id": "C1", "vendor_id": "N1", "shipment_id": "B1", "shipment_type": "BAG", "current_active": 1, "updated_at": 5}
        ],
        ds_sqls_consignment=[{"consignment_id": "C1", "vendor_id": "N1", "state": "REGISTERED", "updated_at": ist("2018-09-06 14:00")}],
        ds_sqls_cross_dock_hub_task=[
            {"shipment_id": "B1", "hub_org_unit_id": "UB", "state": "IN_SCAN", "updated_at": ist("2018-09-07 06:00")}
        ],
        ds_sqls_trip_tasks=[{"trip_id": "T1", "leg_id": "z", "type": "LINE", "tasks": '[{"consignmentId":"C1"},{"other":"x"}]'}],
        ds_sqls_trip_execution=[{"trip_id": "T1", "from_org_unit_id": "US"}],
        ds_sqls_vehicle_hub_task=[{"ref_id": "T1", "vehicle_id": "H1"}],
        ds_sqls_vehicle=[{"vehicle_id": "H1", "vehicle_number": "MH12"}],
        ds_sqls_trip_leg_status=[{"trip_id": "T1", "state": "ARRIVED_SOURCE", "updated_at": ist("2018-09-06 05:00")}],
        # A return of S1 by R1, replaced by the order of S2.
        ds_sqls_returns=[
            {"return_id": "RT1", "created_at": ist("2018-09-09 10:00"), "current_active": 1, "seller_id": "OS", "buyer_id": "OB", "state": "APPROVED",
             "repay_mode": "REPLACEMENT", "repay_id": od2, "shipment_id": "S1", "return_goods_value_paise": 5000},
            {"return_id": "RT2", "created_at": ist("2018-09-19 10:00"), "current_active": 1, "seller_id": "OS", "buyer_id": "OB",
             "state": "CONFIRMATION_PENDING", "repay_mode": "REFUND", "repay_id": "L9", "shipment_id": "S9"},
            {"return_id": "RT3", "current_active": 0},
        ],
        ds_sqls_return_items=[{"return_id": "RT1", "return_shipment_id": "R1", "created_at": ist("2018-09-09 11:00")}],
        ds_sqls_refund_line=[{"refund_line_id": "L9", "refund_amount_paise": 250, "current_active": 1}, {"refund_line_id": od2, "refund_amount_paise": 1, "current_active": 1}],
        ds_sqls_return_state_transitions=[
            {"return_id": "RT1", "created_at": ist("2018-09-11 22:00"), "new_value": "APPROVED"},
            {"return_id": "RT1", "created_at": ist("2018-09-12 10:00"), "new_value": "REFUND", "created_by": "ann"},
        ],
        ds_sqls_shipment_group_state_transition=[
            {"shipment_group_id": "R1", "new_state": "SHIPMENT_RTS", "created_at": ist("2018-09-10 10:00")},
            {"shipment_group_id": "S1", "new_state": "SHIPMENT_ATTEMPTED_UNDELIVERED", "created_at": ist("2018-09-08 11:00")},
        ],
        ds_sqls_seller_order_state_transition=[
            {"order_id": od2, "created_at": 1, "new_state": "OLD"},
            {"order_id": od2, "created_at": 2, "new_state": "NEW"},
            {"order_id": od1, "created_at": ist("2018-09-03 10:00"), "new_state": "SELLER_ORDER_PROCESSING"},
        ],
        # Two contacts about S1, one without a request, one of another team.
        ds_sqls_support_interactions_v2=[
            {"interaction_id": "N1", "interaction_type": "Chat", "created_at": ist("2018-09-08 10:00"), "interaction_team": "CustomerSupport", "org_id": "OS",
             "post_interaction_data": '{"requests":["SR1","SR2"],"startedAt":' + str(ist("2018-09-08 10:05")) + "}",
             "chat_data": '{"firstMessageAt":"' + str(ist("2018-09-08 09:55")) + '","lastMessageBy":"agent"}'},
            {"interaction_id": "N2", "interaction_type": "IncomingCall", "created_at": ist("2018-09-07 10:00"), "interaction_team": "CustomerSupport",
             "org_id": "OB", "post_interaction_data": "{}"},
            {"interaction_id": "N3", "interaction_type": "IncomingCall", "interaction_team": "Other", "post_interaction_data": '{"requests":["SR1"]}'},
        ],
        ds_sqls_support_requests=[
            {"request_id": "SR1 ", "deleted": 0, "type": "Delay", "subtype": "x", "extra_data": '{"orderId":"' + od1 + '","issueId":"SI1234567"}'},
            {"request_id": "SR2", "deleted": 0, "type": "Return", "extra_data": "[]"},
            {"request_id": "SR2", "deleted": 1, "type": "gone"},
        ],
        ds_sqls_support_issues=[{"issue_id": "SI1234567", "title": "Where is it"}],
        ds_sqls_support_agent_interaction_details=[{"interaction_id": "N1", "agent_id": a} for a in ("a", "b", "a")],
        ds_sqls_support_feedback_requests=[{"feedback_request_id": "F1", "support_request_id": " SR1"}],
        ds_sqls_support_feedback=[{"feedback_request_id": "F1", "answer": "a4b"}],
        ds_sqls_credit_block=[{"reference_id": od1, "amount_blocked_paisa": 1000, "context": '{"runningAccountOrder":true}'}],
        ds_sqls_sellers=[{"org_id": "OS", "status": "ENABLED"}],
        ds_csv_lat_lon=[{"city": "Pune", "lat": "18.5", "lon": "bad"}],
    )


@pytest.fixture(scope="module")
def marts(spark, tmp_path_factory):
    return build(tables(spark), PARAMS, str(tmp_path_factory.mktemp("marts")))


def cells(df, key, value, *columns):
    rows = df.filter(df[key] == value).select(*columns).collect()
    assert len(rows) == 1, rows
    return rows[0].asDict()


def test_lanes(marts):
    assert marts["lanes"].count() == 1
    assert cells(marts["lanes"], "vsl_id", "V1", "service", "vendor", "weight_range", "shipping_details", "multi_box_enabled") == {
        "service": "Surface",
        "vendor": "Delhivery",
        "weight_range": "0-30",
        "shipping_details": "Missing",
        "multi_box_enabled": "true",
    }


def test_legs(marts):
    assert values(marts["legs"], "leg_id") == ["G1", "G2"]
    got = cells(
        marts["legs"],
        "leg_id",
        "G1",
        *"""bag_id shipment_type consignment_id shipment_validation_check bag_weight bag_creation_date bag_outscan_date
        consignment_register_time trip_id vehicle_number source_arrived_time inscan_time outscan_time attempt_count la_time
        fa_time undel_reason current_leg_status shipment_sort_time shipment_promise_date sla_input delivery_time""".split(),
    )
    assert got == {
        "bag_id": "B1",
        "shipment_type": "PART_OF_BAG",
        "consignment_id": "C1",
        "shipment_validation_check": "VALIDATED",
        "bag_weight": 2.5,
        "bag_creation_date": "06-09-2018 11:00:00",
        "bag_outscan_date": "06-09-2018 13:00:00",
        "consignment_register_time": "06-09-2018 14:00:00",
        "trip_id": "T1",
        "vehicle_number": "MH12",
        "source_arrived_time": "2018-09-06 05:00:00",
        "inscan_time": "07-09-2018 06:00:00",  # the cross dock goes before the hub
        "outscan_time": None,
        "attempt_count": 10,  # a number, not the greater text
        "la_time": "09-09-2018 12:00:00",
        "fa_time": "09-09-2018 12:00:00",
        "undel_reason": ["shut"],
        "current_leg_status": "DELIVERED",
        "shipment_sort_time": "06-09-2018 09:00:00",
        "shipment_promise_date": "09-09-2018 10:00:00",
        "sla_input": "2",
    } | {"delivery_time": "2018-09-10 12:00:00"}
    drop = cells(marts["legs"], "leg_id", "G2", "inscan_time", "outscan_time", "shipment_sort_time", "attempt_count")
    assert drop == {"inscan_time": None, "outscan_time": "08-09-2018 10:00:00", "shipment_sort_time": None, "attempt_count": 0}


def test_leg_logs_are_cut_to_the_run(spark):
    ship = "S" * legs_plan.SHIPMENT_ID_LENGTH
    rows = [("B1", ship + "-1", 1), ("B2", ship, 0), ("B3", "T" + ship, 1), ("B4", None, 1), ("B5", ship, 1)]
    t = domain(spark, ds_sqls_bag_shipment_mapping=[{"bag_id": b, "vendor_id": "V", "shipment_id": s, "current_active": a} for b, s, a in rows])
    ids = spark.createDataFrame([(ship,), (ship,), (None,)], "shipment_id string")
    assert values(legs_plan.bagged(t, ids), "bag", "shipment_id") == [("B1", ship), ("B5", ship)]
    plan = legs_plan.legs(tables(spark), PARAMS)._jdf.queryExecution().analyzed().toString()
    assert plan.count("LeftSemi") >= 14  # two of them are for units


def test_bag_consignments(spark):
    assert values(legs_plan.bag_consignments(tables(spark)), "bag_id", "shipment_id", "consignments", "first_mapped_at") == [("B1", "S3", 1, 5)]


def test_shipments(marts):
    df = marts["shipments"]
    assert values(df, "shipment_group_id") == ["R1", "S1", "S2", "S3"]
    expected = {
        "terminal_state": "SHIPMENT_DELIVERED",
        "vendor": "Delhivery",
        "ue_lm_vendor": "Non_UE",
        "lane": "LU",
        "zone": "Local",
        "max_sla": 3,
        "category": "A",
        "unit_qty": 4,
        "order_amount": 12.5,
        "listing_title": ["ink", "pen"],
        "shipment_amount": 123.45,
        "logistics_amount": 7.0,
        "from_pay_tag": "From_Pay",
        "rts_qty": 4,
        "fulfilment_type": "Marketplace",
        "dtr_tag": "DTR",
        "seller_address": "a, b, c",
        "buyer_address": None,
        "buyer_verified_number": "88",
        "buyer_age_in_weeks": 4.0,
        "fm_service": "FM service",
        "hub_name": "Seller unit",
        "weight": 1.5,
        "rts_date": "05-09-2018 10:00:00",
        "first_rts_date": "04-09-2018 10:00:00",
        "last_packed_date": "04-09-2018 09:00:00",
        "picked_up_time": "05-09-2018 20:00:00",
        "pickup_count": 1,
        "pickup_failure_reason": "shut",
        "first_shipped_date": "06-09-2018",
        "del_date": "08-09-2018",
        "delivered_day": "09/ 08",
        "fwd_promise_date": "08-09-2018",
        "slc_promise_at": "16-09-2018",
        "rad_date": "07-09-2018 08:00:00",
        "fa_date": "07-09-2018 10:00:00",
        "la_date": "08-09-2018 10:00:00",
        "attempt": 2,
        "ul_attempt_count": 1,
        "o2rts": 2.0,
        "rts2s": 1.0,
        "s2d": 2.0,
        "d2d_aging": 14.0,
        "ndr_reason": "Reached maximum attempt count",
        "clean_ndr_reason": "c",
        "current_shipment_owner": "Dest_Hub",
        "logistics_undel_reason": ["flood", "late truck"],
        "rts2p_SLA": "Within_SLA",
        "o2rts_SLA": "Outside_SLA",
        "rts2s_SLA": "Within_SLA",
        "s2d_SLA": "Within_SLA",
        "rts_sla": "Breach",
        "rto_sla": None,
        "3pl_rto_sla": None,
        "d2d_breach": "Outside_SLA",
        "rto_del_flag": "NO",
        "hub_breach": "Outside_SLA",
        "pendency_fwd_sla": None,
        "rev_breach_flag": "Yes",
        "fwd_breach_flag": "No",
        "attempt_promise_sla": "Within_SLA",
        "attempt_flag": "YES",
        "attempt_o_flag": None,
        "total_interactions": 1,
        "type": ["Delay"],
        "first_interaction_at": "2018-09-08 10:00:00",
        "order_processing_time": "03-09-2018 10:00:00",
    }
    assert cells(df, "shipment_group_id", "S1", *expected) == expected


def test_shipments_on_the_way_back_and_own_network(marts):
    expected = {
        "terminal_state": "SHIPMENT_RTO",
        "lane": "NR",
        "zone": "National",
        "first_shipped_date": "05-09-2018",
        "slc_promise_at": "22-09-2018",  # ordered before the promise was lengthened
        "rad_date": "06-09-2018 10:00:00",
        "rto2rad": 4,
        "clean_ndr_reason": "219 - absent",
        "ndr_reason": "1225 - instructed",
        "current_shipment_owner": None,
        "3pl_rto_attempt_count": 1,
        "rto_attempt_count": 2,
        "rto_first_ofd": "13-09-2018 10:00:00",
        "rto_undel_comments": ["a", "b"],
        "attempt": 0,
        "rto_sla": "Outside_SLA",
        "3pl_rto_sla": "Within_SLA",
        "hub_breach": "Within_SLA",
        "rev_breach_flag": "Yes",
        "from_pay_tag": "To_pay",
        "category": "C",
        "unit_qty": None,
        "dtr_tag": "DTR",
    }
    assert cells(marts["shipments"], "shipment_group_id", "S2", *expected) == expected
    own = {
        "ue_lm_vendor": "Own_LM",
        "order_date": None,
        "rad_date": "07-09-2018 06:00:00",
        "fa_date": "08-09-2018 10:00:00",
        "attempt": None,
        "attempt_flag": None,
        "slc_promise_at": None,
        "fwd_today_flag": "No",
        "clean_ndr_reason": "Miscellaneous",
    }
    assert cells(marts["shipments"], "shipment_group_id", "S3", *own) == own


def test_returns(marts):
    assert values(marts["returns"], "return_id") == ["RT1", "RT2"]
    expected = {
        "seller_maturity": "New",
        "account_details": "Account_Number- 9, IFSC_Code- I, Bank Name- B, Account_Type- S",
        "account_holder_name": "H",
        "current_repay_mode": "REFUND",
        "refund_converted_by": "ann",
        "refund_amount": None,
        "return_goods_value": 50.0,
        "fwd_vendor": "Delhivery",
        "lane": "LU",
        "max_sla": 3,
        "resolution_time": 2.5,
        "resolution_spread": "2_5",
        "pendency_spread": None,
        "rev_shipment_id": "R1",
        "reschedule_count": 2,
        "rev_attempt_count": 2,
        "rev_rts_date": "10-09-2018 10:00:00",
        "rev_pickup_promise_date": "14-09-2018",
        "pick_attempt_breach": "within",
        "rev_fpa_date": "11-09-2018 10:00:00",
        "rev_lpa_date": "12-09-2018 09:00:00",
        "ndr_reason": "closed",
        "rvp_undel_reason": ["nobody"],
        "rev_sla_met": "Outside_SLA",
        "rev_s2d": 4.0,
        "rev_pick_up_time": 2.0,
        "rev_aging": 10.0,  # nine days and fourteen hours
        "return_order_current_status": "NEW",
        "return_shipment_id": "S2",
        "return_shipment_current_status": "SHIPMENT_RTO",
        "hold_reason": "h",
        "request_aging": 11,
        "lm_rvp_attempt": 0,
    }
    assert cells(marts["returns"], "return_id", "RT1", *expected) == expected
    pending = {
        "refund_amount": 2.5,
        "pendency_spread": "0",
        "resolution_time": None,
        "pick_attempt_breach": "outside",
        "return_order_id": None,
        "return_shipment_current_status": "order_status",
        "rev_created_at": None,
    }
    assert cells(marts["returns"], "return_id", "RT2", *pending) == pending


def test_return_counts(spark):
    t = tables(spark)
    assert values(pickup_attempt_counts(t, *scan_states(t)), "return_shipment_id", "attempts_delhivery", "attempts_ecom") == [("R1", 2, None)]
    assert values(reschedules(t, scan_states(t)[0]), "return_id", "reschedule_count") == [("RT1", 2)]


def test_support(marts):
    df = marts["support"]
    # The order of the first request has two category rows.
    assert values(df, "interaction_id", "sr", "category") == [
        ("N1", "SR1", "A"),
        ("N1", "SR1", "B"),
        ("N1", "SR2", None),
        ("N2", None, None),
    ]
    expected = {
        "interaction_timestamp": "2018-09-08 10:00:00",
        "order_status": None,
        "agents_assigned": 2,
        "org_type": "Seller",
        "interaction_system": "DT",
        "org_age_in_days": 7.0,
        "org_new_old_tag": "New",
        "issue_id": "SI1234567",
        "dt_issue": "Where is it",
        "called_city": "Pune",
        "city_lat": 18.5,
        "city_lon": None,
        "acw_start": "2018-09-08 10:05:00",
        "chat_firstMessageAt": "2018-09-08 09:55:00",
        "chat_lastMessageBy": "agent",
        "feedback_answer": "4",
        "amount_blocked": 10.0,
        "is_running_account": "true",
        "caller_type": "Seller",
        "shipment_group_id": "S1",
    }
    rows = [r.asDict() for r in df.filter("sr = 'SR1' AND category = 'B' AND shipment_group_id = 'S1'").select(*expected, "order_id").collect()]
    assert len(rows) == 1 and {k: rows[0][k] for k in expected} == expected | {"order_status": "open"}
    plain = [r.asDict() for r in df.filter("sr = 'SR2'").select("order_id", "interaction_system", "caller_type", "type").collect()]
    assert plain == [{"order_id": None, "interaction_system": "Not DT", "caller_type": None, "type": "Return"}]


def test_stages_not_in_the_marts(spark):
    t = tables(spark)
    assert values(logs.tag_text(t, PARAMS), "wh_tag") == ["FRES1-OL1"]
    assert values(logs.order_facts(t, PARAMS), "payment_mode") == ["COD", "COD", "COD"]


def item(n, note, state=None, **more):
    """An inwarded item with the states of the later steps."""
    rows = {
        "ds_sqls_wh_receive_order": [{"id": f"RO{n}", "state": more.get("order", "ACCEPTED"), "org_id": "OS"}],
        "ds_sqls_wh_document_skuitems": [{"sku_item_id": f"IT{n}", "document_id": f"{note}{n}"}],
        "ds_sqls_wh_inventory_skuitems": [{"sid": f"IT{n}", "sku_id": "K1"}],
    }
    kind = "ds_sqls_wh_stock_reject_note" if note == "RJ" else "ds_sqls_wh_stock_inward_note"
    rows[kind] = [{"id": f"{note}{n}", "receive_order_id": f"RO{n}", "state": state}]
    for step, table, prefix in (("put", "ds_sqls_wh_putlist", "PUL"), ("pick", "ds_sqls_wh_picklist", "PIL")):
        if step in more:
            rows[table] = [{f"{step}list_id": f"{prefix}{n}", "state": more[step], "created_at": n}]
            rows.setdefault("ds_sqls_wh_puttables_pickables", []).append({"skuitem_id": f"IT{n}", "document_id": f"{prefix}{n}"})
    if "reserve" in more:
        rows["ds_sqls_wh_sku_reservation"] = [{"id": f"FRES{n}-OL{n}", "state": more["reserve"], "created_at": n}]
        rows["ds_sqls_wh_document_skuitems"].append({"sku_item_id": f"IT{n}", "document_id": f"FRES{n}-OL{n}"})
    if "out" in more:
        rows["ds_sqls_wh_sku_quantities"] = [{"reservation_id": f"FRES{n}-OL{n}", "document_id": f"DOO{n}"}]
        rows["ds_sqls_wh_stock_outward_note"] = [{"id": f"OUT{n}", "document_id": f"DOO{n}", "state": more["out"]}]
    return rows


STATUS = [
    (("IN", "STOCKED", {"reserve": "RESERVED", "pick": "PICKED", "out": "DISPATCHED"}), "DISPATCHED"),
    (("IN", "STOCKED", {"reserve": "RESERVED", "pick": "PICKED", "out": "DISPATCHING"}), "DISPATCHING"),
    (("IN", "STOCKED", {"reserve": "RESERVED", "pick": "PICKING", "out": "DRAFT"}), "PICKLIST_PICKING"),
    (("IN", "STOCKED", {"reserve": "RESERVED", "pick": "PICKED"}), "PICKLIST_PICKED"),
    (("IN", "STOCKED", {"reserve": "RESERVED", "pick": "DISPATCHED"}), "PICKLIST_DISPATCHED"),
    (("IN", "STOCKED", {"reserve": "RESERVED", "pick": "CREATED"}), "PICKLIST_CREATED"),
    (("IN", "STOCKED", {"reserve": "RESERVED", "put": "STOCKED"}), "RESERVED"),
    (("IN", "STOCKED", {"reserve": "REQUESTED"}), "RESERVATION_REQUESTED"),
    (("IN", "STOCKED", {"reserve": "CANCELLED"}), "RESERVATION_CANCELLED"),
    (("IN", "STOCKED", {"put": "SUGGESTED"}), "PUTLIST_SUGGESTED"),
    (("IN", "STOCKED", {"put": "STOCKED"}), "PUTLIST_STOCKED"),
    (("IN", "STOCKED", {"put": "?"}), "INWARD_NOTE_STOCKED"),
    (("IN", "STOCKING", {}), "INWARD_NOTE_STOCKING"),
    (("IN", "ABANDONED", {}), "INWARD_NOTE_ABANDONED"),
    (("RJ", None, {"order": "PROCESSED"}), "REJECTED"),
    (("IN", "?", {"order": "PROCESSED"}), "RECEIVE_ORDER_PROCESSED"),
    (("IN", "?", {"order": "ACCEPTED"}), "RECEIVED_ORDER_ACCEPTED"),
    (("IN", "?", {"order": "CANCELLED"}), "RECEIVE_ORDER_CANCELLED"),
    (("IN", "?", {"order": "?"}), None),
]


def test_stock_status(spark):
    rows: dict[str, list[dict]] = {}
    for n, ((note, state, more), _) in enumerate(STATUS, start=10):
        for table, listed in item(n, note, state, **more).items():
            rows.setdefault(table, []).extend(listed)
    rows["ds_sqls_wh_inventory_sku"] = [{"id": "K1", "name": "pen"}]
    got = {r.sku_item_id: r for r in stock(domain(spark, **rows)).collect()}
    assert {k: r.sku_status for k, r in got.items()} == {f"IT{n}": s for n, (_, s) in enumerate(STATUS, start=10)}
    assert got["IT10"].order_line_id == "OL10" and got["IT10"].sku_name == "pen" and got["IT24"].reject_order_note == "RJ24"


def test_stock_rows_without_a_reservation_are_dealt_out(spark):
    plain = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in plain}
    for k, v in plain.items():
        spark.conf.set(k, v)
    try:
        rows: dict[str, list[dict]] = {}
        for n in range(10, 14):
            for table, listed in item(n, "IN", "STOCKED").items():
                rows.setdefault(table, []).extend(listed)
        df = stock(domain(spark, **rows))
        plan = df._jdf.queryExecution().executedPlan().toString()
        places = [x.split(")")[0] for x in plan.split("Exchange hashpartitioning(reservation_id")[1:]]
        assert any("_dealt" in x for x in places)
        assert df.where("reservation_id is null and order_id is null and sku_status is not null").count() == df.count() > 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
