"""Vendor service lanes: which vendor serves which pincode pair, and how."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.functions.text import json_fields, without_breaks
from parcelmart.functions.times import DAY, ist_format
from parcelmart.operators.lookup import INNER, enrich
from parcelmart.operators.rows import current_rows


def provider_terms(t: Mapping[str, DataFrame]) -> DataFrame:
    """Enabled providers with the terms written in their properties document."""
    document = without_breaks("service_provider_properties")
    enabled = current_rows(t["ds_sqls_service_providers"], "enabled")
    terms = enabled.select(
        "serviceability_id",
        "service_provider_org_id",
        *json_fields(
            document,
            {
                "min_wt": "$.properties.min_wt",
                "max_wt": "$.properties.max_wt",
                "profiles": "$.properties.shipping_profiles",
                "multi_box": "$.properties.multi_box_enabled",
            },
        ),
    )
    kilos = lambda grams: (F.col(grams).try_cast("double") / 1000).cast("int").cast("string")
    return terms.select(
        "serviceability_id",
        "service_provider_org_id",
        F.concat(kilos("min_wt"), F.lit("-"), kilos("max_wt")).alias("weight_range"),
        F.coalesce("profiles", F.lit("Missing")).alias("shipping_details"),
        F.when(F.col("multi_box") == "true", "true").otherwise("false").alias("multi_box_enabled"),
    )


def lanes(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row per vendor, service, route and pickup pincode."""
    routes = current_rows(t["ds_sqls_logistics_route_vsl_master"]).select(
        "vsl_id",
        "pick_up_cluster",
        "dest_pincode",
        "dest_city",
        "dest_state",
        "dest_tier",
        F.col("zone").alias("lane"),
        ist_format("created_at", DAY).alias("created_at"),
        ist_format("updated_at", DAY).alias("updated_at"),
    )
    services = current_rows(t["ds_sqls_logistics_serviceability"], "enabled").select(
        "route_id", "serviceability_id", without_breaks("service_name").alias("service")
    )
    # The terms of a lane are settled before the pickup pincodes of its cluster multiply the rows.
    rows = enrich(routes, services, {"route_id": "vsl_id"}, how=INNER)
    rows = enrich(rows, provider_terms(t), {"serviceability_id": "serviceability_id"}, how=INNER)
    rows = enrich(rows, t["ds_sqls_orgs"], {"org_id": "service_provider_org_id"}, {"vendor": "display_name"})
    rows = enrich(rows, t["categorization"], {"pincode": "dest_pincode"}, {"dest_city_class": "city_class"})
    rows = rows.drop("serviceability_id", "service_provider_org_id").distinct()
    pickups = current_rows(t["ds_sqls_logistics_pincode_cluster_master"]).select(
        F.col("pick_up_cluster").alias("pickup_cluster"), F.col("pincode").alias("pickup_pincode")
    ).distinct()
    rows = enrich(
        rows,
        pickups,
        {"pickup_cluster": "pick_up_cluster"},
        {"pickup_cluster": "pickup_cluster", "pickup_pincode": "pickup_pincode"},
        how=INNER,
    )
    return rows.select(
        "vsl_id",
        "pickup_cluster",
        "pickup_pincode",
        "dest_pincode",
        "dest_city",
        "dest_state",
        "dest_tier",
        "dest_city_class",
        "lane",
        "service",
        "vendor",
        "weight_range",
        "shipping_details",
        "multi_box_enabled",
        "created_at",
        "updated_at",
    )
