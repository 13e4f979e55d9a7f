"""All marts of one run, each published before the next one reads it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from parcelmart.operators.publish import publish, run, stage
from parcelmart.params import RunParams
from parcelmart.plans.lanes import lanes
from parcelmart.plans.legs import legs
from parcelmart.plans.returns import returns
from parcelmart.plans.shipments import shipments
from parcelmart.plans.stock import stock
from parcelmart.plans.support import support, support_core


def build(
    t: Mapping[str, DataFrame],
    p: RunParams,
    target: str,
    fmt: str = "parquet",
    name: str | None = None,
    keep: int = 2,
) -> dict[str, DataFrame]:
    """Build and publish every mart under ``target``; returns them as read back.

    Order: legs and the support core need source tables only; shipments reads both; returns and
    support read shipments. Counting contacts from the core and not from the finished support mart
    is what keeps the order free of cycles. Reading each mart back from files keeps the plans short
    and lets a lost executor redo one mart's tasks and not the whole chain. The last ``keep`` versions
    of each mart stay. Intermediate tables go at the end; after a failure, a run of the same ``name``
    takes over those that are whole.
    """
    with run(t["ds_sqls_orgs"].sparkSession, name):

        def put(mart: str, df: DataFrame, distinct: bool = False) -> DataFrame:
            return publish(df, f"{target.rstrip('/')}/{mart}", fmt=fmt, distinct=distinct, keep=keep)

        done = {"lanes": put("lanes", lanes(t), distinct=True), "stock": put("stock", stock(t, put=stage))}
        done["legs"] = put("legs", legs(t, p, put=stage))
        core = done["support_core"] = put("support_core", support_core(t))
        done["shipments"] = put("shipments", shipments(t, p, done["legs"], core))
        done["returns"] = put("returns", returns(t, p, done["shipments"], put=stage))
        done["support"] = put("support", support(t, done["shipments"], core))
        return done
