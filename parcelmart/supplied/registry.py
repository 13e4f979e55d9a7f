"""Name to (Spark plan, SQL) for the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from parcelmart.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

AS_OF = date(2024, 1, 30)
WINDOW_DAYS = 7


class Supplied:
    """The supplied tables as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self._folder = spark, folder

    def __getattr__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{table}.parquet")


def query(sql: str, name: str | None = None):
    """Register a plan over the supplied tables, by default under its function name."""

    def register(plan: Callable[[Supplied], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plan(Supplied(prepare(spark), sf_dir))

        run.__name__ = name or plan.__name__
        run.__doc__ = plan.__doc__
        QUERIES[run.__name__] = run
        ORACLE[run.__name__] = sql
        return plan

    return register
