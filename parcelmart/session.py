"""Session settings every plan here relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings; none of them fixes a machine size.
REQUIRED = {
    # Times are shifted to IST by a constant and then formatted, which is only right under UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join keys even when the split costs one more exchange later in the plan.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Bloom filters in front of the shuffle of a log that is semi-joined to a run's ids: 8 MB at any number of ids, made for
    # 8 million. The side they are built from is a narrow table of ids, which may be larger than the default of 10 MB.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "4GB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "8000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "8000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": str(1 << 26),
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(1 << 26),
}

# Logs from this size on are filtered; Spark's default is 10 GB.
FILTERED = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "256MB"}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else built."""
    for key, value in (REQUIRED | FILTERED).items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build(app: str = "parcelmart", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session; ``conf`` keys are written with ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())
