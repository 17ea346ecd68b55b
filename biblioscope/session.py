"""Session settings the reports are written for.

Everything here is a runtime setting a cluster may override.  Reports only need
AQE (for skewed joins and for joins whose small side is known at run time) and a
UTC session, which is what the warehouse's instants are stored in.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where that costs one more shuffle of the result.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Prune the big side of a selective join (one barcode, one term) before its shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Instants with statistics: bounds on them skip files and row groups (as INT96, the default, they have none).
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Of equal keys in a document the last counts, as in the database.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
}


def build(app: str = "biblioscope", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
