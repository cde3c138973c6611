"""Session settings the reports rely on.

Only runtime SQL settings are touched, so a cluster keeps its own executor
sizes, shuffle partition count and checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot voucher, product or party is split at run time, even where an
    # aggregate could have reused the join's partitioning.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A short list of filtered vouchers prunes the big line scan before its shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Tables bucketed by voucher are joined on voucher and more without a shuffle; vouchers are many, so none is hot.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # The hierarchy walk's row count is not limited; its depth limit is the session's own.
    "spark.sql.cteRecursionRowLimit": "-1",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark
