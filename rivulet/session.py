"""Session settings the package is tuned for.

Nothing here is required: every operator works on any session. Joins carry no
broadcast hints unless the side has a bound that follows from its grain, so
Spark's own size check (``autoBroadcastJoinThreshold``) and AQE decide, and
skewed sort-merge joins are split at run time.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # index jobs are bound by arithmetic, not bytes: small shuffles keep their tasks
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "rivulet", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
