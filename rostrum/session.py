"""Session settings the library relies on, and the folder executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Dates and instants are read and written in UTC; adaptive execution picks join
# strategies from measured sizes, splits skewed join partitions and merges small
# ones; Arrow batches are bounded by size because documents vary widely in length.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Adaptive execution broadcasts a join side whose measured size is at most this.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 << 20),
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session, whose executors share the machine, may go without.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="rostrum-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
