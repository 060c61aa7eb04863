"""Telling rows that come once from those that do not, without moving their keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_of(*columns: str) -> Column:
    return F.xxhash64(*columns).alias("_hash")


def repeated_hashes(df: DataFrame) -> DataFrame:
    """The values of ``_hash`` (see :func:`hash_of`) that more than one row of ``df`` has.

    Eight bytes a row move instead of the keys. Different keys may share a hash,
    so rows found here must be compared by their keys; all others come once.
    """
    return df.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_hash")
