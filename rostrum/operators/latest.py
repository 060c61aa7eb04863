"""One row per key: the greatest by an ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, key: str, order: Sequence[Column], carry: Sequence[str]
) -> DataFrame:
    """For each ``key`` (NULL is a key too) the ``carry`` columns of its greatest row.

    Rows compare by ``order``, then by ``carry`` so that ties do not depend on
    arrival. It is an aggregate, not a window: every map task keeps one row per
    key, so a key holding most of the rows costs no more than any other.
    """
    ranked = [c.alias(f"_order{i}") for i, c in enumerate(order)]
    best = F.max(F.struct(*ranked, *carry)).alias("_best")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_best.{c}").alias(c) for c in carry])
