"""Join helpers for keys of very uneven size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = 4096
# A join side of at most so many rows is sent to all executors.
_FEW_ROWS = 100_000


def broadcast_if_few(df: DataFrame) -> DataFrame:
    """``df``, hinted for broadcast when it is counted to be short.

    Adaptive execution also broadcasts a short side, but learns its size while
    the long side is already being shuffled. Counting fetches no more rows than
    the bound calls for. A short side is made of the rows fetched, so the joins
    that read it do not compute it again; a longer side is returned as it was.
    """
    rows = df.limit(_FEW_ROWS + 1).toArrow()
    if rows.num_rows > _FEW_ROWS:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def lookup(left: DataFrame, right: DataFrame, key: str, spread_by: Sequence[str]) -> DataFrame:
    """Left join on ``key`` in which rows without a key do not pile up in one task.

    Rows whose key is NULL match nothing but would all hash to one partition.
    They are joined under stand-in keys instead, drawn from ``spread_by``. A
    stand-in starts with NUL, which no real key does. ``right`` may hold columns
    other than ``key`` only if ``left`` lacks them.
    """
    stand_in = F.concat(
        F.lit("\x00"), F.pmod(F.xxhash64(*spread_by), F.lit(_SPREAD)).cast("string")
    )
    other = right.withColumnRenamed(key, "_lookup_key")
    return left.join(
        other, F.coalesce(left[key], stand_in) == other["_lookup_key"], "left"
    ).drop("_lookup_key")
