"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import keep


def _print(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 30))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root``: each node that has a link, with the smallest node it is connected to.

    Links are the first two columns. Large-star and small-star steps alternate:
    each ties neighbours to the smallest node known near them, and the number of
    steps grows with the logarithm of the longest path. No node's links are ever
    collected in one place: steps are aggregates and joins on nodes.
    """
    x, y = (F.col(c) for c in links.columns[:2])
    # a > b throughout.
    now = keep(links.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct())
    print_now = _print(now)
    while print_now[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("near"))
        large = (
            both.join(least, F.col("a") == F.col("u"))
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "near").alias("b"))
            .distinct()
        )
        large = keep(large)
        near = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("near"))
        small = (
            large.join(near, F.col("a") == F.col("u"))
            .where("b <> near")
            .select(F.col("b").alias("a"), F.col("near").alias("b"))
            .union(near)
            .distinct()
        )
        now, print_before = keep(small), print_now
        print_now = _print(now)
        if print_now == print_before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b").distinct()
    )
