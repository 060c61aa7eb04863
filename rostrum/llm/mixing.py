"""Mixing sources to target weights by temperature, in SQL functions only.

A source with token share p gets a weight in proportion to p ** x: 1 leaves the
shares as they are, 0 makes all sources equal. The exponent is bisected to meet a
target entropy or a limit on repetition. Weights are realised whole: the source
that is repeated least is taken once, every other as often as its weight asks.
Each time round, the blocks of a source come in an order of their own; in the
last round blocks are taken while the budget of the source lasts. The realised
mixture passes over a block that no longer fits and goes on with the next; the
counts of ``mixture`` end at the first such block, as their SQL equivalent does.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.llm.common import SPACES, keep

BLOCKS = 1024  # of each source
ENTROPY = 0.98  # target: this part of the entropy of equal weights
MOST_REPEATS = 2.0
STEPS = 50
PLACED = ("mix_round", "mix_place")  # the order of a mixture, from places()


def n_tokens(text: Column) -> Column:
    """Words between white space, and one that ends the document."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")).cast("bigint") + 1


def hash_of(*parts: Column | str | int) -> Column:
    """28 bits of MD5 of the parts written out, so that any SQL engine agrees."""
    written = F.concat_ws(":", *(p if isinstance(p, Column) else F.lit(str(p)) for p in parts))
    return F.conv(F.substring(F.md5(written), 1, 7), 16, 10).cast("bigint")


def block_of(doc_id: Column) -> Column:
    return hash_of("block", F.coalesce(doc_id.cast("string"), F.lit("null"))) % BLOCKS


def weights(tokens: Sequence[float], exponent: float) -> list[float]:
    total = sum(tokens)
    raised = [(t / total) ** exponent for t in tokens]
    return [x / sum(raised) for x in raised]


def repeats(tokens: Sequence[float], exponent: float) -> list[float]:
    """How often each source is taken, the least repeated one once."""
    rates = [w / t for w, t in zip(weights(tokens, exponent), tokens, strict=True)]
    return [r / min(rates) for r in rates]


def entropy(shares: Sequence[float]) -> float:
    return -sum(p * math.log(p) for p in shares if p > 0)


def exponent_for(tokens: Sequence[float], target: float = ENTROPY, most: float = MOST_REPEATS) -> float:
    """The largest exponent that reaches the target entropy, unless that repeats a source too often.

    Entropy falls and repetition falls as the exponent grows from 0 to 1, so
    either is met by bisection. ``target`` is a part of the greatest entropy.
    """
    if len(tokens) < 2:
        return 1.0

    def bisect(met) -> float:
        """The largest exponent with ``met``, which holds up to some point."""
        if met(1.0):
            return 1.0
        low, high = 0.0, 1.0
        for _ in range(STEPS):
            middle = (low + high) / 2
            low, high = (middle, high) if met(middle) else (low, middle)
        return low

    by_entropy = bisect(lambda x: entropy(weights(tokens, x)) >= target * math.log(len(tokens)))
    beyond = bisect(lambda x: max(repeats(tokens, x)) > most)
    allowed = 0.0 if max(repeats(tokens, 0.0)) <= most else beyond
    return round(max(by_entropy, allowed), 9)


def _last_round(ordered: DataFrame) -> DataFrame:
    """``_of, _taken``: the blocks of each source's partial round, in its order.

    A block that does not fit what is left is passed over. The least of those is
    taken in the end if that comes nearer to the budget.
    """

    def step(so_far: Column, block: Column) -> Column:
        fits = block["_tokens"] <= so_far["left"]
        passed = F.struct(block["_tokens"].alias("_tokens"), block["_block"].alias("_block"))
        return F.struct(
            F.when(fits, so_far["left"] - block["_tokens"]).otherwise(so_far["left"]).alias("left"),
            F.when(fits, F.concat(so_far["taken"], F.array(block["_block"]))).otherwise(so_far["taken"]).alias("taken"),
            F.when(fits, so_far["passed"]).otherwise(F.least(so_far["passed"], passed)).alias("passed"),
        )

    def end(so_far: Column) -> Column:
        nearer = 2 * so_far["left"] > so_far["passed"]["_tokens"]
        return F.when(nearer, F.concat(so_far["taken"], F.array(so_far["passed"]["_block"]))).otherwise(so_far["taken"])

    begin = F.struct(
        F.col("_left").alias("left"),
        F.array().cast("array<bigint>").alias("taken"),
        F.lit(None).cast("struct<_tokens: bigint, _block: bigint>").alias("passed"),
    )
    # At most BLOCKS entries a source.
    lists = ordered.groupBy(F.col("_source").alias("_of")).agg(
        F.floor(F.first("_budget")).alias("_left"),
        F.sort_array(F.collect_list(F.struct("_order", "_block", "_tokens"))).alias("_blocks"),
    )
    return lists.select("_of", F.aggregate("_blocks", begin, step, end).alias("_taken"))


def plan(docs: DataFrame, target: float = ENTROPY, most: float = MOST_REPEATS, fill: bool = True) -> DataFrame:
    """How often each block is taken: ``_source, _block, copies`` and the figures of its source.

    The driver gets one row per source; blocks are a fixed number per source.
    Without ``fill`` the last round ends at the first block that does not fit.
    """
    blocks = keep(
        docs.groupBy(F.coalesce("source", F.lit("")).alias("_source"), block_of(F.col("doc_id")).alias("_block")).agg(
            F.sum(n_tokens(F.col("text"))).alias("_tokens")
        )
    )
    sources = blocks.groupBy("_source").agg(F.sum("_tokens").alias("tokens")).orderBy("_source").collect()
    tokens = [float(row["tokens"]) for row in sources]
    x = exponent_for(tokens, target, most) if tokens else 1.0
    rows = [
        (row["_source"], int(t), w, r, x)
        for row, t, w, r in zip(sources, tokens, weights(tokens, x), repeats(tokens, x), strict=True)
    ] if tokens else []
    figures = docs.sparkSession.createDataFrame(
        rows, "_of string, source_tokens bigint, weight double, repeats double, exponent double"
    )
    turn = F.floor("repeats")
    # Blocks of the last, partial round, in that round's order, while the budget lasts.
    ordered = (
        blocks.join(figures, F.col("_source") == F.col("_of"))
        .drop("_of")
        .withColumn("_order", hash_of("order", turn, F.col("_source"), F.col("_block")))
        .withColumn("_budget", (F.col("repeats") - turn) * F.col("source_tokens"))
    )
    if fill:
        ordered = ordered.join(_last_round(ordered), F.col("_source") == F.col("_of"))
        again = F.array_contains("_taken", F.col("_block"))
    else:
        order = Window.partitionBy("_source").orderBy("_order", "_block")
        ordered = ordered.withColumn("_so_far", F.sum("_tokens").over(order))
        again = F.col("_so_far") <= F.round("_budget")
    return ordered.select(
        "_source", "_block", (turn + F.when(again, 1).otherwise(0)).alias("copies"),
        "source_tokens", "weight", "repeats", "exponent",
    )


def _each_time(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """``rows``, which have ``source`` and ``block``, once for each time their block is taken: with ``round`` and ``place``."""
    return (
        rows.join(
            F.broadcast(taken),  # at most BLOCKS rows per source
            (F.col("source") == F.col("_source")) & (F.col("block") == F.col("_block")),
        )
        .withColumn("round", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))))
        .withColumn("place", hash_of("order", F.col("round"), F.col("source"), F.col("block")))
    )


def mix(docs: DataFrame, target: float = ENTROPY, most: float = MOST_REPEATS) -> DataFrame:
    """``doc, round, place``: the documents as structs, each as often as its block is taken.

    ``round`` counts from 0; ``place`` orders a round: a source's blocks come in
    an order of their own in each round, and sources interleave. Every document
    comes at least once. A null source is a source of its own, the empty name; a
    null text counts one token; repeated rows are taken each; no documents give
    no rows.
    """
    rows = docs.select(
        F.struct("*").alias("doc"), F.coalesce("source", F.lit("")).alias("source"), block_of(F.col("doc_id")).alias("block")
    )
    return _each_time(rows, plan(docs, target, most)).select("doc", "round", "place")


def mixed_documents(docs: DataFrame, target: float = ENTROPY, most: float = MOST_REPEATS) -> DataFrame:
    """The mixture in its order, with the columns of ``docs``."""
    order = ("round", "place", "doc.doc_id")
    return mix(docs, target, most).repartitionByRange(*order).sortWithinPartitions(*order).select("doc.*")


def places(rows: DataFrame, *key: str) -> DataFrame:
    """Rows of a mixture, or parts of its documents, with ``mix_round`` and ``mix_place``, their order.

    Rows equal in ``key``, which must tell all others apart, are the times that
    one is taken: they get the rounds from 0 on.
    """
    again = Window.partitionBy(*key).orderBy(F.lit(0))
    return rows.withColumn("mix_round", F.row_number().over(again).cast("bigint") - 1).withColumn(
        "mix_place", hash_of("order", F.col("mix_round"), F.coalesce("source", F.lit("")), block_of(F.col("doc_id")))
    )


def _figures(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("source"),
        n_tokens(F.col("text")).alias("n_tokens"),
        block_of(F.col("doc_id")).alias("block"),
    )


def realised(docs: DataFrame, target: float = ENTROPY, most: float = MOST_REPEATS) -> DataFrame:
    """The mixture: one row each time a document is taken.

    Columns: ``doc_id, source, n_tokens, block, round, place, copies,
    source_tokens, weight, repeats, exponent``; round, place and doc_id give
    the order.
    """
    return _each_time(_figures(docs), plan(docs, target, most)).select(
        "doc_id", "source", "n_tokens", "block", F.col("round").cast("bigint").alias("round"), "place",
        F.col("copies").cast("bigint").alias("copies"), "source_tokens",
        *(F.round(c, 6).alias(c) for c in ("weight", "repeats", "exponent")),
    )


def mixture(docs: DataFrame, target: float = ENTROPY, most: float = MOST_REPEATS) -> DataFrame:
    """One row per document: how often it is taken and why, by the rule of the SQL equivalent.

    Columns: ``doc_id, source, n_tokens, block, copies, source_tokens, weight,
    repeats, exponent``.
    """
    taken = plan(docs, target, most, fill=False)
    return _figures(docs).join(
        F.broadcast(taken), (F.col("source") == taken["_source"]) & (F.col("block") == taken["_block"])
    ).select(
        "doc_id", "source", "n_tokens", "block", F.col("copies").cast("bigint").alias("copies"), "source_tokens",
        *(F.round(c, 6).alias(c) for c in ("weight", "repeats", "exponent")),
    )
