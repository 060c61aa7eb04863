"""Near copies by SimHash fingerprints and multi-index hashing.

A fingerprint is cut into two halves. Two fingerprints that differ in at most
three bits differ in at most one bit of some half, so it is enough to look up,
for every value that a half takes, that value and those one bit away. The balls
are enumerated around distinct half values, not around fingerprints: however
many fingerprints share a half, it is looked up once. Fingerprints of halves
that found each other meet; where many meet, the other half is cut in two and
looked up the same way, and complete distances are verified in the end.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import each_batch, keep, texts
from rostrum.llm.components import components

WORDS = 3
SEED = 42
BITS = 64
# Fingerprints link at this many differing bits or fewer. With two pieces, some
# piece then differs in one bit or none.
DISTANCE = 3
# Halves whose fingerprints would make more pairs than this are looked up by
# quarters too. Both ways find the same links.
PAIRS_AT_ONCE = 256
# Shingles whose bits are unpacked at once: bounds memory for very long texts.
UNPACKED = 1 << 14

_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: bytes | None) -> int:
    """The majority of each bit over the hashes of a text's shingles, as an unsigned number."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(WORDS))))
    hashes = np.fromiter(map(_hash, shingles), np.dtype("<u8"))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), UNPACKED):
        part = hashes[at : at + UNPACKED].view(np.uint8).reshape(-1, BITS // 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprint_batch(batch: pa.RecordBatch) -> dict:
    found = [fingerprint(text) for text in batch.column("text").cast(pa.binary()).to_pylist()]
    return {
        "doc_id": batch.column("doc_id"),
        "bits": np.array(found, np.uint64).view(np.int64),
    }


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, bits``: the fingerprint of every whole text, as a signed 64-bit number."""
    schema = pa.schema([("doc_id", pa.int64()), ("bits", pa.int64())])
    return each_batch(texts(docs), _fingerprint_batch, schema, "doc_id long, bits long")


def _pieces(value: Column, width: int) -> Column:
    """The two pieces of ``2 * width`` low bits, numbered, each with what it leaves."""
    low = value.bitwiseAND(F.lit((1 << width) - 1))
    high = F.shiftrightunsigned(value, width).bitwiseAND(F.lit((1 << width) - 1))
    return F.explode(
        F.array(
            F.struct(F.lit(0).alias("piece"), high.alias("key"), low.alias("rest")),
            F.struct(F.lit(1).alias("piece"), low.alias("key"), high.alias("rest")),
        )
    )


def _upwards(key: Column, width: int) -> Column:
    """The values that have one bit more than ``key``.

    Of two values one bit apart, one is among these for the other; the opposite
    direction would find every pair again.
    """
    flips = F.array(*(F.lit(1 << bit).cast("bigint") for bit in range(width)))
    return F.transform(
        F.filter(flips, lambda bit: key.bitwiseAND(bit) == 0), lambda bit: key.bitwiseOR(bit)
    )


def _close(x: Column, y: Column) -> Column:
    return F.bit_count(x.bitwiseXOR(y)) <= DISTANCE


def _meetings(halves: DataFrame) -> DataFrame:
    """``piece, low, high, many``: half values at most one bit apart that fingerprints have.

    ``low = high`` where several fingerprints share a half; ``many`` tells whether
    they would make more than ``PAIRS_AT_ONCE`` pairs.
    """
    held = keep(halves.groupBy("piece", "key").agg(F.count(F.lit(1)).alias("n")))
    balls = held.select(
        "piece",
        F.col("key").alias("low"),
        F.col("n").alias("n_low"),
        F.explode(_upwards(F.col("key"), BITS // 2)).alias("key"),
    )
    one_apart = balls.join(held, ["piece", "key"]).select(
        "piece", "low", F.col("key").alias("high"), (F.col("n_low") * F.col("n")).alias("pairs")
    )
    equal = held.where("n > 1").select(
        "piece", F.col("key").alias("low"), F.col("key").alias("high"), (F.col("n") * F.col("n")).alias("pairs")
    )
    return one_apart.union(equal).select(
        "piece", "low", "high", (F.col("pairs") > PAIRS_AT_ONCE).alias("many")
    )


def _links_of(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Verified pairs of fingerprints that meet under ``on``."""
    x, y = F.col("x"), F.col("y")
    return (
        left.withColumnRenamed("bits", "x")
        .join(right.withColumnRenamed("bits", "y"), on)
        .where((x != y) & _close(x, y))
        .select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
    )


def _by_quarters(members: DataFrame) -> DataFrame:
    """Members under each quarter of the half they did not meet by, and one bit above it."""
    width = BITS // 4
    found = members.select("piece", "low", "high", "bits", _pieces(F.col("rest"), width).alias("q"))
    found = found.select(
        "piece", "low", "high", "bits", F.col("q.piece").alias("quarter"), F.col("q.key").alias("value")
    )
    ball = F.concat(
        F.array(F.struct(F.col("value").alias("at"), F.lit(False).alias("moved"))),
        F.transform(
            _upwards(F.col("value"), width), lambda at: F.struct(at.alias("at"), F.lit(True).alias("moved"))
        ),
    )
    return found.select("piece", "low", "high", "bits", "quarter", F.explode(ball).alias("b")).select(
        "piece", "low", "high", "bits", "quarter", "b.at", "b.moved"
    )


def links(distinct: DataFrame) -> DataFrame:
    """``a, b``: every pair of different fingerprints at most ``DISTANCE`` bits apart.

    ``distinct`` has each fingerprint once, in a column ``bits``. A fingerprint's
    links are bounded by the 43,744 values that close to it.
    """
    halves = distinct.select("bits", _pieces(F.col("bits"), BITS // 2).alias("p")).select("bits", "p.*")
    meetings = keep(_meetings(halves))
    lower = halves.join(meetings.withColumn("key", F.col("low")), ["piece", "key"])
    upper = halves.join(meetings.withColumn("key", F.col("high")), ["piece", "key"])
    meeting = ["piece", "low", "high"]
    few = _links_of(
        lower.where("not many").select(*meeting, "bits"), upper.where("not many").select(*meeting, "bits"), meeting
    )
    quarter = [*meeting, "quarter", "at"]
    below = _by_quarters(lower.where("many"))
    above = _by_quarters(upper.where("many"))
    # Where both moved they are two bits apart here, which another quarter finds closer.
    many = _links_of(below.where("not moved").drop("moved"), above.drop("moved"), quarter).union(
        _links_of(below.where("moved").drop("moved"), above.where("not moved").drop("moved"), quarter)
    )
    return few.union(many).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its fingerprint, and the component it belongs to.

    ``component_id`` is the smallest id of the documents that links lead to, its
    own included; documents with equal fingerprints are linked. ``group_size``
    counts the rows with the same fingerprint. A null or empty text, or one of
    white space only, has fingerprint zero and is linked like any other; repeated
    rows are rows of their own; a null id counts only where a component has no
    other. An empty table gives no row.
    """
    found = keep(fingerprints(docs))
    distinct = keep(
        found.groupBy("bits").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("group_size"))
    )
    roots = components(links(distinct)).withColumnRenamed("node", "bits")
    placed = keep(
        distinct.join(roots, "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    )
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = placed.join(least, "root").select("bits", "component_id", "group_size")
    return found.join(groups, "bits").select(
        "doc_id",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
        "group_size",
    )
