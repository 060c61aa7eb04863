"""Attribute dated events to one validity interval of the same key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_OPEN_END = "9999-12-31"
_OPEN_START = "1900-01-01"


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


def attribute_by_interval(
    events: DataFrame,
    intervals: DataFrame,
    *,
    event_id: str,
    key: str,
    at: str,
    start: str,
    end: str,
    uid: str,
    label: str,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row ``(event_id, key, at, label)`` per event that lies in an interval of its key.

    ``carry`` names more columns of the row that wins.

    A NULL ``start`` or ``end`` leaves that side open and a NULL ``at`` lies in
    every interval. Among several candidates the latest end wins (open ends
    last of all), then the latest start (an open start counting as 1900), then
    the smallest ``uid``, then the smallest ``label``. Rows that share an
    ``event_id``, NULL included, are one event.

    Pairing each event with each interval would be quadratic for a busy key. It
    is not needed: of the intervals begun by a day, the winner is the greatest
    in that same ordering, because if its end lies before the day so does every
    other end. So a running minimum over start days answers every day of a key.
    Both its inputs are first reduced to one row per key and calendar day, which
    bounds a key's share of the window by the length of the calendar.
    """
    offer = F.struct(
        (-F.unix_date(F.coalesce(F.col(end), _day(_OPEN_END)))).alias("neg_end"),
        (-F.unix_date(F.coalesce(F.col(start), _day(_OPEN_START)))).alias("neg_start"),
        F.col(uid).alias("uid"),
        F.col(label).alias("label"),
    )
    begun = (
        intervals.where(F.col(key).isNotNull())
        .groupBy(F.col(key), F.coalesce(F.col(start), _day("0001-01-01")).alias("_day"))
        .agg(F.min(offer).alias("_offer"))
    )
    asked = (
        events.where(F.col(key).isNotNull())
        .select(key, F.col(at).alias("_at"))
        .distinct()
        .withColumn("_day", F.coalesce("_at", _day(_OPEN_END)))
    )
    timeline = begun.withColumn("_asked", F.lit(False)).unionByName(
        asked.withColumn("_asked", F.lit(True)), allowMissingColumns=True
    )
    so_far = Window.partitionBy(key).orderBy("_day")
    answers = (
        timeline.withColumn("_offer", F.min("_offer").over(so_far))
        .where("_asked")
        .where(
            F.col("_offer").isNotNull()
            & (F.col("_at").isNull() | (-F.col("_offer.neg_end") >= F.unix_date("_at")))
        )
        .select(F.col(key).alias("_key"), "_at", "_offer")
    )
    candidates = events.join(
        answers, (F.col(key) == F.col("_key")) & F.col(at).eqNullSafe(F.col("_at"))
    )
    winner = F.min(F.struct("_offer", at, key, *carry)).alias("_won")
    return (
        candidates.groupBy(event_id)
        .agg(winner)
        .select(
            event_id,
            F.col(f"_won.{key}").alias(key),
            F.col(f"_won.{at}").alias(at),
            F.col("_won._offer.label").alias(label),
            *[F.col(f"_won.{c}").alias(c) for c in carry],
        )
    )
