"""Attribution, latest rows and the spread join against brute force."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from rostrum.operators import joins
from rostrum.operators.attribution import attribute_by_interval
from rostrum.operators.joins import lookup
from rostrum.operators.latest import latest_per_key

DAY0 = date(2000, 1, 1)
EVENT = "id string, key string, at date"
INTERVAL = "key string, start date, end date, uid string, label string"
NAMES = dict(
    event_id="id", key="key", at="at", start="start", end="end", uid="uid", label="label"
)


def brute(events, intervals):
    """Every event paired with every interval, then the best pair of each event."""
    best = {}
    for event, key, at in events:
        for other, start, end, uid, label in intervals:
            inside = at is None or ((start or at) <= at <= (end or at))
            if key is None or other != key or not inside:
                continue
            rank = (
                -(end or date(9999, 12, 31)).toordinal(),
                -(start or date(1900, 1, 1)).toordinal(),
                *((uid is not None, uid or ""), (label is not None, label or "")),
                *((at is not None, at or DAY0), key),
            )
            if event not in best or rank < best[event][0]:
                best[event] = (rank, (event, key, at, label))
    return {row for _, row in best.values()}


def attributed(spark, events, intervals):
    df = attribute_by_interval(
        spark.createDataFrame(events, EVENT), spark.createDataFrame(intervals, INTERVAL), **NAMES
    )
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed", range(4))
def test_attribution(spark, seed):
    rng = random.Random(seed)

    def day(none):
        return None if rng.random() < none else DAY0 + timedelta(rng.randrange(40))

    def interval():
        start = day(0.2)
        end = None if rng.random() < 0.3 else (start or DAY0) + timedelta(rng.randrange(-2, 15))
        uid = rng.choice([None, *(f"M{i}" for i in range(6))])
        return rng.choice(["a", "b", "c", None]), start, end, uid, rng.choice(["x", "y", "z"])

    intervals = [interval() for _ in range(60)]
    # The ids repeat, some are NULL, and key "a" holds most of the events.
    events = [
        (
            rng.choice([None, *map(str, range(150))]),
            rng.choice(["a", "a", "a", "b", "c", "d", None]),
            day(0.1),
        )
        for _ in range(300)
    ]
    assert attributed(spark, events, intervals) == brute(events, intervals)


@pytest.mark.parametrize("seed", range(3))
def test_attribution_over_many_years(spark, seed):
    """Blocks without offers, years beyond the first and last block, and busy days."""
    rng = random.Random(100 + seed)
    days = [date(rng.choice([1, 1789, 1899, 1900, 1958, 1999, 2000, 2024, 2050, 2051, 9999]), 1, 1)
            + timedelta(rng.randrange(300)) for _ in range(60)]

    def interval():
        start = rng.choice([None, *days])
        end = rng.choice([None, *(d for d in days if start is None or d >= start), start])
        return rng.choice("abc"), start, end, f"M{rng.randrange(9)}", rng.choice("xyz")

    intervals = [interval() for _ in range(40)]
    events = [(str(i // 2), rng.choice("aaabd"), rng.choice([None, *days])) for i in range(200)]
    assert attributed(spark, events, intervals) == brute(events, intervals)


def test_attribution_bounds(spark):
    d = DAY0
    intervals = [("k", d, d, "M1", "day"), ("k", date(1850, 1, 1), date(1860, 1, 1), "M2", "old")]
    events = [
        ("on", "k", d),
        ("before", "k", d - timedelta(1)),
        ("after", "k", d + timedelta(1)),
        ("old", "k", date(1855, 6, 1)),
        ("undated", "k", None),
        ("other", "z", d),
    ]
    assert attributed(spark, events, intervals) == {
        ("on", "k", d, "day"), ("old", "k", date(1855, 6, 1), "old"), ("undated", "k", None, "day")
    }
    assert attributed(spark, events, [intervals[0]] * 3) == {
        ("on", "k", d, "day"), ("undated", "k", None, "day")
    }


def test_attribution_makes_no_pairs(spark):
    """One key with 20,000 intervals and 20,000 events; all pairs would be 400 million."""
    n = 20_000
    day = (F.lit(DAY0) + (F.col("id") % 300).cast("int")).alias("start")
    intervals = spark.range(n).select(
        F.lit("k").alias("key"), day, (day + 5).alias("end"),
        F.col("id").cast("string").alias("uid"), F.col("id").cast("string").alias("label"),
    )
    events = spark.range(n).select(
        F.col("id").cast("string").alias("id"), F.lit("k").alias("key"),
        (F.lit(DAY0) + (F.col("id") % 300).cast("int")).alias("at"),
    )
    found = attribute_by_interval(events, intervals, **NAMES)
    assert found.count() == n
    # A later end wins, so the winner of a day starts on it, and has the least text id.
    least = intervals.groupBy(F.col("start").alias("at")).agg(F.min("uid").alias("expected"))
    assert found.join(least, "at").where("label <> expected").count() == 0


def test_latest_per_key(spark):
    rows = [
        ("a", 1, "p", "q"), ("a", 2, "r", "s"), ("a", 2, "r", "t"), ("b", None, "u", None),
        (None, 5, "v", "w"), (None, 4, "x", "y"),
    ]
    df = spark.createDataFrame(rows, "k string, n int, c string, d string")
    found = latest_per_key(df, "k", [F.col("n")], ["c", "d"]).collect()
    assert {tuple(r) for r in found} == {("a", "r", "t"), ("b", "u", None), (None, "v", "w")}


def test_lookup_keeps_rows_without_key_and_spreads_them(spark):
    left = spark.range(5000).selectExpr(
        "id", "if(id % 3 = 0, cast(id % 10 as string), null) as k"
    )
    right = spark.createDataFrame([(str(i), i) for i in range(5)], "k string, v int")
    found = lookup(left, right, "k", ["id"])
    plain = left.join(right, "k", "left")
    assert sorted(map(str, found.select("id", "k", "v").collect())) == sorted(
        map(str, plain.select("id", "k", "v").collect())
    )
    stand_ins = left.where("k is null").select(
        F.pmod(F.xxhash64("id"), F.lit(4096)).alias("s")
    )
    assert stand_ins.distinct().count() > 1000


def test_a_short_side_is_broadcast_and_a_long_one_is_not(spark, monkeypatch):
    monkeypatch.setattr(joins, "_FEW_ROWS", 5)
    for rows, hinted in ((5, True), (6, False)):
        plan = joins.broadcast_if_few(spark.range(rows))._jdf.queryExecution().logical().toString()
        assert ("ResolvedHint" in plan or "UnresolvedHint" in plan) is hinted
