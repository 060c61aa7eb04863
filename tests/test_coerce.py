"""Coercions against the Python functions whose reading rules they follow."""

from __future__ import annotations

from datetime import UTC, date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rostrum.functions import coerce

DATES = [
    *("2024-07-01", "2024-07-01T10:00:00", "20240701", "20240701150000000", "2024", "2024-1-5"),
    *("2024-02-30", "0000-01-01", "0001-01-01", "9999-12-31", "", " 2024-07-01", "2024-07-1x"),
    *("2024-W27-1", "2024-W27", "2024W271", "2024W27", "2024-W53-1", "2020-W53-7", "2024-W00-1"),
    *("20240701xx", "20240701x", "2024W271xx", "2024W271x", "2024-W27xx", "2024070-15"),
    *("2024-W1-1", "2021-W01-1", "2024-07", "20240230", "20240701\n", "2024/07/01", None),
]
STAMPS = [
    *("2024-07-10T10:00:00Z", "2024-07-10T10:00:00+02:00", "2024-07-10T10:00:00-0130"),
    *("2024-07-10", "2024-07-10 10:00", "2024-07-10x10", "2024-07-10T10:00:00.123456789"),
    *("2024-07-10T10:00:00,5", "2024-07-10T25:00:00", "2024-07-10T10:60", "2024", "20240710"),
    *("20240710T100000", "20240710T10:00:00", "2024-07-10T100000", "20241001150000000"),
    *("202410011100000", "20241001110000", "2024-07-1", "2024-02-30T10:00:00", "", "soon", None),
    *("2024-07-10T10:00+02", "0000-07-10T10:00:00", " 2024-07-10"),
]
NUMBERS = [
    *("12", " 12 ", "-3", "+5", "3.7", "1e3", "", "x", "1_000", "1__0", "_1", "1_", "\xa07 "),
    *("007", "9223372036854775807", "- 1", None),
]
WORDS = [*("1", " 1\n", "0", "true", "TRUE ", "False", "faux", "", "  ", "2", "\x1f1", None)]


def read(spark, function, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    found = rows.select("i", function(F.col("x")).alias("v")).collect()
    return [r.v for r in sorted(found)]


def python_date(text):
    try:
        return date.fromisoformat(text[:10]) if text else None
    except ValueError:
        return None


def python_instant(text):
    try:
        found = datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None
    except ValueError:
        return None
    if found is None or found.tzinfo is None:
        return found
    return found.astimezone(UTC).replace(tzinfo=None)


def python_int(text):
    try:
        return int(text)
    except (TypeError, ValueError):
        return None


def python_text(text):
    return None if text is None else (text.strip() or None)


def test_dates_read_as_iso_dates(spark):
    assert read(spark, coerce.to_date, DATES) == [python_date(t) for t in DATES]


def test_instants_read_as_iso_instants_in_utc(spark):
    assert read(spark, coerce.to_ts, STAMPS) == [python_instant(t) for t in STAMPS]


def test_whole_numbers(spark):
    assert read(spark, coerce.to_int, NUMBERS) == [python_int(t) for t in NUMBERS]


def test_text_is_stripped_of_every_white_space(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [*spaces, *(f"{s}a{s}b{s}" for s in spaces), "", None, "plain", "​kept"]
    assert read(spark, coerce.to_str, texts) == [python_text(t) for t in texts]
    assert sorted(coerce.WHITESPACE) == sorted(spaces)


def test_the_three_readings_of_truth(spark):
    def loose(text):
        word = (python_text(text) or "").lower()
        return {"true": True, "1": True, "false": False, "0": False}.get(word)

    assert read(spark, coerce.to_bool, WORDS) == [
        None if t is None else t.strip() == "1" for t in WORDS
    ]
    assert read(spark, coerce.to_bool_loose, WORDS) == [loose(t) for t in WORDS]
    assert read(spark, coerce.to_bool_word, WORDS) == [
        None if t is None else t.lower() == "true" for t in WORDS
    ]


def test_safe_cast_reads_dashed_dates_only(spark):
    texts = ["2024-10-01", "2024-1-5", "20241001150000000", "2024", "2024-13-01", "", None]
    expected = [date(2024, 10, 1), date(2024, 1, 5), None, None, None, None, None]
    assert read(spark, coerce.safe_cast_date, texts) == expected
    expected[2] = date(2024, 10, 1)
    assert read(spark, coerce.leading_date, texts) == expected


@pytest.mark.parametrize("function, model", [(coerce.to_int, python_int), (coerce.to_str, python_text)])
def test_any_text(spark, function, model):
    alphabet = st.text(alphabet=" \t\n\x1f  12_+-.aé", max_size=8)

    @settings(max_examples=15, deadline=None, database=None)
    @given(st.lists(alphabet, min_size=30, max_size=60))
    def check(texts):
        assert read(spark, function, texts) == [model(t) for t in texts]

    check()


def test_run_time_is_written_as_given(spark):
    now = datetime(2024, 7, 1, 12, 30, tzinfo=UTC)
    found = spark.range(2).select(coerce.ingested_at(now).alias("t")).distinct().collect()
    assert [r.t for r in found] == [now.replace(tzinfo=None)]
