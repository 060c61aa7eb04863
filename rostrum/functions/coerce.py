"""Column functions that turn loosely typed document text into typed values.

None of them raises: what cannot be read becomes NULL (the session runs in ANSI
mode, so plain casts would fail the job).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space in the source documents.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The separators among them do not count around a number.
_NUMBER_MARGIN = WHITESPACE.translate({c: None for c in range(0x1C, 0x20)})

_ISO_DAY = r"^\d{4}-\d{2}-\d{2}\z"
_COMPACT_DAY = r"(?s)^\d{8}(?:..)?\z"
_WEEK_DAY = r"(?s)^\d{4}(?:-W\d{2}(?:-[1-7])?|W\d{2}(?:[1-7](?:..)?)?)\z"
_LOOSE_DAY = r"^\d{4}-\d{1,2}-\d{1,2}\z"
_ZONE = r"(?:[+-]\d{2}(?::?\d{2}){0,2})?"
_ISO_INSTANT = rf"^\d{{4}}-\d{{2}}-\d{{2}}(?s:.)\d{{2}}:\d{{2}}:\d{{2}}(?:[.,]\d+)?{_ZONE}\z"
_MIXED_INSTANT = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})"
    rf"(?:(?s:.)(\d{{2}})(?:(:?)(\d{{2}})(?:\6(\d{{2}})([.,]\d+)?)?)?({_ZONE}))?\z"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def to_str(text: Column) -> Column:
    """Text without surrounding white space; nothing left means NULL."""
    return F.nullif(strip(text), F.lit(""))


def _dashed(day: Column) -> Column:
    return F.concat_ws("-", day.substr(1, 4), day.substr(5, 2), day.substr(7, 2))


def _week_date(day: Column) -> Column:
    digits = F.translate(day, "-W", "")
    year, week = digits.substr(1, 4).cast("int"), digits.substr(5, 2).cast("int")
    weekday = F.coalesce(digits.substr(7, 1).try_cast("int"), F.lit(1))
    first_monday = F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week")
    monday = F.date_add(first_monday, (week - 1) * 7)
    exists = (week >= 1) & (F.year(F.date_add(monday, 3)) == year)
    return F.when(exists, F.date_add(monday, weekday - 1))


def to_date(text: Column) -> Column:
    """Date from the first ten characters: ``2024-07-01``, ``20240701`` or ``2024-W27-1``.

    The forms without dashes may go on, so ``20240701150000000`` is a date too.
    """
    day = text.substr(1, 10)
    return (
        F.when(day.startswith("0000"), F.lit(None).cast("date"))
        .when(day.rlike(_ISO_DAY), day.try_cast("date"))
        .when(day.rlike(_COMPACT_DAY), _dashed(day).try_cast("date"))
        .when(day.rlike(_WEEK_DAY), _week_date(day))
    )


def _rebuilt_instant(text: Column) -> Column:
    def part(group: int, default: str) -> Column:
        found = F.nullif(F.regexp_extract(text, _MIXED_INSTANT, group), F.lit(""))
        return F.coalesce(found, F.lit(default))

    return F.concat(
        part(1, ""), F.lit("-"), part(3, ""), F.lit("-"), part(4, ""),
        F.lit("T"), part(5, "00"), F.lit(":"), part(7, "00"), F.lit(":"), part(8, "00"),
        F.translate(part(9, ""), ",", "."), part(10, ""),
    )


def to_ts(text: Column) -> Column:
    """ISO date-time as an instant; ``Z`` is allowed and no zone means UTC.

    Needs the session time zone to be UTC.
    """
    plain = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    usual = F.concat(plain.substr(1, 10), F.lit("T"), plain.substr(F.lit(12), F.length(plain)))
    return (
        F.when(plain.startswith("0000"), F.lit(None).cast("timestamp"))
        .when(plain.rlike(_ISO_DAY), plain.try_cast("timestamp"))
        .when(plain.rlike(_ISO_INSTANT), F.translate(usual, ",", ".").try_cast("timestamp"))
        .when(plain.rlike(_MIXED_INSTANT), _rebuilt_instant(plain).try_cast("timestamp"))
    )


def to_int(text: Column) -> Column:
    """Whole number, ``_`` allowed between digits; anything else is NULL."""
    trimmed = F.btrim(text, F.lit(_NUMBER_MARGIN))
    digits = F.when(trimmed.rlike(r"^[+-]?\d+(?:_\d+)*\z"), F.replace(trimmed, F.lit("_"), F.lit("")))
    return digits.try_cast("bigint")


def to_bool(text: Column) -> Column:
    """True for ``1``; every other non-NULL text, ``true`` included, is false."""
    return strip(text) == "1"


def to_bool_loose(text: Column) -> Column:
    word = F.lower(strip(text))
    return F.when(word.isin("true", "1"), True).when(word.isin("false", "0"), False)


def to_bool_word(text: Column) -> Column:
    return F.lower(text) == "true"


def safe_cast_date(text: Column) -> Column:
    """``YYYY-M-D`` text as a date, else NULL (so compact stamps give NULL)."""
    return F.when(text.rlike(_LOOSE_DAY), text.try_cast("date"))


def leading_date(text: Column) -> Column:
    """Date of a stamp such as ``20241001150000000``, else as :func:`safe_cast_date`."""
    return F.coalesce(
        safe_cast_date(text),
        F.when(text.rlike(r"^\d{8,}\z"), _dashed(text).try_cast("date")),
    )


def ingested_at(run_time: datetime) -> Column:
    """The one load time of a run, chosen by the caller and written on every row."""
    return F.lit(run_time.isoformat()).cast("timestamp")
