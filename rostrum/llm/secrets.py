"""Secret scans in SQL functions only: known forms, and strings of high entropy.

Offsets come from splitting at the same expression that extracts the matches:
the pieces between matches and the matches in turn make up the text, so running
lengths give every start and end in code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import texts

# The base forms, the group that must be long enough, and how long.
_KEYWORD = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
BASE = {
    "assign": (rf"""{_KEYWORD}["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
KINDS = (*BASE, "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
# Bits per character that the best window of a candidate must reach, by the
# characters it is made of: random strings of the class pass, words do not.
BITS = {"hex": 2.9, "alphanumeric": 3.6, "base64": 3.7}
# Never secrets: identifiers in dashed form, words without digits, counted-up
# and filler strings; paths as well. Java matches a repeated group of varying
# length by recursion, which a long candidate would exhaust the stack with, so no
# expression here repeats one without a bound.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[A-Za-z_=/+-]+$",
    r"^[0-9_=/+-]+$",
    r"(?i)example|sample|placeholder|0123456789|abcdefghij|xxxxxx",
)
# All characters of candidates; counts are kept by place in this string.
_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"


def _lengths_before(pieces: Column, matches: Column) -> Column:
    """Starts of the matches, from the lengths of what stands before each."""
    steps = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("len")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    return F.aggregate(
        steps,
        start,
        lambda state, step: F.struct(
            (state["at"] + step["gap"] + step["len"]).alias("at"),
            F.concat(state["starts"], F.array(state["at"] + step["gap"])).alias("starts"),
        ),
        lambda state: state["starts"],
    )


def places(text: Column, pattern: str, group: int) -> Column:
    """``array<struct<start, end, found, value>>`` of an expression's matches in a text."""
    shape = "array<struct<start:int,end:int,found:string,value:string>>"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    starts = _lengths_before(F.split(text, pattern, -1), found)
    zipped = F.transform(
        F.arrays_zip(starts.alias("s"), found.alias("f"), value.alias("v")),
        lambda x: F.struct(
            x["s"].alias("start"),
            (x["s"] + F.length(x["f"])).alias("end"),
            x["f"].alias("found"),
            x["v"].alias("value"),
        ),
    )
    # Most texts have no match; they are read once and stop here.
    return F.when(F.regexp_like(text, F.lit(pattern)), zipped).otherwise(F.array().cast(shape))


def _blanked(text: Column, pattern: str, group: int, least: int) -> Column:
    """The text with the matches of an expression that are long enough turned into spaces."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("piece"), found.alias("found"), value.alias("value")
    )
    match = lambda x: F.when(
        F.length(x["value"]) >= least, F.repeat(F.lit(" "), F.length(x["found"]))
    ).otherwise(F.coalesce(x["found"], F.lit("")))
    joined = F.array_join(F.transform(parts, lambda x: F.concat(x["piece"], match(x))), "")
    return F.when(F.regexp_like(text, F.lit(pattern)), joined).otherwise(text)


def best_window_bits(text: Column, window: int = WINDOW) -> Column:
    """The greatest Shannon entropy, in bits per character, of ``window`` characters in a row.

    The counts of characters and their sum of n log2 n are carried from window to
    window: a step takes one from the count of the character that leaves and adds
    one to that of the character that enters. Characters must be in ``_CHARS``.
    """
    terms = F.array(*(F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 1)))
    many = len(_CHARS)

    def put(counts: Column, place: Column, n: Column) -> Column:
        return F.concat(
            F.slice(counts, F.lit(1), place), F.array(n), F.slice(counts, place + 2, F.lit(many))
        )

    def enter(state: Column, place: Column) -> Column:
        n = state["counts"][place]
        total = state["sum"] + terms[n + 1] - terms[n]
        return F.struct(put(state["counts"], place, n + 1).alias("counts"), total.alias("sum"))

    def best(places: Column) -> Column:
        def step(state: Column, at: Column) -> Column:
            out, into = places[at], places[at + window]
            n = state["counts"][out]
            m = state["counts"][into]
            total = state["sum"] + terms[n - 1] - terms[n] + terms[m + 1] - terms[m]
            counts = put(put(state["counts"], out, n - 1), into, m + 1)
            moved = F.struct(
                counts.alias("counts"), total.alias("sum"), F.least(state["least"], total).alias("least")
            )
            return F.when(out == into, state).otherwise(moved)

        none = F.struct(F.array_repeat(F.lit(0), many).alias("counts"), F.lit(0.0).alias("sum"))
        start = F.aggregate(
            F.slice(places, 1, window),
            none,
            enter,
            lambda s: F.struct(s["counts"].alias("counts"), s["sum"].alias("sum"), s["sum"].alias("least")),
        )
        moves = F.when(
            F.size(places) > window, F.sequence(F.lit(0), F.size(places) - (window + 1))
        ).otherwise(F.array().cast("array<int>"))
        return F.aggregate(moves, start, step, lambda s: s["least"])

    places = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(_CHARS), c) - 1)
    # Inside a function of one element the places are computed once, not once a step.
    least = F.element_at(F.transform(F.array(places), best), 1)
    return F.lit(math.log2(window)) - least / window


def _is_path(value: Column) -> Column:
    """Two names or more, each followed by a slash, in lower case."""
    slashes = F.length(value) - F.length(F.replace(value, F.lit("/"), F.lit("")))
    lead = F.startswith(value, F.lit("/")).cast("int")
    return value.rlike("^[a-z0-9_./-]+$") & ~F.contains(value, F.lit("//")) & (slashes - lead >= 2)


def _is_secret(value: Column) -> Column:
    """Random enough, and neither a path nor allowed for what stands behind the last ``=``.

    What stands before it is a name, which says nothing about the value; ``=`` at
    the very end is padding.
    """
    behind = F.regexp_extract(value, "([^=]*=*)$", 1)
    allowed = _is_path(value)
    for pattern in ALLOWED:
        allowed = allowed | behind.rlike(pattern)
    needed = (
        F.when(value.rlike("^[0-9a-f]+$|^[0-9A-F]+$"), F.lit(BITS["hex"]))
        .when(value.rlike("^[A-Za-z0-9]+$"), F.lit(BITS["alphanumeric"]))
        .otherwise(F.lit(BITS["base64"]))
    )
    return F.when(allowed, F.lit(False)).otherwise(best_window_bits(value) >= needed)


def _long_enough(least: int):
    return lambda found: F.length(found["value"]) >= least


def _labelled(spans: Column, kind: str) -> Column:
    order = KINDS.index(kind)
    return F.transform(
        spans,
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(order).alias("kind"), x["end"].alias("end")
        ),
    )


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", names[x["kind"]], x["start"], x["end"])), ","
    )


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: base finds by kind, and all spans.

    ``spans`` is ``kind:start:end``, comma-joined, by start and then kind; the
    kind ``entropy`` is a candidate string whose best window is as random as its
    character class allows and that is not on the allow-list. Candidates are
    looked for in what base spans leave of the text: a string that one of them
    covers in part is cut there, and the rest is judged by itself. A null or
    empty text has none. Repeated rows give repeated results; a null id stays.
    """
    rows = texts(docs).withColumn("left", F.col("text"))
    for kind, (pattern, group, least) in BASE.items():
        found = places(F.col("text"), pattern, group)
        rows = rows.withColumn(kind, F.filter(found, _long_enough(least)))
        rows = rows.withColumn("left", _blanked(F.col("left"), pattern, group, least))
    rows = rows.withColumn(
        "entropy", F.filter(places(F.col("left"), CANDIDATE, 0), lambda x: _is_secret(x["value"]))
    )
    rows = rows.withColumn("base", F.concat(*(_labelled(F.col(k), k) for k in BASE)))
    rows = rows.withColumn("more", _labelled(F.col("entropy"), "entropy"))
    return rows.select(
        "doc_id",
        *(F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in BASE),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.concat("base", "more")).alias("spans"),
        F.size("more").cast("bigint").alias("n_entropy"),
    )
