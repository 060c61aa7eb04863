"""Document fingerprints by consistent weighted sampling, in SQL functions only.

The terms of a text are its words, weighted by how often they occur. For sample
k a term with weight w draws, from hashes of itself and k alone, r and c from
Gamma(2, 1) and b uniformly; with t = floor(ln w / r + b) its key is
ln c - r (t - b + 1), and the term of the least key is the sample. Two texts have
the same sample with the probability of their generalised Jaccard similarity,
the sum of the smaller weights over the sum of the larger ones. The key tells
samples apart, so it stands for term and t.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.llm.common import texts

SAMPLES = 32
ROWS_PER_RANGE = 500  # documents that are ordered together; a range is never larger by more than sampling error
MOST_RANGES = 1 << 16


def weighted_terms(words: Column) -> Column:
    """``array<struct<term, weight>>`` of an array of words: hashes, and how often each occurs."""

    def named(value: Column, use) -> Column:
        """``use`` of a value that is computed once, as a lambda variable."""
        return F.flatten(F.transform(F.array(value), use))

    def last_places(ordered: Column) -> Column:
        size = F.size(ordered)
        return F.filter(
            F.sequence(F.lit(1), size),
            lambda i: (i == size) | (F.get(ordered, i - 1) != F.get(ordered, i)),
        )

    def counted(ordered: Column, ends: Column) -> Column:
        return F.transform(
            ends,
            lambda end, nth: F.struct(
                F.get(ordered, end - 1).alias("term"),
                (end - F.when(nth == 0, F.lit(0)).otherwise(F.get(ends, nth - 1))).alias("weight"),
            ),
        )

    hashed = F.sort_array(F.transform(words, lambda w: F.xxhash64(w)))
    found = named(hashed, lambda ordered: named(last_places(ordered), lambda ends: counted(ordered, ends)))
    empty = F.array().cast("array<struct<term:bigint,weight:int>>")
    return F.when(F.size(words) == 0, empty).otherwise(found)


def words(text: Column) -> Column:
    """Lower-case words between white space."""
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def sample_key(term: Column, log_weight: Column, sample: int) -> Column:
    """The key of a term in a sample; the least key of a text's terms is drawn."""

    def uniform(bits: Column) -> Column:  # of 32 bits, never 0 or 1
        return (bits + 0.5) / float(1 << 32)

    def halves(hashed: Column) -> tuple[Column, Column]:
        return uniform(F.shiftrightunsigned(hashed, 32)), uniform(hashed.bitwiseAND(F.lit(0xFFFFFFFF)))

    first, second = F.xxhash64(term, F.lit(2 * sample)), F.xxhash64(term, F.lit(2 * sample + 1))
    (u1, u2), (u3, u4) = halves(first), halves(second)
    b = uniform(F.shiftrightunsigned(first.bitwiseXOR(F.shiftleft(second, 17)), 32))
    r = -F.ln(u1 * u2)
    log_c = F.ln(-F.ln(u3 * u4))
    return log_c - r * (F.floor(log_weight / r + b) - b + 1)


def _ranges(rows: DataFrame) -> list[int]:
    """The first document id of each range: existing ids that deal the documents evenly."""
    n = max(1, min(MOST_RANGES, rows.count() // ROWS_PER_RANGE))
    cuts = rows.agg(
        F.percentile_approx("doc_id", [i / n for i in range(n)] if n > 1 else [0.0], max(10_000, 10 * n)).alias("cuts"),
        F.min("doc_id").alias("least"),
    ).first()
    return sorted({cuts["least"], *cuts["cuts"]}) if cuts["cuts"] else []


def _range_of(doc_id: Column, cuts: list[int]) -> Column:
    """Number of the range, from 1, found in two steps; a null id is in the last."""
    step = math.isqrt(len(cuts)) + 1
    every = _constant(cuts)
    heads = _constant(cuts[::step])
    block = F.greatest(F.size(F.filter(heads, lambda x: x <= doc_id)) - 1, F.lit(0))
    inside = F.filter(F.slice(every, block * step + 1, step), lambda x: x <= doc_id)
    return F.when(doc_id.isNull(), F.lit(len(cuts))).otherwise(block * step + F.size(inside))


def _constant(numbers: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")


def _likeness(a: Column, b: Column) -> Column:
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    none = (F.size(a) == 0) | (F.size(b) == 0)
    return F.when(none, (F.size(a) == F.size(b)).cast("double")).otherwise(same / F.size(a))


def _written(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of each document and of its edited text, and what they are like.

    The edited text has its last floor(n / 2) code points replaced by the first as
    many of the next document, by id; after the last comes the first. Columns:
    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. A null text is empty; a text without words has an
    empty fingerprint, alike to such others only. Null ids come last, rows of
    equal id are ordered by text, no documents give no rows.

    The next document is found inside a range of ids. Each range also gets the
    first document of the one that follows, so texts are shuffled once.
    """
    rows = texts(docs)
    cuts = _ranges(rows)
    if not cuts:  # no ids to order by: every row is in one place in the order of its text
        cuts = [0]
    at = _range_of(F.col("doc_id"), cuts)
    first = F.get(_constant(cuts), F.col("_at") - 1) == F.col("doc_id")
    before = F.when(F.col("_at") == 1, F.lit(len(cuts))).otherwise(F.col("_at") - 1)
    placed = rows.withColumn("_at", at).select(
        "doc_id",
        "text",
        F.explode(
            F.when(
                F.coalesce(first, F.lit(cuts == [0])),
                F.array(F.struct(F.col("_at").alias("at"), F.lit(0).alias("guest")), F.struct(before.alias("at"), F.lit(1).alias("guest"))),
            ).otherwise(F.array(F.struct(F.col("_at").alias("at"), F.lit(0).alias("guest"))))
        ).alias("_place"),
    ).select("doc_id", "text", "_place.at", "_place.guest")
    in_range = Window.partitionBy("at").orderBy("guest", F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    paired = (
        placed.withColumn("following", F.lead("text").over(in_range))
        .withColumn("place", F.row_number().over(in_range))
        .withColumn(
            "edited",
            F.concat(
                F.substring(F.col("text"), F.lit(1), F.length("text") - half),
                F.substring(F.coalesce("following", F.lit("")), F.lit(1), half),
            ),
        )
        .select(
            "at", "place", "guest", "doc_id",
            F.length("text").cast("bigint").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            words(F.col("text")).alias("words"),
            F.when(F.col("guest") == 0, words(F.col("edited"))).otherwise(F.array().cast("array<string>")).alias("edited_words"),
        )
    )
    sided = F.concat(
        F.transform(weighted_terms(F.col("words")), lambda x: F.struct(F.lit(0).alias("side"), x["term"].alias("term"), x["weight"].alias("weight"))),
        F.transform(weighted_terms(F.col("edited_words")), lambda x: F.struct(F.lit(1).alias("side"), x["term"].alias("term"), x["weight"].alias("weight"))),
    )
    document = ["at", "place", "guest", "doc_id", "n_chars", "edited_sha256"]
    terms = paired.select(*document, F.explode_outer(sided).alias("x")).select(
        *document, "x.side", "x.term", F.ln(F.col("x.weight").cast("double")).alias("log_weight")
    )
    # Ranges are already together, so this and all below need no further shuffle.
    sampled = terms.groupBy(*document, "side").agg(
        *(F.min(sample_key(F.col("term"), F.col("log_weight"), k)).alias(f"k{k}") for k in range(samples))
    )
    sketch = F.when(F.col("k0").isNotNull(), F.array(*(F.hash(f"k{k}") for k in range(samples))))
    nothing = F.array().cast("array<int>")
    both = sampled.groupBy(*document).agg(
        F.max(F.when(F.col("side") == 0, sketch)).alias("own"), F.max(F.when(F.col("side") == 1, sketch)).alias("edited")
    )
    own, edited = F.coalesce("own", nothing), F.coalesce("edited", nothing)
    following = F.coalesce(F.lead(own).over(Window.partitionBy("at").orderBy("place")), own)
    return (
        both.withColumn("following", following)
        .where("guest = 0")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            _written(own).alias("fingerprint"),
            _written(edited).alias("edited_fingerprint"),
            _likeness(own, edited).alias("near_edited"),
            _likeness(own, F.col("following")).alias("near_next"),
        )
    )
