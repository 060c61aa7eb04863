"""Exact Jaccard self-join of word n-gram sets, by partitioning the universe of n-grams.

Two sets that are similar enough differ in at most H elements, where H follows
from their sizes. Hash the universe into segments, and let v+1 be what it costs
a pair to escape a segment of allowance v: one difference if the segment must be
equal (v = 0), two if one deletion is forgiven (v = 1). If the allowances of a
set sum, each plus one, to H + 1 or more, a similar pair cannot escape all of
them. So sets meet under the hashes of their segments:

* sizes fall into bands; a pair is looked for in the band of its larger set, and
  a set is indexed in every band that its partners may belong to;
* every segment of a set is indexed; the set itself probes only with as many as
  it needs, chosen by cost: the fullest segments first, as they are rarest, then
  one-deletion neighbourhoods of small segments, and empty ones last;
* sets under one hash are first compared with one centre, the document that meets
  most others. Only where that leaves more than one component are the pairs
  across components formed.

Most pairs that meet are not similar. Each set has a sketch of ``SKETCH`` longs, the
parities of its elements by hash: two sets differ in at least as many elements as
their sketches do in bits, so pairs beyond the differences allowed go before any
text is shipped. Large sets, of which so few bits tell little, have a second sketch
as wide as the set. Every other pair is verified on the whole sets; only texts of
such pairs are shuffled, told from the others by a bounded bitmap of documents.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.llm.common import keep, texts
from rostrum.llm.components import components

BAND = 1.25  # ratio of the largest size of a band to its smallest
NEIGHBOURS_IN = 16  # one-deletion neighbourhoods are indexed in so many segments of a band
MEMBERS_PER_CHUNK = 256  # documents verified against one copy of their centre
CHUNK_BYTES = 1 << 20  # texts hashed at once
SKETCH = 8  # longs of a sketch
MARKS = 1 << 17  # rows of 64 bits that tell which documents may be wanted

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_POWERS[0]) < n:
        size = 1 << n.bit_length()
        inverse = pow(_BASE, -1, 1 << 64)
        for i, base in enumerate((_BASE, inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS


def word_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of texts laid end to end, and the number of its text.

    ``edges`` are the bounds of the texts. A word's hash is its polynomial over
    bytes, taken from running sums, so no word is handled one by one.
    """
    data = _LOWER[data]
    inside = ~_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    inner = edges[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    starts[inner] |= inside[inner]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[inner - 1] |= inside[inner - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    powers, inverses = _powers(len(data) + 1)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=running[1:])
    found = (running[last] - running[first]) * inverses[first]
    return mix(found ^ (last - first).astype(np.uint64)), np.searchsorted(edges, first, side="right") - 1


def shingle_sets(buffers: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text: their hashes, sorted within a text, and counts per text."""
    edges = np.concatenate([[0], np.cumsum([len(b) for b in buffers])])
    data = np.frombuffer(b"".join(buffers), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(buffers), np.int64)
    word, text = word_hashes(data, edges)
    per_text = np.bincount(text, minlength=len(buffers))
    # Texts with fewer words are one shingle: pad the hash with nothing.
    begin = np.cumsum(per_text) - per_text
    place = np.arange(len(word)) - begin[text]
    shingle = np.zeros(len(word), np.uint64)
    for i in range(words):
        there = place + i < per_text[text]
        at = np.minimum(np.arange(len(word)) + i, len(word) - 1)
        shingle = mix(shingle * _ODD + np.where(there, word[at], np.uint64(7 + i)))
    full = (place + words <= per_text[text]) | ((place == 0) & (per_text[text] < words))
    shingle, text = shingle[full], text[full]
    order = np.lexsort((shingle, text))
    shingle, text = shingle[order], text[order]
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (text[1:] != text[:-1])
    return shingle[new], np.bincount(text[new], minlength=len(buffers))


@dataclass(frozen=True)
class Band:
    number: int
    low: int
    high: int
    differences: int  # H of the largest pair of the band
    segments: int


@lru_cache(maxsize=8)
def bands(percent: int, upto: int) -> tuple[Band, ...]:
    """Size bands covering sizes 1 to ``upto``."""
    out, low = [], 1
    while low <= upto:
        high = max(low, int(low * BAND))
        differences = 2 * high * (100 - percent) // (100 + percent)
        spare = 1 + differences // 20 if differences else 0
        out.append(Band(len(out), low, high, differences, differences + 1 + spare))
        low = high + 1
    return tuple(out)


def _sum_by(group: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2**64 of 64-bit values by group; halves keep floating sums exact."""
    low = np.bincount(group, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n).astype(np.uint64)
    high = np.bincount(group, (value >> np.uint64(32)).astype(np.float64), n).astype(np.uint64)
    return low + (high << np.uint64(32))


def _key(total, count, segment, band) -> np.ndarray:
    of_band = np.uint64(band * 0xD6E8FEB86659FD93 % (1 << 64))
    where = of_band + segment.astype(np.uint64) * _ODD
    return mix(mix(total + count.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)) ^ where)


def band_keys(sets: list[np.ndarray], band: Band, probing: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set number, key and whether it probes, of every index entry of sets in a band."""
    m, sizes = band.segments, np.array([len(s) for s in sets])
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    segment = ((element >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
    cell = owner * m + segment
    value = mix(element * _ODD)
    total = _sum_by(cell, value, len(sets) * m)
    count = np.bincount(cell, minlength=len(sets) * m)
    of_set, of_segment = np.divmod(np.arange(len(sets) * m), m)
    key = _key(total, count, of_segment, band.number)

    # Probes: the fullest segments, as many as needed.
    order = np.lexsort((of_segment, -count, of_set))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.tile(np.arange(m), len(sets))
    needed = band.differences + 1
    probe = (rank < needed) & probing[of_set]
    own, keys, probes = [of_set], [key], [probe]

    # One-deletion neighbourhoods: segments of three are indexed for those of two.
    near = of_segment < NEIGHBOURS_IN
    in_cell = near[cell] & (count[cell] == 3)
    c = cell[in_cell]
    own.append(of_set[c])
    keys.append(_key(total[c] - value[in_cell], count[c] - 1, of_segment[c], band.number))
    probes.append(np.zeros(len(c), bool))

    # A set with too few filled segments forgives a deletion in small ones before it probes empty ones.
    filled = np.bincount(of_set, count > 0, len(sets))
    for i in np.flatnonzero(probing & (filled < needed)):
        mine = slice(i * m, (i + 1) * m)
        small = np.flatnonzero((count[mine] == 2) & near[mine])
        missing = int(needed - filled[i])
        forgiven = small[:missing]
        probe[mine] = count[mine] > 0
        empty = np.flatnonzero(count[mine] == 0)[: missing - len(forgiven)]
        probe[i * m + empty] = True
        chosen = np.isin(cell, i * m + forgiven)
        c = cell[chosen]
        own.append(of_set[c])
        keys.append(_key(total[c] - value[chosen], count[c] - 1, of_segment[c], band.number))
        probes.append(np.ones(len(c), bool))
    return np.concatenate(own), np.concatenate(keys), np.concatenate(probes)


def index_entries(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set number, key and whether it probes, over all bands, of non-empty sets."""
    sizes = np.array([len(s) for s in sets])
    all_bands = bands(percent, 1 << int(sizes.max() * 100 // percent + 1).bit_length())
    lows = np.array([b.low for b in all_bands])
    own = np.searchsorted(lows, sizes, side="right") - 1
    last = np.searchsorted(lows, sizes * 100 // percent, side="right") - 1
    out = []
    for number in range(int(own.min()), int(last.max()) + 1):
        members = np.flatnonzero((own <= number) & (number <= last))
        if len(members):
            of_set, key, probe = band_keys([sets[i] for i in members], all_bands[number], own[members] == number)
            out.append((members[of_set], key, probe))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)) or not len(a):
        return False
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def _chunks(texts: list[str]):
    """Ranges of texts of about ``CHUNK_BYTES``, with their bytes."""
    at, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text.encode())
        size += len(held[-1])
        if size >= CHUNK_BYTES or i + 1 == len(texts):
            yield at, held
            at, held, size = i + 1, [], 0


_ENTRIES = pa.schema(
    [("key", pa.int64()), ("doc_id", pa.int64()), ("tag", pa.int64())]
    + [(name, pa.list_(pa.int64())) for name in ("sketch", "wide")]
)
_ENTRIES_DDL = "key bigint, doc_id bigint, tag bigint, sketch array<bigint>, wide array<bigint>"
_ALONE = np.uint64(0x1234567)


def sketches(owner: np.ndarray, element: np.ndarray, n: int) -> np.ndarray:
    """``SKETCH`` longs for each of ``n`` sets: whether the elements that hash to a bit are odd in number."""
    bit = element & np.uint64(64 * SKETCH - 1)
    out = np.zeros(n * SKETCH, np.uint64)
    np.bitwise_xor.at(out, owner * SKETCH + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out.view(np.int64)


def wide_sketch(elements: np.ndarray) -> np.ndarray | None:
    """A sketch with as many bits as a large set has elements, at least; the longs are a power of two."""
    if len(elements) <= 64 * SKETCH:
        return None
    longs = 1 << (-(-len(elements) // 64) - 1).bit_length()
    odd = np.bincount((elements & np.uint64(64 * longs - 1)).astype(np.int64), minlength=64 * longs) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8")


def _entries(batches, words: int, percent: int):
    """Index entries; ``tag`` is 1 for a probe, and for the one entry that stands for
    the document itself (under the hash of its whole set, with its sketches) -1 - size."""
    seen: set[int] = set()
    for batch in batches:
        ids = batch.column(0)
        numbers = ids.fill_null(-1).to_numpy(zero_copy_only=False)
        valid = ids.is_valid().to_numpy(zero_copy_only=False)
        for at, held in _chunks(batch.column(1).to_pylist()):
            element, counts = shingle_sets(held, words)
            n = len(held)
            doc, ok = numbers[at : at + n], valid[at : at + n]
            owner = np.repeat(np.arange(n), counts)
            whole = mix(_sum_by(owner, mix(element * _ODD), n) ^ (counts.astype(np.uint64) * _ODD))
            alone = ~ok | (counts == 0)
            whole[alone] = mix((doc[alone].astype(np.uint64) + np.arange(n, dtype=np.uint64)[alone] * _ODD) ^ _ALONE)
            sets = np.split(element, np.cumsum(counts)[:-1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(whole.view(np.int64)),
                    pa.array(doc, mask=~ok),
                    pa.array(-1 - counts),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(n + 1, dtype=np.int32) * SKETCH), pa.array(sketches(owner, element, n))
                    ),
                    pa.array([wide_sketch(x) for x in sets], _ENTRIES.field("wide").type),
                ],
                schema=_ENTRIES,
            )
            # Of equal sets in this task one enters the index.
            new = []
            for i, h in enumerate(whole.tolist()):
                if not alone[i] and h not in seen:
                    seen.add(h)
                    new.append(i)
            if new:
                of_set, key, probe = index_entries([sets[i] for i in new], percent)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(doc[new][of_set]),
                        pa.array(probe.astype(np.int64)),
                        *(pa.nulls(len(key), _ENTRIES.field(name).type) for name in ("sketch", "wide")),
                    ],
                    schema=_ENTRIES,
                )


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _verify(batches, words: int, percent: int):
    """Links among rows sorted by centre and chunk, in which a centre comes before its members."""
    centre, sets = None, []
    for batch in batches:
        found: list[tuple[int, int]] = []
        rows = list(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
        for at, held in _chunks([row[3] for row in rows]):
            element, counts = shingle_sets(held, words)
            for (c, chunk, doc, _), mine in zip(rows[at:], np.split(element, np.cumsum(counts)[:-1])):
                if doc is None:
                    if centre != (c, chunk):
                        centre, sets = (c, chunk), []
                    sets.append(mine)
                elif any(similar(mine, other, percent) for other in sets):
                    found.append((c, doc))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], schema=_LINKS)


ZONES = 16
_ELEMENTS = pa.schema([(n, pa.int64()) for n in ("owner", "element", "centre", "centre_size", "gone", "zones")])
_ELEMENTS_DDL = ", ".join(f"{n} bigint" for n in _ELEMENTS.names)


def zone_counts(elements: np.ndarray) -> int:
    """Elements in each of 16 zones of the universe, up to 15 each, in 4 bits."""
    counts = np.minimum(np.bincount((elements >> np.uint64(60)).astype(np.int64), minlength=ZONES), 15)
    return int((counts.astype(np.uint64) << (np.arange(ZONES, dtype=np.uint64) * np.uint64(4))).sum().view(np.int64))


def _differences(batches, words: int):
    """Elements of each centre, and those of its members that it lacks; and for each
    member how many of the centre's it lacks itself, in all and by zone."""
    centre, known = None, np.zeros(0, np.uint64)
    for batch in batches:
        out: dict[str, list] = {name: [] for name in _ELEMENTS.names}
        rows = list(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
        for at, held in _chunks([row[3] for row in rows]):
            element, counts = shingle_sets(held, words)
            for (c, chunk, doc, _), mine in zip(rows[at:], np.split(element, np.cumsum(counts)[:-1])):
                own = doc
                if doc is None:
                    known = np.union1d(known, mine) if centre == (c, chunk) else mine
                    centre, own = (c, chunk), c
                    mine = mine if chunk == 0 else mine[:0]
                else:
                    gone = np.setdiff1d(known, mine, assume_unique=True)
                    mine = np.setdiff1d(mine, known, assume_unique=True)
                    row = (doc, None, c, len(known), len(gone), zone_counts(gone))
                    for name, value in zip(_ELEMENTS.names, row, strict=True):
                        out[name].append(value)
                out["owner"] += [own] * len(mine)
                out["element"] += mine.view(np.int64).tolist()
                for name in _ELEMENTS.names[2:]:
                    out[name] += [None] * len(mine)
        yield pa.RecordBatch.from_pydict(out, schema=_ELEMENTS)


def _mark(doc_id: str) -> tuple[Column, Column]:
    """Slot and bit of a document among the marks."""
    h = F.xxhash64(doc_id)
    return F.pmod(h, F.lit(MARKS)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(63)).cast("int")


def _maybe(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The ``rows`` of the documents ``_doc`` of ``wanted``, and few others, without a shuffle of texts.

    At most ``MARKS`` marks reach a task; of more documents they let more rows through.
    """
    slot, bit = _mark("_doc")
    marks = wanted.select(slot.alias("_slot"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("_bit"))
    marks = marks.groupBy("_slot").agg(F.bit_or("_bit").alias("_bits"))
    slot, bit = _mark("doc_id")
    marked = F.call_function("shiftrightunsigned", F.col("_bits"), bit).bitwiseAND(F.lit(1)) == 1
    return rows.join(F.broadcast(marks), (slot == F.col("_slot")) & marked, "left_semi")


def _shipped(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Texts of pairs ``(a, b)``, sorted so that a centre ``a`` comes before its members; ``b`` may be null.

    A centre of many pairs is split into chunks, each with its own copy of the
    centre's text, so that none is handled in one task alone.
    """
    # Counted beside the pairs: a window spills where a centre has very many.
    pairs = pairs.withColumn(
        "chunks", F.ceil(F.count(F.lit(1)).over(Window.partitionBy("a")) / MEMBERS_PER_CHUNK).cast("int")
    )
    chunks = pairs.groupBy("a").agg(F.max("chunks").alias("chunks"))
    members = pairs.where(F.col("b").isNotNull()).select(
        F.col("b").alias("_doc"), "a", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("chunk"), F.col("b").alias("member")
    )
    centres = chunks.select(
        F.col("a").alias("_doc"), "a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(None).cast("bigint").alias("member")
    )
    wanted = members.unionByName(centres)
    return (
        wanted.join(_maybe(rows, wanted), F.col("_doc") == F.col("doc_id"))
        .select("a", "chunk", "member", "text")
        .repartition("a", "chunk")
        .sortWithinPartitions("a", "chunk", F.col("member").asc_nulls_first())
    )


def _linked(pairs: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets are similar; ``rows`` holds the texts."""
    return _shipped(pairs, rows).mapInArrow(partial(_verify, words=words, percent=percent), "a bigint, b bigint")


def _still_open(index: DataFrame, reached: DataFrame) -> DataFrame:
    """Index entries, with their document's component, of keys under which components differ."""
    placed = index.join(reached, index["doc_id"] == reached["node"], "left").select(
        "key", "doc_id", "probes", "meets", "size", F.coalesce("root", "doc_id").alias("root")
    )
    split = placed.groupBy("key").agg(F.min("root").alias("_from"), F.max("root").alias("_to")).where("_from < _to")
    return placed.join(split.select("key"), "key", "left_semi")


def _by_centre(pairs: DataFrame) -> DataFrame:
    """The pairs with the document of more pairs first, so that its text is shipped once."""
    ends = pairs.select("a").union(pairs.select("b")).groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    first, second = (ends.select(F.col("a").alias(end), F.col("n").alias(f"n_{end}")) for end in ("a", "b"))
    turn = F.col("n_b") > F.col("n_a")
    return pairs.join(first, "a").join(second, "b").select(
        F.when(turn, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turn, F.col("a")).otherwise(F.col("b")).alias("b")
    )


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _may_link(percent: int) -> Column:
    """Whether the sketches of two documents leave them similar; those without a sketch are."""
    differ = sum(
        F.bit_count(F.get("sketch_a", F.lit(i)).bitwiseXOR(F.get("sketch_b", F.lit(i)))) for i in range(SKETCH)
    )
    return _allowed(differ, percent)


def _allowed(differ: Column, percent: int) -> Column:
    allowed = (100 - percent) * (F.col("size_a") + F.col("size_b"))
    return F.coalesce((100 + percent) * differ <= allowed, F.lit(True))


def _may_link_wide(percent: int) -> Column:
    """The same by wide sketches, of which one twice as long is folded; other lengths rule nothing out."""

    def folded(one: str, other: str) -> Column:
        half = (F.size(one) / 2).cast("int")
        halves = F.zip_with(F.slice(one, F.lit(1), half), F.slice(one, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(one) > F.size(other), halves).otherwise(F.col(one))

    apart = F.zip_with(
        folded("wide_a", "wide_b"), folded("wide_b", "wide_a"), lambda x, y: F.bit_count(x.bitwiseXOR(y))
    )
    differ = F.aggregate(apart, F.lit(0), lambda so_far, n: so_far + n)
    either = F.col("wide_a").isNotNull() & F.col("wide_b").isNotNull()
    return F.when(either, _allowed(differ, percent)).otherwise(True)


def _of_both(pairs: DataFrame, about: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` with the columns of ``about``, named for each end."""
    for end in ("a", "b"):
        named = about.select(F.col("doc_id").alias(f"_{end}"), *(F.col(c).alias(f"{c}_{end}") for c in about.columns if c != "doc_id"))
        pairs = pairs.join(named, F.col(end) == F.col(f"_{end}"), "left").drop(f"_{end}")
    return pairs


def _bounds(open_docs: DataFrame, tried: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """``owner, own, centre, centre_size, gone, zones`` of open documents with one text.

    ``own`` is how many elements a document has that no other open document has,
    at least. Only what it has beyond the centre it was compared with is listed;
    the rest is listed once, with the centre. The other columns say how many
    elements of that centre the document lacks, in all and by zone.
    """
    at_centre = (
        _by_centre(tried).join(open_docs.select(F.col("doc_id").alias("b")), "b", "left_semi").groupBy("b").agg(F.min("a").alias("a"))
    )
    alone = open_docs.join(at_centre, open_docs["doc_id"] == at_centre["b"], "left_anti").select(
        F.col("doc_id").alias("a"), F.lit(None).cast("bigint").alias("b")
    )
    listed = keep(
        _shipped(at_centre.select("a", "b").union(alone), rows).mapInArrow(partial(_differences, words=words), _ELEMENTS_DDL)
    )
    own = (
        listed.where(F.col("element").isNotNull())
        .groupBy("element")
        .agg(F.min("owner").alias("owner"), F.max("owner").alias("other"))
        .where("owner = other")
        .select("owner", F.lit(1).alias("own"))
    )
    lacking = listed.where(F.col("element").isNull()).drop("element")
    several = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    rest = [F.max(c).alias(c) for c in ("centre", "centre_size", "gone", "zones")]
    found = own.unionByName(lacking, allowMissingColumns=True).groupBy("owner").agg(F.sum("own").alias("own"), *rest)
    return found.join(several, found["owner"] == several["doc_id"], "left_anti")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Documents link when 100 * intersection >= percent * union of their sets of
    ``words``-word shingles; ``component_id`` is the smallest id reachable. A
    null or blank text has an empty set and links with nothing. A null id cannot
    be named: its row has no component and links nothing. Rows with one id are
    one document, linked if any of its texts is. No documents give no rows.
    """
    rows = texts(docs)
    entries = rows.mapInArrow(partial(_entries, words=words, percent=percent), _ENTRIES_DDL)
    under = Window.partitionBy("key")
    met = (
        entries.withColumn("first", F.min("doc_id").over(under))
        .withColumn("last", F.max("doc_id").over(under))
        .withColumn("probed", F.max("tag").over(under))
        .withColumn("whole", F.min("tag").over(under))
    )
    several = (F.col("first") < F.col("last")) & ((F.col("probed") == 1) | (F.col("whole") < -1))
    met = keep(
        met.where((F.col("tag") < 0) | several)
        .select("key", "doc_id", "tag", "sketch", "wide", F.when(several, F.col("first")).alias("first"))
    )
    whole = met.where("tag < 0")
    equal = keep(whole.where("first < doc_id").groupBy(F.col("doc_id").alias("a")).agg(F.min("first").alias("b")))

    # From here on the first of equal documents stands for them all.
    index = met.where("tag >= 0")
    index = keep(
        index.join(equal, index["doc_id"] == equal["a"], "left")
        .groupBy("key", F.coalesce("b", "doc_id").alias("doc_id"))
        .agg(F.max("tag").alias("probes"))
    )
    # How often a document meets others: of edited copies, what they were made from meets most.
    met_under = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    meets = index.join(met_under, "key").groupBy("doc_id").agg(F.sum("n").alias("meets"))
    # A document of several texts has no one sketch.
    sketch = (F.when(F.count(F.lit(1)) == 1, F.first(c)).alias(c) for c in ("sketch", "wide"))
    size = whole.groupBy("doc_id").agg(F.max(-1 - F.col("tag")).alias("size"), *sketch)
    about = keep(meets.join(size, "doc_id"))
    sketched = about.select("doc_id", "size", "sketch")
    wide = about.select("doc_id", "wide").where("wide is not null")
    index = keep(index.join(about.drop("sketch", "wide"), "doc_id").join(met_under, "key", "left_semi"))

    open_ = keep(_still_open(index, equal.select(F.col("a").alias("node"), F.col("b").alias("root"))))
    # Each document tries one centre: of its keys' centres that may be similar to it the one that meets most.
    centres = (
        open_.withColumn("_most", F.max(F.struct("meets", "doc_id", "size")).over(under))
        .where("_most.doc_id <> doc_id")
        .where(100 * F.least("size", "_most.size") >= percent * F.greatest("size", "_most.size"))
        .groupBy(F.col("doc_id").alias("a"), F.col("_most.doc_id").alias("b"))
        .agg(F.max("_most.meets").alias("meets"))
    )
    centres = keep(_of_both(centres, sketched).where(_may_link(percent)).select("a", "b", "meets", "size_a", "size_b"))
    star = (
        _of_both(centres, wide)
        .where(_may_link_wide(percent))
        .groupBy("a")
        .agg(F.max(F.struct("meets", "b")).alias("_most"))
        .select("a", F.col("_most.b").alias("b"))
    )
    tried = keep(_ordered(star))
    links = keep(equal.union(_linked(_by_centre(tried), rows, words, percent)))

    # What is not connected now is settled pair by pair, but for pairs that cannot
    # be similar: their sketches differ too much, or elements of their own leave
    # the two too little in common.
    open_ = keep(_still_open(index, components(links)).join(sketched.select("doc_id", "sketch"), "doc_id"))
    columns = ("doc_id", "root", "size", "probes", "sketch")
    left = open_.where("probes = 1").select("key", *(F.col(c).alias(f"{c}_a") for c in columns))
    right = open_.select("key", *(F.col(c).alias(f"{c}_b") for c in columns))
    possible = (
        (left["key"] == right["key"])
        & (F.col("root_a") != F.col("root_b"))
        & ((F.col("doc_id_a") < F.col("doc_id_b")) | (F.col("probes_b") == 0))
        & (100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))
        & _may_link(percent)
    )
    across = _ordered(left.join(right, possible).select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b")))
    across = keep(across.join(tried, ["a", "b"], "left_anti"))
    across = _of_both(_of_both(across, sketched.select("doc_id", "size")), wide)
    across = keep(across.where(_may_link_wide(percent)).select("a", "b"))
    open_docs = keep(across.select(F.col("a").alias("doc_id")).union(across.select("b")).distinct())
    bounds = keep(_bounds(open_docs, tried, rows, words).withColumnRenamed("owner", "doc_id"))
    across = _of_both(_of_both(across, sketched.select("doc_id", "size")), bounds)

    def own(side: str) -> Column:
        return F.coalesce(f"own_{side}", F.lit(0))

    def enough(common: Column) -> Column:
        return (100 + percent) * common >= percent * (F.col("size_a") + F.col("size_b"))

    def beyond(side: str) -> Column:
        """What a document has in common with others and not with its centre, at most."""
        return F.col(f"size_{side}") - own(side) - F.col(f"centre_size_{side}") + F.col(f"gone_{side}")

    # Of one centre, two documents together lack what either lacks in each zone.
    lacking = sum(
        F.greatest(*(F.shiftrightunsigned(f"zones_{side}", 4 * zone).bitwiseAND(F.lit(15)) for side in "ab"))
        for zone in range(ZONES)
    )
    across = across.where(
        enough(F.least(F.col("size_a") - own("a"), F.col("size_b") - own("b")))
        & (
            ~F.col("centre_a").eqNullSafe(F.col("centre_b"))
            | F.col("centre_a").isNull()
            | enough(F.col("centre_size_a") - lacking + F.least(beyond("a"), beyond("b")))
        )
    )
    across = keep(across.select("a", "b"))
    reached = components(keep(links.union(_linked(across, rows, words, percent))))
    return whole.join(reached, whole["doc_id"] == reached["node"], "left").select(
        "doc_id", (-1 - F.col("tag")).alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents, with all columns, that have the smallest id of their component.

    A document without an id stays.
    """
    found = near_duplicates(docs, words, percent)
    dropped = found.where("component_id < doc_id").select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped, F.col("doc_id") == F.col("_dropped"), "left_anti")
