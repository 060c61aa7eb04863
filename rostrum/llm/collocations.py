"""Phrase collocations, counted over a dictionary of content-triggered chunks.

The tokens of a document are cut wherever a window of ``OVERLAP`` tokens hashes
to a trigger; neighbouring chunks share that window. Where a cut falls depends on
the window alone, so passages that documents share give equal chunks, which are
kept once with the number of their occurrences. Phrases are counted inside
distinct chunks, times that number; a phrase that starts in the shared window is
left to the chunk after it, so each occurrence counts once.

No phrase is frequent that holds a word which is not, so once words are counted
chunks fall into stretches of frequent words, which are folded again: a second,
much smaller dictionary. Longer phrases are counted in it, and only where both
phrases of one word less may be frequent. Bitmaps of bounded size tell which
words and phrases may be; a false hit costs a count that is dropped later, so
results are exact at every size.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cached_property, partial
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostrum.llm.common import keep

LONGEST = 4
# Words that chunks share: a phrase of LONGEST words that starts before them ends in them.
OVERLAP = LONGEST - 1
# One window in so many ends a chunk.
TRIGGER = 32
LEAST = 30
# A candidate goes if a longer one around it occurs this often, in percent of its own.
INSIDE = 80
SCALE = 2_000_000
TOP = 2000
# Parts that the candidates of a language are ranked in before they meet.
PARTS = 64
# Bytes of chunks whose phrases are counted together in a task.
AT_ONCE = 12 << 20
# Bits per frequent phrase, and at most, of the bitmap that tasks get.
BITS_EACH = 16
MOST_BITS = 1 << 27
UNKNOWN = "und"

_BREAK = b"."
_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _BREAK * 10)
_PRIME = np.uint64(0x9E3779B97F4A7C15)

_CHUNK = pa.schema(
    [("lang", pa.string()), ("chunk", pa.binary()), ("own", pa.int32()), ("n", pa.int64())]
)
_CHUNK_DDL = "lang string, chunk binary, own int, n long"
_COUNT = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


def tokens(text: bytes) -> list[bytes]:
    """Words in order, and a break wherever a piece ends; a break is no word."""
    return text.lower().translate(_BREAKS).replace(_BREAK, b" . ").split()


def chunk_starts(found: list[bytes]) -> list[int]:
    """Where the chunks of a token list begin; all but the last reach ``OVERLAP`` into the next."""
    windows = len(found) - OVERLAP
    if windows < 1:
        return [0]
    hashes = np.fromiter(map(crc32, found), np.uint64, len(found))
    mixed = np.zeros(windows, np.uint64)
    for k in range(OVERLAP):
        mixed = (mixed ^ hashes[k : k + windows]) * _PRIME
        mixed ^= mixed >> np.uint64(32)
    triggers = np.flatnonzero(mixed % np.uint64(TRIGGER) == 0).tolist()
    return [0, *(t for t in triggers if t)]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: Counter = Counter()
        langs = batch.column("lang").to_pylist()
        for lang, text in zip(langs, batch.column("text").cast(pa.binary()).to_pylist()):
            found = tokens(text)
            if not found:
                continue
            starts = chunk_starts(found)
            for at, following in zip(starts, starts[1:]):
                seen[lang, b" ".join(found[at : following + OVERLAP]), following - at] += 1
            seen[lang, b" ".join(found[starts[-1] :]), len(found) - starts[-1]] += 1
        if seen:
            yield _chunk_batch(seen)


def _chunk_batch(seen: Counter) -> pa.RecordBatch:
    columns = zip([*zip(*seen), seen.values()], _CHUNK)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=_CHUNK)


def _folded(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("lang", "chunk", "own").agg(F.sum("n").alias("n"))


def dictionary(docs: DataFrame) -> DataFrame:
    """``lang, chunk, own, n``: the distinct chunks of all whole texts and how often each occurs.

    Phrases that start at one of the first ``own`` tokens are the chunk's; the
    others belong to the chunk after it.
    """
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return _folded(rows.mapInArrow(_parse, _CHUNK_DDL))


def _word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def _phrase_hash(langs: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """Hashes of phrases given as columns of word hashes, by language."""
    mixed = langs.copy()
    for column in columns:
        mixed = (mixed ^ column) * _PRIME
        mixed ^= mixed >> np.uint64(29)
    return mixed


class Filter:
    """A bitmap of the hashes of phrases that are frequent; some others pass as well."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        slot, bit = _slots(hashes, len(self.words))
        return (self.words[slot] >> bit) & np.uint64(1) == 1


def _slots(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    spread = hashes >> np.uint64(16)
    return (spread >> np.uint64(6)) & np.uint64(words - 1), spread & np.uint64(63)


def _mark(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        split = [p.split(b" ") for p in batch.column("phrase").cast(pa.binary()).to_pylist()]
        langs = _hashes(x.encode() for x in batch.column("lang").to_pylist())
        slot, bit = _slots(_phrase_hash(langs, [_hashes(c) for c in zip(*split)]), words)
        yield pa.RecordBatch.from_pydict(
            {"slot": slot.astype(np.int64), "bits": (np.uint64(1) << bit).view(np.int64)}
        )


def _hashes(words) -> np.ndarray:
    return np.fromiter(map(_word_hash, words), np.uint64)


def frequent_filter(frequent: DataFrame) -> Filter:
    """The filter of frequent phrases of one length; at most ``MOST_BITS`` bits reach the driver."""
    wanted = max(frequent.count() * BITS_EACH, 1 << 12)
    words = min(1 << (wanted - 1).bit_length(), MOST_BITS) // 64
    marks = frequent.select("lang", "phrase").mapInArrow(partial(_mark, words=words), "slot long, bits long")
    found = marks.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(words, np.uint64)
    bitmap[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Filter(bitmap)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together until they hold ``AT_ONCE`` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= AT_ONCE:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


class _Block:
    """The tokens of some chunks as numbers, with what each token needs to know of its chunk."""

    def __init__(self, block: pa.Table):
        chunks = pc.split_pattern(block["chunk"].combine_chunks(), b" ")
        sizes = chunks.value_lengths().to_numpy().astype(np.int64)
        found = chunks.flatten().dictionary_encode()
        self.ids, self.words = found.indices.to_numpy(), found.dictionary
        self.place = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.ends = np.cumsum(sizes).astype(np.int32)
        self.own_ends = self.ends - sizes.astype(np.int32) + block["own"].to_numpy()
        self.weights = block["n"].to_numpy()
        encoded = block["lang"].combine_chunks().dictionary_encode()
        self.lang_names = encoded.dictionary.to_pylist()
        self.langs = encoded.indices.to_numpy().astype(np.int64)
        self.is_break = self.ids == self.words.index(pa.scalar(_BREAK, pa.binary())).as_py()

    @cached_property
    def hashes(self) -> np.ndarray:
        return _hashes(self.words.to_pylist())

    def named(self, chunks: np.ndarray) -> pa.Array:
        """The languages of chunks."""
        names = pa.array(self.lang_names, pa.string())
        return names.take(pa.array(self.langs[chunks]))

    def passes(self, known: Filter, starts: np.ndarray, length: int) -> np.ndarray:
        """Whether the phrases of ``length`` words at ``starts`` may be frequent."""
        seeds = _hashes(x.encode() for x in self.lang_names)
        columns = [self.hashes[self.ids[starts + k]] for k in range(length)]
        return known(_phrase_hash(seeds[self.langs[self.place[starts]]], columns))

    def phrases(self, length: int, known: Filter | None) -> pa.RecordBatch | None:
        """Counts of the phrases of ``length`` words that the chunks own."""
        here = np.arange(len(self.ids), dtype=np.int32)
        starts = here[(here < self.own_ends[self.place]) & (here + length <= self.ends[self.place])]
        for k in range(length):
            starts = starts[~self.is_break[starts + k]]
        if known is not None:
            for shift in (0, 1):
                starts = starts[self.passes(known, starts + shift, length - 1)]
        if not len(starts):
            return None
        key, most = self.langs[self.place[starts]], len(self.lang_names)
        for k in range(length):
            most *= len(self.words)
            if most >= 1 << 63:
                kept, key = np.unique(key, return_inverse=True)
                most = len(kept) * len(self.words)
            key = key * len(self.words) + self.ids[starts + k]
        order = np.argsort(key)
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        counts = np.add.reduceat(self.weights[self.place[starts[order]]], first)
        chosen = starts[order[first]]
        found = [self.words.take(pa.array(self.ids[chosen + k])) for k in range(length)]
        phrases = pc.binary_join_element_wise(*found, b" ").cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [self.named(self.place[chosen]), phrases, pa.array(counts, pa.int64())], schema=_COUNT
        )

    def stretches(self, known: Filter) -> pa.RecordBatch | None:
        """Two or more words in a row that may all be frequent, as chunks of their own."""
        kept = ~self.is_break
        at = np.flatnonzero(kept)
        kept[at] = self.passes(known, at, 1)
        # A stretch ends with its chunk: a place is only ever compared with the one before it.
        joined = kept[1:] & kept[:-1] & (self.place[1:] == self.place[:-1])
        begins = np.flatnonzero(kept & ~np.concatenate([[False], joined]))
        ends = np.flatnonzero(kept & ~np.concatenate([joined, [False]])) + 1
        own = np.minimum(ends, self.own_ends[self.place[begins]]) - begins
        useful = (ends - begins > 1) & (own > 0)
        begins, ends, own = begins[useful], ends[useful], own[useful]
        if not len(begins):
            return None
        chunks, sizes = self.place[begins], ends - begins
        edges = np.concatenate([[0], np.cumsum(sizes)])
        inside = np.arange(edges[-1]) + np.repeat(begins - edges[:-1], sizes)
        found = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), self.words.take(pa.array(self.ids[inside])))
        columns = [self.named(chunks), pc.binary_join(found, b" "), pa.array(own, pa.int32()), pa.array(self.weights[chunks])]
        folded = pa.table(columns, schema=_CHUNK).group_by(_CHUNK.names[:3], use_threads=False).aggregate([("n", "sum")])
        folded = folded.rename_columns({"n_sum": "n"}).select(_CHUNK.names).combine_chunks()
        return folded.to_batches()[0]


def _each_block(batches: Iterator[pa.RecordBatch], make) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches):
        found = make(_Block(block))
        if found is not None:
            yield found


def _shared(chunks: DataFrame, known: Filter):
    return chunks.sparkSession.sparkContext.broadcast(known)


def frequent_stretches(chunks: DataFrame, known: Filter) -> DataFrame:
    """The dictionary of stretches of frequent words inside ``chunks``, in the same columns."""
    shared = _shared(chunks, known)
    make = lambda block: block.stretches(shared.value)
    return _folded(chunks.mapInArrow(partial(_each_block, make=make), _CHUNK_DDL))


def phrase_counts(chunks: DataFrame, length: int, known: Filter | None = None) -> DataFrame:
    """``lang, phrase, n``: occurrences of phrases of ``length`` words in all documents.

    With ``known``, the filter of phrases one word shorter, phrases are left out
    that cannot be frequent.
    """
    shared = _shared(chunks, known) if known is not None else None
    make = lambda block: block.phrases(length, shared and shared.value)
    counted = chunks.mapInArrow(
        partial(_each_block, make=make), "lang string, phrase string, n long"
    )
    return counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _cuts(candidates: DataFrame, frequent: DataFrame) -> DataFrame:
    """Candidates with ``l``, ``r`` and ``score`` of their lowest-scoring cut."""
    words = F.split("phrase", " ")
    cut = candidates.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"))
    cut = cut.select(
        *("lang", "phrase", "a", "k"),
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice(words, F.col("k") + 1, F.size(words) - F.col("k")), " ").alias("tail"),
    )
    head = frequent.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tail = frequent.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    scored = cut.join(head, ["lang", "head"]).join(tail, ["lang", "tail"]).withColumn(
        "score", F.expr(f"(cast({SCALE} as decimal(38,0)) * a) div (l + r)")
    )
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return scored.groupBy("lang", "phrase", "a").agg(lowest).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score"
    )


def _around(candidates: DataFrame) -> DataFrame:
    """``lang, phrase, most``: phrases inside longer candidates, with the most frequent of those."""
    words = F.split("phrase", " ")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size(words) - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.size(words) - size + 1),
                lambda at: F.array_join(F.slice(words, at, size), " "),
            ),
        )
    )
    longer = candidates.where(F.size(words) > 2)
    return (
        longer.select("lang", "a", F.explode(F.array_distinct(inner)).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("most"))
    )


def collocations(docs: DataFrame) -> DataFrame:
    """The ``TOP`` collocations of each language, with their counts and score.

    Languages without any candidate have no row; so has an empty table. A null
    language counts as ``und``, together with rows that say so. A null or empty
    text adds nothing; repeated rows count each time, with or without an id. Ties
    go by frequency and then by the phrase's bytes.
    """
    chunks = keep(dictionary(docs))
    counted = keep(phrase_counts(chunks, 1))
    sizes = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    levels = [counted.where(F.col("n") >= LEAST)]
    stretches = keep(frequent_stretches(chunks, frequent_filter(levels[0])))
    for length in range(2, LONGEST + 1):
        # Stretches hold no other words, so of two words nothing is left to ask.
        known = frequent_filter(levels[-1]) if length > 2 else None
        found = phrase_counts(stretches, length, known)
        levels.append(keep(found.where(F.col("n") >= LEAST)))
    frequent, candidates = levels[0], levels[1]
    for level in levels[1:]:
        frequent = frequent.union(level)
    for level in levels[2:]:
        candidates = candidates.union(level)
    candidates = candidates.withColumnRenamed("n", "a")
    free = (
        candidates.join(_around(candidates), ["lang", "phrase"], "left")
        .where(F.col("most").isNull() | (100 * F.col("most") < INSIDE * F.col("a")))
        .drop("most")
    )
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.hash("phrase"), F.lit(PARTS))
    in_part = Window.partitionBy("lang", part).orderBy(*best)
    in_all = Window.partitionBy("lang").orderBy(*best)
    ranked = (
        _cuts(free, frequent)
        .withColumn("rank", F.row_number().over(in_part))
        .where(F.col("rank") <= TOP)
        .withColumn("rank", F.row_number().over(in_all).cast("bigint"))
        .where(F.col("rank") <= TOP)
    )
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
