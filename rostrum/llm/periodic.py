"""Periodic runs of words by descending common prefixes.

The suffixes of a text's words are sorted, and classes of suffixes are united in
the order of falling common-prefix length by union-find. A class keeps its
positions in order. When two classes are united at a common prefix of ``l``
words, positions that become neighbours at a distance ``d`` hold equal words for
``l`` words from either on, so ``l + d`` words from the first have period ``d``.
No position lies between them, so no smaller period holds there.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rostrum.llm.common import each_batch, texts

# A run is at least this many words long, and at least this many of its periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4
# Words that a run's first two periods have in common at least: of a run of
# period p they are max(6, 4p) - p, least for p = 1.
LEAST_COMMON = LEAST_WORDS - 1
# Positions in one part of an ordered set.
PART = 512


class Positions:
    """Positions in order, in parts of bounded length, so that adding one moves few others."""

    __slots__ = ("parts", "last", "size")

    def __init__(self, position: int):
        self.parts, self.last, self.size = [[position]], [position], 1

    def __iter__(self):
        for part in self.parts:
            yield from part

    def add(self, position: int) -> tuple[int | None, int | None]:
        """Put a new position in and return its neighbours."""
        k = bisect_left(self.last, position)
        if k == len(self.parts):
            k -= 1
        part = self.parts[k]
        at = bisect_left(part, position)
        if at:
            before = part[at - 1]
        else:
            before = self.last[k - 1] if k else None
        if at < len(part):
            after = part[at]
        else:
            after = self.parts[k + 1][0] if k + 1 < len(self.parts) else None
        part.insert(at, position)
        self.size += 1
        self.last[k] = part[-1]
        if len(part) > 2 * PART:
            self.parts[k : k + 1] = [part[:PART], part[PART:]]
            self.last[k : k + 1] = [part[PART - 1], part[-1]]
        return before, after


def _ranks(ids: np.ndarray) -> np.ndarray:
    """The rank of each suffix, by doubling the length that ranks compare."""
    n = len(ids)
    rank, width = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    while width < n:
        following = np.zeros(n, np.int64)
        following[: n - width] = rank[width:] + 1
        order, rank = np.unique(rank * (n + 1) + following, return_inverse=True)
        if len(order) == n:
            break
        width *= 2
    return rank


def _common(ids: list[int], order: list[int], rank: list[int]) -> list[int]:
    """Words that each suffix in ``order`` shares with the one before it (first: 0)."""
    n, shared, found = len(ids), 0, [0] * len(ids)
    for i in range(n):
        if rank[i]:
            j = order[rank[i] - 1]
            most = n - max(i, j)
            while shared < most and ids[i + shared] == ids[j + shared]:
                shared += 1
            found[rank[i]] = shared
            shared = max(shared - 1, 0)
        else:
            shared = 0
    return found


def _may_repeat(ids: np.ndarray) -> bool:
    """Whether some stretch of ``LEAST_COMMON`` words may occur twice; only a hash is compared."""
    n = len(ids) - LEAST_COMMON + 1
    if n < 2:
        return False
    mixed = np.zeros(n, np.uint64)
    for k in range(LEAST_COMMON):
        mixed = (mixed ^ ids[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed.sort()
    return bool((mixed[1:] == mixed[:-1]).any())


def runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of a sequence of word ids, by start and period."""
    if len(ids) < LEAST_WORDS or not _may_repeat(ids):
        return []
    ranks = _ranks(ids)
    order = np.argsort(ranks)
    words, at = ids.tolist(), order.tolist()
    common = np.array(_common(words, at, ranks.tolist()))
    edges = np.flatnonzero(common >= LEAST_COMMON)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    parent: dict[int, int] = {}
    classes: dict[int, Positions] = {}

    def find(node: int) -> int:
        while (up := parent.setdefault(node, node)) != node:
            parent[node] = node = parent.setdefault(up, up)
        return node

    found = []

    def seed(first: int, second: int, shared: int) -> None:
        period = second - first
        length = shared + period
        if length < LEAST_PERIODS * period or length < LEAST_WORDS:
            return
        if first == 0 or words[first - 1] != words[second - 1]:
            found.append((first, length, period))

    for edge, shared in zip(edges.tolist(), common[edges].tolist()):
        a, b = find(edge - 1), find(edge)
        large = classes.pop(a, None) or Positions(at[a])
        small = classes.pop(b, None) or Positions(at[b])
        if large.size < small.size:
            large, small, a, b = small, large, b, a
        parent[b], classes[a] = a, large
        # In rising order, what stands before a new position is settled at once,
        # and what stands after it once the next one is known to lie beyond.
        last = waiting = None
        for position in list(small):
            before, after = large.add(position)
            if waiting is not None and waiting < position:
                seed(last, waiting, shared)
            if before is not None and before != last:
                seed(before, position, shared)
            last, waiting = position, after
        if waiting is not None:
            seed(last, waiting, shared)
    return sorted(set(found))


def edited(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document, made periodic from some word on in one document of ten.

    Which, from where and at what period follows from the id; a null id changes nothing.
    """
    if doc_id is None or not words:
        return words
    drawn = crc32(str(doc_id).encode())
    if drawn % 10:
        return words
    g, n = drawn // 10, len(words)
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    unit = words[start : start + period]
    times = -(-(n - start) // period)
    return words[:start] + (unit * times)[: n - start]


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _describe(words: list[bytes]) -> tuple:
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    found = runs(ids)
    listed = b"".join(b"%d,%d,%d\n" % run for run in found)
    if not found:
        return 0, None, None, None, None, _sha256(listed), _sha256(b" ".join(words)), 0
    start, length, period = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
    steps = np.zeros(len(words) + 1, np.int64)
    for at, long, q in found:
        steps[at + q] += 1
        steps[at + long] -= 1
    covered = np.cumsum(steps[:-1]) > 0
    kept = [words[i] for i in np.flatnonzero(~covered).tolist()]
    return (
        *(len(found), start, length, period, 1000 * length // period),
        *(_sha256(listed), _sha256(b" ".join(kept)), len(words) - len(kept)),
    )


_COLUMNS = {
    "n_runs": pa.int64(),
    "start": pa.int64(),
    "length": pa.int64(),
    "period": pa.int64(),
    "exponent_milli": pa.int64(),
    "runs_sha256": pa.string(),
    "collapsed_sha256": pa.string(),
    "n_dropped": pa.int64(),
}
_SCHEMA = pa.schema([("doc_id", pa.int64()), *_COLUMNS.items()])
_DDL = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, n_dropped long"
)


def _describe_batch(batch: pa.RecordBatch) -> dict:
    ids = batch.column("doc_id").to_pylist()
    bodies = batch.column("text").cast(pa.binary()).to_pylist()
    rows = [_describe(edited(body.split(), doc_id)) for doc_id, body in zip(ids, bodies)]
    return {"doc_id": batch.column("doc_id"), **dict(zip(_COLUMNS, zip(*rows)))}


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its periodic runs and the text without their repeats.

    ``start``, ``length``, ``period`` and ``exponent_milli`` describe the run with
    most periods (ties: the first, then the shortest period). A word goes if a run
    holds it after that run's first period. A null or empty text, and one without
    runs, has 0 runs and nulls there; its digests are those of the empty list and
    of all words. Repeated rows give repeated results; a null id stays, unedited.
    Each row is worked on by itself: an empty table gives no row, nothing is shuffled.
    """
    return each_batch(texts(docs), _describe_batch, _SCHEMA, _DDL)
