"""Packing token sequences by best-fit decreasing.

Documents become ids; one longer than a window is cut into full windows and a
rest. The rests are packed where they fall after a hash partitioning: longest
first, each into the open window whose remaining capacity is the least that
still holds it. A segment tree over remaining capacities finds that window in
logarithmic time, whatever the number of open windows.

Documents that come in an order, such as a mixture, are packed by stretches of
that order instead, each round for itself, and the windows follow it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import keep

WINDOW = 4096
END_ID = 2
# Pieces that one task packs: enough that the last, part-filled windows are a
# vanishing share, few enough that a task holds them easily.
PIECES_PER_TASK = 50_000
# Words, and parts of words, whose ids a worker keeps at hand; beyond, it starts anew.
CACHED_WORDS = 500_000
CACHED_PARTS = 1_000_000
TEXTS_AT_ONCE = 1000

_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
    ]
)
_PIECES_DDL = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class WordIds:
    """Ids of texts, one tokenizer call per distinct word.

    Holds for a tokenizer that drops white space, never joins across it, and
    takes letters apart from marks: the ids of a text are then those of its
    words in a row. A plain word is looked up in lower case and without a
    closing stop or comma. Ids are little-endian 32-bit bytes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        # How the byte-level step writes letters beyond ASCII.
        letters = [c for c in map(chr, range(0x80, 0x100)) if c.isalpha()]
        self.mapped = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}
        self.marks = {mark: self._ids(mark) for mark in ("", ".", ",")}

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    @staticmethod
    def _part(word: bytes) -> tuple[str, str]:
        """The part of a word that is looked up, and the mark after it."""
        text = word.decode()
        core, mark = (text[:-1], text[-1]) if text[-1] in ".," else (text, "")
        if core.isalpha() and (core.isascii() or max(core) < "\u0100"):
            return core.lower(), mark
        return text, ""

    def _learn_parts(self, parts: set[str]) -> None:
        tokenize, mapped = self.tokenizer.model.tokenize, self.mapped
        for part in parts:
            plain = part.isascii()
            if part.isalpha() and (plain or max(part) < "\u0100"):  # one word of the model, nothing to normalise
                ids = [x.id for x in tokenize(part if plain else part.translate(mapped))]
                self.parts[part] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                self.parts[part] = self._ids(part)

    def _learn(self, words: set[bytes]) -> None:
        new = words - self.words.keys()
        if len(self.words) + len(new) > CACHED_WORDS:
            self.words, new = {}, words
        found = {word: self._part(word) for word in new}
        needed = {part for part, _ in found.values()}
        missing = needed - self.parts.keys()
        if len(self.parts) + len(missing) > CACHED_PARTS:
            self.parts, missing = {}, needed
        self._learn_parts(missing)
        self.words.update({w: self.parts[part] + self.marks[mark] for w, (part, mark) in found.items()})

    def encode(self, batch: list[str]) -> Iterator[bytes]:
        for at in range(0, len(batch), TEXTS_AT_ONCE):
            split = [text.encode().split() for text in batch[at : at + TEXTS_AT_ONCE]]
            self._learn(set().union(*split))
            for words in split:
                yield b"".join([self.words[w] for w in words])


_ENCODERS: dict[str, WordIds] = {}


def pieces_of(ids: bytes, window: int, end_id: int) -> tuple[list[int], list[int], list[int], int]:
    """Starts, lengths and CRC-32 of a document's full windows and its rest, and its tokens."""
    ids += end_id.to_bytes(4, "little")
    n = len(ids) // 4
    starts = list(range(0, n, window))
    cut = [ids[4 * s : 4 * (s + window)] for s in starts]
    return starts, [len(x) // 4 for x in cut], [zlib.crc32(x) for x in cut], n


def _cut(batches, path: str, window: int, end_id: int, carry: Sequence[str] = ()):
    if path not in _ENCODERS:
        _ENCODERS[path] = WordIds(path)
    encoder = _ENCODERS[path]
    for batch in batches:
        out: dict[str, list] = {name: [] for name in (*_PIECES.names, *carry)}
        doc_ids = batch.column(0).to_pylist()
        for i, (doc_id, ids) in enumerate(zip(doc_ids, encoder.encode(batch.column(1).to_pylist()), strict=True)):
            starts, lengths, sums, n = pieces_of(ids, window, end_id)
            out["doc_id"] += [doc_id] * len(starts)
            out["start"] += starts
            out["length"] += lengths
            out["ids_crc32"] += sums
            out["doc_tokens"] += [n] * len(starts)
            for k, name in enumerate(carry, 2):
                out[name] += [batch.column(k)[i].as_py()] * len(starts)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([*_PIECES, *((name, pa.string()) for name in carry)]))


class OpenWindows:
    """Open windows by remaining capacity, in a segment tree of counts."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, name: int) -> None:
        self.at[capacity].append(name)
        node = capacity + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The window of the least capacity that holds ``length``, and that capacity."""
        node = length + self.leaves
        if not self.count[node]:
            # Up to the first subtree to the right that has a window, then down its left edge.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return self.at[capacity].pop(), capacity


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece; pieces come longest first."""
    names, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    tree, made = OpenWindows(window), 0
    for i, length in enumerate(lengths.tolist()):
        found = tree.take(length)
        if found is None:
            found, made = (made, window), made + 1
        name, capacity = found
        names[i], offsets[i] = name, window - capacity
        if capacity > length:
            tree.put(capacity - length, name)
    return names, offsets


def _pack(batches, window: int):
    table = pa.Table.from_batches(list(batches), schema=_PIECES)
    if not table.num_rows:
        return
    # In a fixed order, so that a task run again gives the same windows.
    table = table.sort_by(
        [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
    )
    names, offsets = best_fit_decreasing(table.column("length").to_numpy(), window)
    first = TaskContext.get().partitionId() << 32
    yield from (
        table.append_column("sequence_id", pa.array(names + first))
        .append_column("offset", pa.array(offsets))
        .to_batches()
    )


def _pack_in_order(batches, window: int, order: Sequence[str]):
    """Each value of the first of ``order`` is packed for itself; windows are numbered by their first piece."""
    table = pa.Table.from_batches(list(batches), schema=pa.schema([*_PIECES, *((name, pa.int64()) for name in order)]))
    if not table.num_rows:
        return
    table = table.sort_by([(name, "ascending") for name in (*order, "doc_id", "start", "ids_crc32")])
    rounds = table.column(order[0]).to_numpy()  # never null
    edges = [0, *(np.flatnonzero(np.diff(rounds)) + 1).tolist(), len(rounds)]
    first = TaskContext.get().partitionId() << 32
    for low, high in zip(edges, edges[1:]):
        part = table.slice(low, high - low).select(_PIECES.names)
        lengths = part.column("length").to_numpy()
        longest = np.argsort(-lengths, kind="stable")
        names, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        names[longest], offsets[longest] = best_fit_decreasing(lengths[longest], window)
        _, begins, which = np.unique(names, return_index=True, return_inverse=True)
        number = np.empty(len(begins), np.int64)
        number[np.argsort(begins)] = np.arange(len(begins))
        yield from (
            part.append_column("sequence_id", pa.array(number[which] + first))
            .append_column("offset", pa.array(offsets))
            .to_batches()
        )
        first += len(begins)


def token_pieces(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, carry: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` of each document's pieces, and its columns ``carry`` as text."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        *(F.col(name).cast("string").alias(name) for name in carry),
    )
    ddl = ", ".join([_PIECES_DDL, *(f"{name} string" for name in carry)])
    return rows.mapInArrow(lambda batches: _cut(batches, tokenizer, window, end_id, carry), ddl)


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pack whole documents into windows: ``token_pieces`` with ``sequence_id`` and ``offset``.

    A null or empty text is the end id alone; repeated rows are packed each for
    itself; a null id stays null. No documents give no rows. The number of tasks
    that pack grows with the documents.
    """
    pieces = token_pieces(docs, tokenizer, window, end_id)
    tasks = max(1, -(-docs.count() // PIECES_PER_TASK))
    spread = pieces.repartition(tasks, F.xxhash64("doc_id", "start", "ids_crc32"))
    return spread.mapInArrow(
        lambda batches: _pack(batches, window), f"{_PIECES_DDL}, sequence_id bigint, offset bigint"
    )


def pack_in_order(pieces: DataFrame, order: Sequence[str], window: int = WINDOW) -> DataFrame:
    """Pack ``token_pieces`` that have columns ``order`` of whole numbers, the first one a round, in that order.

    A task packs a stretch of about PIECES_PER_TASK pieces, no sequence holds
    pieces of two rounds, and ``sequence_id`` grows with the round, the stretch
    and the first piece of a sequence. Otherwise as ``pack``.
    """
    pieces = keep(pieces.select(*_PIECES.names, *order))  # read once for the ranges and once to be packed
    tasks = max(1, -(-pieces.count() // PIECES_PER_TASK))
    spread = pieces.repartitionByRange(tasks, *order, "doc_id", "start", "ids_crc32")
    return spread.mapInArrow(
        partial(_pack_in_order, window=window, order=tuple(order)),
        f"{_PIECES_DDL}, sequence_id bigint, offset bigint",
    )
