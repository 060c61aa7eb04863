"""Removal of byte strings that an earlier document has, by a distributed suffix sort.

A string of 50 bytes is a suffix cut at 50. Sorting all suffixes would move many
times the input, so only those are sorted that can have a partner:

1. Of the byte 20-grams of a 50-byte string the one of the least hash is its
   anchor. Equal strings have equal anchors, so a string whose anchor is in one
   document only has no partner. Documents are dealt into groups; each group
   sends its distinct anchors as sorted, delta-coded runs, and learns which are
   shared.
2. Strings in a row with one anchor make up a suffix that is cut where the anchor
   changes. Each group sorts its distinct suffixes of shared anchors and sends
   them as front-coded runs, ranges of anchors apart.
3. Each range merges its runs with a loser tree that knows the common prefix of
   every candidate with the last suffix put out. It compares bytes only where
   two such lengths tie, and only behind them. Under an anchor with several
   suffixes the 50-byte strings are compared one by one.
4. The smallest document of each string goes back to the groups, which remove
   what a smaller document has.

Groups answer for their own documents, so an anchor or suffix that a third of
all documents share is sent once per group.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (as pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import count_and_bytes, texts

GRAM = 20
GROUP_BYTES = 6 << 20
CHUNK_BYTES = 256 << 10
# An anchor of more documents has its strings sorted one by one, each in a range
# of its own hash, so no task holds all suffixes of a very common anchor.
COMMON = 200_000
LONGEST = 64  # strings in one suffix
NO_ID = np.iinfo(np.int64).max  # a document without id comes after all others

_BASE = 0x2545F4914F6CDD1D


def gram_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` bytes from each position, by joining halves of doubling length."""
    length, done = 1, 0
    part = data.astype(np.uint64) + np.uint64(1)
    out = None
    while True:
        if n & length:
            piece = part[done:]
            if out is None:
                out = piece
            else:
                m = min(len(out), len(piece))
                out = out[:m] * np.uint64(pow(_BASE, length, 1 << 64)) + piece[:m]
            done += length
        if length * 2 > n:
            break
        if len(part) <= length:
            return np.zeros(0, np.uint64)
        part = part[:-length] * np.uint64(pow(_BASE, length, 1 << 64)) + part[length:]
        length *= 2
    out = out[: max(0, len(data) - n + 1)]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from each position."""
    length = 1
    out = values
    while length * 2 <= width:
        out = np.minimum(out[:-length], out[length:])
        length *= 2
    if length < width:
        out = np.minimum(out[: len(out) - (width - length)], out[width - length :])
    return out


def anchored(data: np.ndarray, edges: np.ndarray, span: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first position and number of strings of each suffix.

    ``data`` holds texts end to end, ``edges`` their bounds. Strings never cross
    a bound, and a suffix ends where the anchor changes.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(edges) - 1:
        upto = max(at + 1, int(np.searchsorted(edges, edges[at] + CHUNK_BYTES, side="right")) - 1)
        low, high = edges[at], edges[upto]
        piece = data[low:high]
        if len(piece) >= span:
            least = least_of(gram_hashes(piece, GRAM), span - GRAM + 1) >> np.uint64(64 - bits)
            inner = edges[at + 1 : upto] - low
            valid = np.ones(len(least), bool)
            for back in range(1, span):  # strings that would cross a bound
                over = inner - back
                valid[over[(over >= 0) & (over < len(least))]] = False
            starts = valid.copy()
            starts[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
            inner = inner[inner < len(least)]
            starts[inner] |= valid[inner]
            first = np.flatnonzero(starts)
            stops = np.flatnonzero(~valid)
            end = np.append(first[1:], len(least))
            if len(stops):
                near = np.searchsorted(stops, first)
                end = np.where(near < len(stops), np.minimum(end, stops[np.minimum(near, len(stops) - 1)]), end)
            count = end - first
            if len(count) and count.max() > LONGEST:
                parts = -(-count // LONGEST)
                nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
                first, total = np.repeat(first, parts) + nth * LONGEST, np.repeat(count, parts)
                count = np.minimum(LONGEST, total - nth * LONGEST)
            found.append((least[first], first + low, count))
        at = upto
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Group:
    """The documents of a group, their bytes laid end to end."""

    def __init__(self, table: pa.Table):
        text = table.column("text").combine_chunks()
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
        ids = table.column("doc_id").combine_chunks()
        self.ids = ids
        self.order = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
        raw = [b.as_py() for b in text.cast(pa.binary())]
        self.edges = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)
        self.bytes = b"".join(raw)
        self.data = np.frombuffer(self.bytes, np.uint8)


_RUNS = pa.schema([(n, pa.int32()) for n in ("bucket", "grp")] + [(n, pa.binary()) for n in ("a", "b", "c", "d")])
_RUNS_DDL = "bucket int, grp int, a binary, b binary, c binary, d binary"


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _RUNS, strict=True)], schema=_RUNS)


def _deltas(values: np.ndarray) -> bytes:
    """Sorted values as differences, in four bytes each where they fit."""
    gaps = np.diff(values, prepend=np.uint64(0))
    wide = len(gaps) > 1 and int(gaps[1:].max()) >= 1 << 32
    first = int(gaps[0]).to_bytes(8, "little") if len(gaps) else bytes(8)
    return bytes([wide]) + first + gaps[1:].astype("<u8" if wide else "<u4").tobytes()


def _values(packed: bytes) -> np.ndarray:
    gaps = np.frombuffer(packed, "<u8" if packed[0] else "<u4", offset=9).astype(np.uint64)
    return np.cumsum(np.concatenate([[np.frombuffer(packed, "<u8", 1, 1)[0]], gaps]).astype(np.uint64))


def _ranges(anchors: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Bounds of the buckets among sorted anchors."""
    step = (1 << bits) // buckets + 1
    return np.searchsorted(anchors, np.arange(buckets + 1, dtype=np.uint64) * np.uint64(step))


def _send_anchors(table: pa.Table, span: int, bits: int, buckets: int) -> pa.Table:
    group = Group(table)
    anchor, first, _ = anchored(group.data, group.edges, span, bits)
    doc = np.searchsorted(group.edges, first, side="right") - 1
    order = np.lexsort((doc, anchor))
    anchor, doc = anchor[order], doc[order]
    new = np.ones(len(anchor), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    other = new.copy()
    other[1:] |= doc[1:] != doc[:-1]
    begins = np.flatnonzero(new)
    docs = np.add.reduceat(other.astype(np.int64), begins) if len(begins) else begins
    distinct = anchor[begins]
    bounds = _ranges(distinct, buckets, bits)
    number = table.column("grp")[0].as_py()
    return _table([
        (i, number, _deltas(distinct[lo:hi]), docs[lo:hi].astype("<u4").tobytes(), None, None)
        for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))
        if lo < hi
    ])


def _find_shared(table: pa.Table, common: int) -> pa.Table:
    """For each group, its anchors that are in two documents or more."""
    groups = table.column("grp").to_pylist()
    anchors = [_values(x) for x in table.column("a").to_pylist()]
    docs = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("b").to_pylist()]).astype(np.int64)
    every = np.concatenate(anchors)
    distinct, place = np.unique(every, return_inverse=True)
    total = np.bincount(place, docs, len(distinct)).astype(np.int64)[place]
    ends = np.cumsum([len(x) for x in anchors])
    bucket = table.column("bucket")[0].as_py()
    rows = []
    for number, mine, counts in zip(groups, anchors, np.split(total, ends[:-1]), strict=True):
        shared = counts > 1
        if shared.any():
            flags = (counts[shared] > common).astype(np.uint8).tobytes()
            rows.append((bucket, number, _deltas(mine[shared]), flags, None, None))
    return _table(rows)


class Suffixes:
    """A group's distinct suffixes of shared anchors in sorted order, and where they occur."""

    def __init__(self, group: Group, shared: pa.Table, span: int, bits: int, buckets: int):
        parts = [(_values(a), np.frombuffer(b, np.uint8)) for a, b in zip(shared.column("a").to_pylist(), shared.column("b").to_pylist(), strict=True)]
        known = np.concatenate([np.zeros(0, np.uint64), *(a for a, _ in parts)])
        common = np.concatenate([np.zeros(0, np.uint8), *(b for _, b in parts)])
        order = np.argsort(known)
        known, common = known[order], common[order]
        anchor, first, count = anchored(group.data, group.edges, span, bits)
        at = np.minimum(np.searchsorted(known, anchor), max(0, len(known) - 1))
        hit = known[at] == anchor if len(known) else np.zeros(len(anchor), bool)
        alone = hit.copy()
        alone[hit] = common[at[hit]] > 0
        anchor, first, count, alone = anchor[hit], first[hit], count[hit], alone[hit]
        if alone.any():  # strings one by one, spread by their own hash
            nth = np.arange(count[alone].sum()) - np.repeat(np.cumsum(count[alone]) - count[alone], count[alone])
            single = np.repeat(first[alone], count[alone]) + nth
            own = gram_hashes(group.data, span)[single] >> np.uint64(64 - bits)
            anchor = np.concatenate([anchor[~alone], own])
            first = np.concatenate([first[~alone], single])
            count = np.concatenate([count[~alone], np.ones(len(single), np.int64)])
        doc = np.searchsorted(group.edges, first, side="right") - 1
        data, places = group.bytes, {}
        for i, (a, start, n) in enumerate(zip(anchor.tolist(), first.tolist(), count.tolist(), strict=True)):
            places.setdefault(a.to_bytes(8, "big") + data[start : start + n + span - 1], []).append(i)
        self.keys = sorted(places)
        sizes = [len(places[k]) for k in self.keys]
        occurrence = np.array([i for k in self.keys for i in places[k]], np.int64)
        self.entry = np.repeat(np.arange(len(self.keys)), sizes)
        self.doc, self.first, self.count = doc[occurrence], first[occurrence], count[occurrence]
        begins = np.cumsum(sizes) - sizes if sizes else np.zeros(0, np.int64)
        self.least = np.minimum.reduceat(group.order[self.doc], begins) if sizes else np.zeros(0, np.int64)
        of_keys = np.array([int.from_bytes(k[:8], "big") for k in self.keys], np.uint64)
        self.bounds = _ranges(of_keys, buckets, bits)


def common_prefix(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of strings known to agree up to ``start``."""
    n = min(len(a), len(b))
    while start < n:
        end = start + 16
        if a[start:end] != b[start:end]:
            while start < n and a[start] == b[start]:
                start += 1
            return start
        start = end
    return n


def front_coded(keys: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Common prefix with the one before, length of the rest, and the rests of sorted strings."""
    shared, rests, before = [], [], b""
    for key in keys:
        n = common_prefix(before, key, 0)
        shared.append(n)
        rests.append(key[n:])
        before = key
    return np.array(shared, "<u2").tobytes(), np.array([len(x) for x in rests], "<u2").tobytes(), b"".join(rests)


def merged(runs: list[tuple[bytes, bytes, bytes]]):
    """Front-coded sorted runs in one order: string, common prefix with the one before, run, number in it.

    A loser tree. Every candidate carries the length of its common prefix with
    the string put out last; of two candidates the longer such prefix is smaller,
    so bytes are read only on a tie, and only behind the tie.
    """
    shared = [np.frombuffer(s, "<u2").tolist() for s, _, _ in runs]
    ends = [np.cumsum(np.frombuffer(n, "<u2"), dtype=np.int64).tolist() for _, n, _ in runs]
    rests = [r for _, _, r in runs]
    k = len(runs)
    leaves = 1 << max(0, (k - 1).bit_length())
    text: list[bytes | None] = [None] * leaves
    prefix, number = [0] * leaves, [-1] * leaves

    def advance(run: int) -> None:
        number[run] = i = number[run] + 1
        if i >= len(ends[run]):
            text[run] = None
            return
        prefix[run] = n = shared[run][i]
        rest = rests[run][ends[run][i - 1] if i else 0 : ends[run][i]]
        text[run] = text[run][:n] + rest if i else rest

    def plays(a: int, b: int) -> bool:
        """Whether ``a`` comes first; the loser's prefix is then that with the winner."""
        x, y = text[a], text[b]
        if x is None or y is None:
            return x is not None
        if prefix[a] != prefix[b]:
            return prefix[a] > prefix[b]
        n = common_prefix(x, y, prefix[a])
        first = n == len(x) or (n < len(y) and x[n] < y[n])
        prefix[b if first else a] = n
        return first

    for run in range(k):
        advance(run)
    loser = [0] * leaves
    winners = list(range(leaves))
    node = leaves
    while node > 1:
        node //= 2
        following = []
        for i in range(node):
            a, b = winners[2 * i], winners[2 * i + 1]
            if not plays(a, b):
                a, b = b, a
            loser[node + i] = b
            following.append(a)
        winners = following
    top = winners[0]
    while text[top] is not None:
        yield text[top], prefix[top], top, number[top]
        advance(top)
        node = (top + leaves) // 2
        while node:
            other = loser[node]
            if not plays(top, other):
                loser[node], top = top, other
            node //= 2


def _send_suffixes(table: pa.Table, shared: pa.Table, span: int, bits: int, buckets: int) -> pa.Table:
    if not table.num_rows or not shared.num_rows:
        return _table([])
    found = Suffixes(Group(table), shared, span, bits, buckets)
    number = table.column("grp")[0].as_py()
    return _table([
        (i, number, *front_coded(found.keys[lo:hi]), found.least[lo:hi].astype("<i8").tobytes())
        for i, (lo, hi) in enumerate(zip(found.bounds[:-1], found.bounds[1:], strict=True))
        if lo < hi
    ])


def least_documents(suffixes: list[tuple[bytes, int]], span: int) -> list[list[tuple[int, int]]]:
    """For distinct suffixes of one anchor with their smallest document: from which
    string on (by number) which document is the smallest that has it."""
    if len(suffixes) == 1:
        return [[(0, suffixes[0][1])]]
    least: dict[bytes, int] = {}
    for text, doc in suffixes:
        for i in range(len(text) - span + 1):
            window = text[i : i + span]
            if least.get(window, doc) >= doc:
                least[window] = doc
    out = []
    for text, _ in suffixes:
        mine, before = [], None
        for i in range(len(text) - span + 1):
            doc = least[text[i : i + span]]
            if doc != before:
                mine.append((i, doc))
                before = doc
        out.append(mine)
    return out


def _answer(table: pa.Table, span: int) -> pa.Table:
    """For each group, the smallest documents of its suffixes."""
    rows = table.to_pylist()
    rows.sort(key=lambda row: row["grp"])
    smallest = [np.frombuffer(row["d"], "<i8").tolist() for row in rows]
    answers: list[list[tuple[int, int, int]]] = [[] for _ in rows]
    distinct: list[tuple[bytes, int]] = []
    holders: list[list[tuple[int, int]]] = []

    def close() -> None:
        for parts, who in zip(least_documents(distinct, span) if distinct else [], holders, strict=True):
            for run, i in who:
                answers[run] += [(i, first, doc) for first, doc in parts]
        distinct.clear()
        holders.clear()

    length = -1
    for key, prefix, run, i in merged([(row["a"], row["b"], row["c"]) for row in rows]):
        doc = smallest[run][i]
        if prefix == length == len(key):  # the suffix put out last, from another group
            holders[-1].append((run, i))
            distinct[-1] = (distinct[-1][0], min(distinct[-1][1], doc))
        else:
            if prefix < 8:
                close()
            distinct.append((key[8:], doc))
            holders.append([(run, i)])
        length = len(key)
    close()
    out = []
    for row, mine in zip(rows, answers, strict=True):
        entry, first, doc = (np.array(x, np.int64) for x in zip(*mine, strict=True))
        out.append((row["bucket"], row["grp"], entry.astype("<i4").tobytes(), first.astype("<u2").tobytes(), doc.astype("<i8").tobytes(), b"answer"))
    return _table(out)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.string())])
_OUT_DDL = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans string"


def _remove(table: pa.Table, messages: pa.Table, span: int, bits: int, buckets: int) -> pa.Table:
    if not table.num_rows:
        return _OUT.empty_table()
    group = Group(table)
    change = np.zeros(len(group.data) + 1, np.int32)
    is_answer = pa.compute.is_valid(messages.column("d")) if messages.num_rows else None
    if is_answer is not None and messages.num_rows:
        found = Suffixes(group, messages.filter(pa.compute.invert(is_answer)), span, bits, buckets)
        answers = messages.filter(is_answer).to_pylist()
        entry = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x["a"], "<i4") + found.bounds[x["bucket"]] for x in answers)])
        begin = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x["b"], "<u2").astype(np.int64) for x in answers)])
        least = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x["c"], "<i8") for x in answers)])
        order = np.lexsort((begin, entry))
        entry, begin, least = entry[order], begin[order], least[order]
        # Each occurrence meets the parts of its suffix.
        low, high = np.searchsorted(entry, found.entry), np.searchsorted(entry, found.entry, side="right")
        n = high - low
        part = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        who = np.repeat(np.arange(len(found.entry)), n)
        last = np.append(part[1:] != part[:-1] + 1, True) | np.append(who[1:] != who[:-1], True)
        until = np.where(last, found.count[who], begin[np.minimum(part + 1, len(begin) - 1)] if len(begin) else 0)
        gone = least[part] < group.order[found.doc[who]]
        start = found.first[who[gone]]
        np.add.at(change, start + begin[part[gone]], 1)
        np.add.at(change, start + until[gone] - 1 + span, -1)
    removed = np.cumsum(change[:-1], dtype=np.int32) > 0
    out: dict[str, list] = {name: [] for name in _OUT.names[1:]}
    for low, high in zip(group.edges[:-1].tolist(), group.edges[1:].tolist(), strict=True):
        mine = removed[low:high]
        bounds = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
        kept = group.data[low:high][~mine].tobytes() if len(bounds) else group.bytes[low:high]
        out["n_bytes"].append(high - low)
        out["n_removed"].append(int(mine.sum()))
        out["n_spans"].append(len(bounds))
        out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        out["spans"].append(",".join(f"{a}:{b}" for a, b in bounds.tolist()))
    return pa.table([group.ids, *(pa.array(out[f.name], f.type) for f in list(_OUT)[1:])], schema=_OUT)


def remove_repeats(docs: DataFrame, span: int = 50, common: int = COMMON, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per document: what is left when earlier documents' strings are removed.

    A byte goes if a string of ``span`` bytes covers it that also starts in a
    document of smaller id. Columns: ``doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, spans`` (byte offsets). A null text is empty, texts shorter than
    ``span`` stay whole, rows of equal id do not remove from each other, and a
    null id counts as greater than all others. No documents give no rows.
    """
    rows = texts(docs)
    _, size = count_and_bytes(rows)
    groups = buckets = max(8, size // group_bytes + 1)
    bits = min(60, size.bit_length() + 12)
    dealt = rows.withColumn("grp", F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int")).repartition("grp")
    known = {"span": span, "bits": bits, "buckets": buckets}

    anchors = dealt.groupBy("grp").applyInArrow(lambda t: _send_anchors(t, **known), _RUNS_DDL)
    shared = anchors.groupBy("bucket").applyInArrow(lambda t: _find_shared(t, common), _RUNS_DDL)
    runs = (
        dealt.groupBy("grp")
        .cogroup(shared.groupBy("grp"))
        .applyInArrow(lambda t, s: _send_suffixes(t, s, **known), _RUNS_DDL)
    )
    answers = runs.groupBy("bucket").applyInArrow(lambda t: _answer(t, span), _RUNS_DDL)
    messages = shared.union(answers)
    return (
        dealt.groupBy("grp")
        .cogroup(messages.groupBy("grp"))
        .applyInArrow(lambda t, m: _remove(t, m, **known), _OUT_DDL)
    )
