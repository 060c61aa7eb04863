"""A hidden Markov language model trained by Baum-Welch over all training documents.

States emit classes of tokens: each frequent token is a class of its own, all
others fall into classes by their look, inside which a token has the smoothed
share of its count. Expected counts of a round are added up across partitions;
a document's likelihood is the exact scaled forward recursion over its classes
times the shares of its tokens.

Counts of tokens are kept as a table. Only the most frequent ones, a fixed
number, travel to the tasks; the others are joined.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import in_fold, keep, texts

END = b""  # ends every document; never a word
STATES = 8
ROUNDS = 6
OWN_CLASS = 8192  # tokens that are classes of their own
AT_HAND = 1 << 17  # tokens, about, whose counts travel to the tasks
LOOKS = 512
WINDOW = 1024  # training windows; a later window starts from states of its own
SCAN = 4096  # longer documents are scored in windows side by side
FLUSH = 300_000
TEXTS_AT_ONCE = 1000


_DIGITS = b"0123456789"


def tokens(text: str) -> list[bytes]:
    return [*text.encode().lower().split(), END]


def look(token: bytes) -> int:
    """Class of a token that has none of its own: its end, its letters, how it begins."""
    shape = (token[-1:] in (b".", b",", b"!", b"?", b";", b":")) + 2 * (not token.isascii()) + 4 * (len(token.translate(None, _DIGITS)) < len(token))
    return shape * (LOOKS // 8) + zlib.crc32(token[:2]) % (LOOKS // 8)


@dataclass
class Vocabulary:
    """The most frequent tokens in order with their counts, and sums over each look's tokens."""

    number: dict[bytes, int]
    counts: np.ndarray
    look_count: np.ndarray
    look_distinct: np.ndarray
    total: int
    distinct: int
    own: int

    @property
    def classes(self) -> int:
        return self.own + LOOKS

    def class_of(self, token: bytes) -> int:
        found = self.number.get(token, self.own)
        return found if found < self.own else self.own + look(token)

    def share(self, count, of_look) -> np.ndarray:
        """log10 of a token's share of its look."""
        return np.log10((count + 0.5) / (self.look_count[of_look] + 0.5 * (self.look_distinct[of_look] + 1)))

    def base(self, count) -> np.ndarray:
        return np.log10((count + 0.5) / (self.total + 0.5 * (self.distinct + 1)))


@dataclass
class Model:
    start: np.ndarray  # of documents, and of later training windows
    moves: np.ndarray
    emits: np.ndarray  # by class and state


def _count(batches):
    def rows(found):
        return pa.RecordBatch.from_pydict({"token": list(found.keys()), "c": list(found.values())}, schema=pa.schema([("token", pa.binary()), ("c", pa.int64())]))

    found: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            found.update(tokens(text))
            if len(found) >= FLUSH:
                yield rows(found)
                found = Counter()
    if found:
        yield rows(found)


def count_tokens(train: DataFrame) -> DataFrame:
    """``token, c`` over all texts, summed in the tasks before the shuffle."""
    return train.select("text").mapInArrow(_count, "token binary, c bigint").groupBy("token").agg(F.sum("c").alias("c"))


def _looks(batches, own: frozenset):
    count, distinct = np.zeros(LOOKS, np.int64), np.zeros(LOOKS, np.int64)
    for batch in batches:
        for token, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if token not in own:
                count[(i := look(token))] += c
                distinct[i] += 1
    yield pa.RecordBatch.from_pydict({"look": np.arange(LOOKS), "c": count, "d": distinct})


def vocabulary(counts: DataFrame, own: int = OWN_CLASS, at_hand: int = AT_HAND) -> Vocabulary:
    """The driver gets about ``at_hand`` tokens and one row per look, whatever the size of the corpus."""
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    # The tokens above a count that so many reach; the rest is joined, never dropped.
    least = 0
    if sums[1] > at_hand:
        least = counts.agg(F.percentile_approx("c", 1 - at_hand / sums[1], 1_000_000)).first()[0]
    top = sorted(counts.where(F.col("c") > least).collect(), key=lambda row: (-row["c"], bytes(row["token"])))
    own = min(own, len(top))
    number = {bytes(row["token"]): i for i, row in enumerate(top)}
    mine = frozenset(list(number)[:own])
    looks = counts.mapInArrow(partial(_looks, own=mine), "look bigint, c bigint, d bigint").groupBy("look").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    look_count, look_distinct = np.zeros(LOOKS, np.int64), np.zeros(LOOKS, np.int64)
    for row in looks.collect():
        look_count[row["look"]], look_distinct[row["look"]] = row["c"], row["d"]
    return Vocabulary(number, np.array([row["c"] for row in top], np.int64), look_count, look_distinct, int(sums[0]), int(sums[1]), own)


class _Classes(dict):
    """Class of each token met, a bounded number of them at a time."""

    def __init__(self, words: Vocabulary):
        self.words = words

    def __missing__(self, token: bytes) -> int:
        if len(self) >= FLUSH:
            self.clear()
        found = self[token] = self.words.class_of(token)
        return found


def _encode(batches, shared):
    classes = _Classes(shared.value)
    for batch in batches:
        found = [np.array([classes[t] for t in tokens(text)], "<u2").tobytes() for text in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_pydict({"ids": found})


class Chains:
    """Sequences laid out by step, the longest first; a step of all is one slice."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(x) for x in sequences], np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths
        sizes = lengths[self.order]
        self.steps = int(sizes[0])
        self.active = np.searchsorted(-sizes, -np.arange(self.steps), side="left")
        self.first = np.concatenate([[0], np.cumsum(self.active)])
        self.seen = np.empty(int(lengths.sum()), np.int32)
        for row, i in enumerate(self.order.tolist()):
            self.seen[self.first[: lengths[i]] + row] = sequences[i]

    def forward(self, starts: np.ndarray, model: Model, keep_all: bool = False):
        """Last state distribution and log likelihood of each sequence; with ``keep_all`` of each step.

        ``starts`` are state distributions before the first emission.
        """
        emits, moves = model.emits, model.moves
        final = np.empty((len(self.order), starts.shape[1]), np.float32)
        scale = np.zeros(len(self.order))
        every = np.empty((len(self.seen), starts.shape[1]), np.float32) if keep_all else None
        now = starts[self.order].astype(np.float32)
        for t in range(self.steps):
            n = self.active[t]
            here = slice(self.first[t], self.first[t] + n)
            if n < len(now):
                final[n : len(now)] = now[n:]
                now = now[:n]
            if t:
                now = now @ moves
            now = now * emits[self.seen[here]]
            total = now.sum(1)
            now = now / total[:, None]
            scale[:n] += np.log(total)
            if keep_all:
                every[here] = now
        final[: len(now)] = now
        back = np.empty(len(self.order), np.int64)
        back[self.order] = np.arange(len(self.order))
        return final[back], scale[back], every

    def expected(self, starts: np.ndarray, model: Model, later: np.ndarray):
        """Expected starts (of documents, of later windows), moves and emissions, and the log likelihood."""
        _, scale, ahead = self.forward(starts, model, keep_all=True)
        emits, moves = model.emits, model.moves
        s = moves.shape[0]
        state = np.empty_like(ahead)
        moved = np.zeros((s, s))
        back = np.ones((self.active[-1], s), np.float32)
        for t in range(self.steps - 1, -1, -1):
            n = self.active[t]
            here = slice(self.first[t], self.first[t] + n)
            if n > len(back):
                back = np.concatenate([back, np.ones((n - len(back), s), np.float32)])
            both = ahead[here] * back
            both /= both.sum(1, keepdims=True)
            state[here] = both
            if t:
                pull = emits[self.seen[here]] * back
                before = ahead[self.first[t - 1] : self.first[t - 1] + n]
                back = pull @ moves.T
                weight = (before * back).sum(1, keepdims=True)
                moved += (before / weight).T @ pull
                back = back / back.sum(1, keepdims=True)
        begun = state[: self.active[0]]
        is_later = later[self.order]
        start = np.stack([begun[~is_later].sum(0), begun[is_later].sum(0)])
        emitted = np.stack([np.bincount(self.seen, state[:, i], len(emits)) for i in range(s)], 1)
        return start, moved * moves, emitted, float(scale.sum())


def _expect(batches, shared):
    """A task's expected counts: a row per class, then per start, then per state, then the likelihood."""
    model: Model = shared.value
    classes, s = model.emits.shape
    total = np.zeros((classes + 2 + s + 1, s))
    for batch in batches:
        ids = [np.frombuffer(x, "<u2") for x in batch.column(0).to_pylist()]
        for at in range(0, len(ids), TEXTS_AT_ONCE):
            windows, later = [], []
            for x in ids[at : at + TEXTS_AT_ONCE]:
                windows += [x[i : i + WINDOW] for i in range(0, len(x), WINDOW)]
                later += [i > 0 for i in range(0, len(x), WINDOW)]
            is_later = np.array(later)
            start, moved, emitted, log = Chains(windows).expected(model.start[is_later.astype(int)], model, is_later)
            total[:classes] += emitted
            total[classes : classes + 2] += start
            total[classes + 2 : -1] += moved
            total[-1, 0] += log
    rows = np.flatnonzero(total.any(1))
    yield pa.RecordBatch.from_pydict({"row": rows, **{f"s{i}": total[rows, i] for i in range(s)}})


def first_model(words: Vocabulary, states: int) -> Model:
    """Sticky states that emit the corpus frequencies, each with its own noise."""
    share = np.concatenate([words.counts[: words.own], np.zeros(words.own - min(words.own, len(words.counts))), words.look_count]) + 0.5
    noise = np.random.default_rng(0).lognormal(0.0, 1.0, (len(share), states))
    emits = share[:, None] * noise
    moves = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full((2, states), 1 / states, np.float32), moves.astype(np.float32), (emits / emits.sum(0)).astype(np.float32))


def baum_welch(encoded: DataFrame, words: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """Model after ``rounds`` passes over all training documents, and their log likelihoods."""
    sc = encoded.sparkSession.sparkContext
    model, logs = first_model(words, states), []
    prior = np.concatenate([words.counts[: words.own], np.zeros(words.own - min(words.own, len(words.counts))), words.look_count]) + 0.5
    prior = prior / prior.sum()
    columns = [f"s{i}" for i in range(states)]
    ddl = "row bigint, " + ", ".join(f"{c} double" for c in columns)
    for _ in range(rounds):
        shared = sc.broadcast(model)  # states times classes, both fixed
        sums = encoded.mapInArrow(partial(_expect, shared=shared), ddl).groupBy("row").agg(*(F.sum(c).alias(c) for c in columns))
        total = np.zeros((words.classes + 2 + states + 1, states))
        for row in sums.collect():
            total[row[0]] = row[1:]
        emits = total[: words.classes] + 20 * prior[:, None]
        start = total[words.classes : words.classes + 2] + 1.0
        moves = total[words.classes + 2 : -1] + 1.0
        logs.append(float(total[-1, 0]))
        model = Model(*((x / x.sum(axis, keepdims=True)).astype(np.float32) for x, axis in ((start, 1), (moves, 1), (emits, 0))))
    return model, logs


def likelihoods(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """Natural log likelihood of each sequence of classes, exactly.

    A long sequence is cut into windows that run side by side from every state
    they may be entered with; the windows are then joined in order.
    """
    s = model.moves.shape[0]
    parts, starts, owner = [], [], []
    for i, x in enumerate(sequences):
        cuts = range(0, len(x), SCAN)
        for k, at in enumerate(cuts):
            for start in model.start[:1] if k == 0 else model.moves:
                parts.append(x[at : at + SCAN])
                starts.append(start)
                owner.append(i)
    final, scale, _ = Chains(parts).forward(np.array(starts), model)
    out, at = np.zeros(len(sequences)), 0
    for i, x in enumerate(sequences):
        now, log = final[at].astype(np.float64), scale[at]
        at += 1
        for _ in range(1, -(-len(x) // SCAN)):
            most = scale[at : at + s].max()
            now = (now * np.exp(scale[at : at + s] - most)) @ final[at : at + s]
            log += most + np.log(now.sum())
            now /= now.sum()
            at += s
        out[i] = log
    return out


_SCORED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("token", pa.binary()), ("n", pa.int64()), ("look", pa.int32())])
_SCORED_DDL = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, token binary, n bigint, look int"


def _score(batches, shared):
    """A row per document with what the task knows, and rows for the tokens whose counts it lacks."""
    words, model = shared.value
    classes = _Classes(words)
    number, counts = words.number, words.counts
    base = words.base(counts)
    class_at_hand = np.array([words.class_of(t) for t in number], np.int32)
    share = np.zeros(len(counts))
    share[words.own :] = words.share(counts[words.own :], class_at_hand[words.own :] - words.own)
    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        sequences, known, base_sum, share_sum, sizes = [], [], [], [], []
        rare: dict[str, list] = {"row": [], "token": [], "n": [], "look": []}
        for i, text in enumerate(batch.column(2).to_pylist()):
            found = tokens(text)
            here = np.fromiter(map(number.get, found, repeat(-1)), np.int64, len(found))
            seen = np.zeros(len(found), np.int32)
            seen[here >= 0] = class_at_hand[here[here >= 0]]
            elsewhere = np.flatnonzero(here < 0).tolist()
            seen[elsewhere] = [classes[found[j]] for j in elsewhere]
            missing = Counter(found[j] for j in elsewhere)
            sequences.append(seen)
            here = here[here >= 0]
            sizes.append(len(found))
            known.append(len(here))
            base_sum.append(float(base[here].sum()))
            share_sum.append(float(share[here].sum()))
            rare["row"] += [row + i] * len(missing)
            rare["token"] += missing.keys()
            rare["n"] += missing.values()
            rare["look"] += map(look, missing)
        n = len(sizes)
        log = likelihoods(sequences, model) / np.log(10)
        yield pa.RecordBatch.from_pydict(
            {"row": np.arange(row, row + n), "doc_id": batch.column(0), "held_out": batch.column(1), "n_tokens": sizes, "n_known": known,
             "base": base_sum, "score": log + share_sum, "token": [None] * n, "n": [None] * n, "look": [None] * n}, schema=_SCORED)
        m = len(rare["row"])
        for a in range(0, m, 100_000):
            part = {k: v[a : a + 100_000] for k, v in rare.items()}
            empty = [None] * len(part["row"])
            yield pa.RecordBatch.from_pydict({name: part.get(name, empty) for name in _SCORED.names}, schema=_SCORED)
        row += n


def score_documents(docs: DataFrame, fold: int = 1, states: int = STATES, rounds: int = ROUNDS, own: int = OWN_CLASS, at_hand: int = AT_HAND) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Documents whose id falls in ``fold`` are held out of training. A null text is
    empty and has the end token only; a null id is never held out; repeated rows
    are scored each. With nothing to train on, every token has the share of an
    unknown one.
    """
    rows = texts(docs)
    rows = rows.select("doc_id", in_fold(F.col("doc_id"), fold).alias("held_out"), "text")
    train = rows.where(~F.col("held_out"))
    counts = keep(count_tokens(train))
    words = vocabulary(counts, own, at_hand)
    sc = docs.sparkSession.sparkContext
    encoded = keep(train.select("text").mapInArrow(partial(_encode, shared=sc.broadcast(words)), "ids binary"))
    model, _ = baum_welch(encoded, words, states, rounds)
    scored = keep(rows.mapInArrow(partial(_score, shared=sc.broadcast((words, model))), _SCORED_DDL))

    # Tokens that did not travel: their counts are joined, and each look's sums are a small list.
    sums = F.array(*(F.lit(float(c + 0.5 * (d + 1))) for c, d in zip(words.look_count, words.look_distinct, strict=True)))
    rare = scored.where(F.col("token").isNotNull()).select("row", "token", "n", "look")
    c = F.coalesce("c", F.lit(0)) + 0.5
    extra = rare.join(counts, "token", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10(c / F.lit(words.total + 0.5 * (words.distinct + 1)))).alias("more_base"),
        F.sum(F.col("n") * F.log10(c / F.element_at(sums, F.col("look") + 1))).alias("more_score"),
    )
    return (
        scored.where(F.col("token").isNull())
        .join(extra, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            F.lit(words.total).cast("bigint").alias("train_tokens"),
            (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
            (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
        )
    )
