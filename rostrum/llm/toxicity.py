"""Toxic spans by a linear-chain conditional random field of two states.

Tokens are clean or toxic. The potential of a token is the sum of the weights of
its features (the word, its beginnings and its end, hashed); neighbours are tied
by a transition table. Documents are labelled, tokens are not: the labelled
tokens are those of toxic documents whose word or beginning is found
significantly more often in toxic documents than in clean ones. Training climbs
the likelihood by the gap between these labels and forward-backward marginals.
A document's score comes from the marginals of its tokens.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import in_fold

# The bound of the sample that the model is fitted on: documents of each class.
SAMPLE_PER_CLASS = 3000
FEATURES = 1 << 18
BEGINNINGS = (4, 5, 6)
ROUNDS = 25
RATE = 0.3
# A word marks toxic text if G squared of its document counts reaches this (p < 0.005)
# and its rate among toxic documents is this many times the other.
EVIDENCE = 8.0
TIMES = 8.0
# Chains start anew after so many tokens, which bounds the steps of a batch.
CHAIN = 2048
CACHED_WORDS = 300_000

_TO_WORDS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_WORD = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def tokens(text: str) -> list[bytes]:
    return text.lower().encode(errors="replace").translate(_TO_WORDS).split()


def features(word: bytes) -> list[int]:
    text = word.decode(errors="replace")
    names = [f"={text}", f"${text[-3:]}", *(f"{n}{text[:n]}" for n in BEGINNINGS if len(text) >= n)]
    return [zlib.crc32(name.encode(errors="replace")) % FEATURES for name in names]


@dataclass
class Field:
    """Weights of features, and potentials: bias, transitions by (from, to), calibration."""

    weights: np.ndarray
    bias: float
    moves: np.ndarray
    calibration: np.ndarray
    trained: bool = True

    @staticmethod
    def untrained() -> Field:
        return Field(np.zeros(FEATURES, np.float32), 0.0, np.zeros((2, 2)), np.zeros(3), False)

    def potential(self, word: bytes) -> float:
        return self.bias + float(self.weights[features(word)].sum())


class Chains:
    """Chains of token potentials laid out by step, the longest chain first.

    Step ``t`` of all chains longer than ``t`` is one slice, so forward and
    backward recursions run over whole batches at once.
    """

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        sizes = lengths[self.order]
        steps = int(sizes[0]) if len(sizes) else 0
        self.active = np.searchsorted(-sizes, -np.arange(steps), side="left")
        self.first = np.concatenate([[0], np.cumsum(self.active)])
        rank = np.empty(len(lengths), np.int64)
        rank[self.order] = np.arange(len(lengths))
        ends = np.cumsum(lengths)
        step = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lengths, lengths)
        self.place = self.first[step] + np.repeat(rank, lengths)  # of each token, chain by chain

    def marginals(self, potentials: np.ndarray, moves: np.ndarray) -> np.ndarray:
        """Probability that each token is toxic, given its whole chain.

        Only ratios of toxic to clean messages are kept, so nothing under- or overflows.
        """
        (a00, a01), (a10, a11) = np.exp(moves)
        weight = np.empty(len(potentials))
        weight[self.place] = np.exp(np.clip(potentials, -40, 40))
        ahead = np.empty(len(potentials))
        steps = len(self.active)
        for t in range(steps):
            here = slice(self.first[t], self.first[t + 1])
            if t == 0:
                ahead[here] = weight[here]
            else:
                before = ahead[self.first[t - 1] : self.first[t - 1] + self.active[t]]
                ahead[here] = weight[here] * (a01 + before * a11) / (a00 + before * a10)
        back = np.ones(len(potentials))
        for t in range(steps - 2, -1, -1):
            n = self.active[t + 1]
            after = slice(self.first[t + 1], self.first[t + 1] + n)
            pull = weight[after] * back[after]
            back[self.first[t] : self.first[t] + n] = (a10 + a11 * pull) / (a00 + a01 * pull)
        odds = ahead * back
        return (odds / (1 + odds))[self.place]


def chain_lengths(n: int) -> list[int]:
    return [CHAIN] * (n // CHAIN) + [n % CHAIN] * (n % CHAIN > 0)


def summary(marginals: np.ndarray) -> tuple[float, float]:
    """Logarithms of the odds of the surest token, and of the expected toxic tokens."""
    most = min(float(marginals.max(initial=0.0)), 1 - 1e-9)
    return math.log((most + 1e-9) / (1 - most)), math.log(float(marginals.sum()) + 1e-6)


def toxic_terms(docs: list[list[bytes]], labels: list[int]) -> set[bytes]:
    """Words and beginnings of words that mark toxic documents.

    Chosen one by one, by what they explain of the toxic documents that no term
    explains yet; so words that merely stand beside toxic ones, or in copies of
    one toxic document, are not taken.
    """
    places: dict[bytes, list[int]] = {}
    clean_count: Counter = Counter()
    for i, (words, label) in enumerate(zip(docs, labels, strict=True)):
        distinct = set(words)
        terms = distinct.union(b"^" + w[:n] for w in distinct for n in BEGINNINGS if len(w) >= n)
        if label:
            for term in terms:
                places.setdefault(term, []).append(i)
        else:
            clean_count.update(terms)
    toxic, clean = labels.count(1), labels.count(0)

    def evidence(term: bytes, a: int) -> float:
        b = clean_count[term]
        if a / toxic < TIMES * (b + 0.1) / (clean + 1):
            return 0.0
        share = (a + b) / (toxic + clean)
        cells = ((a, toxic * share), (b, clean * share), (toxic - a, toxic * (1 - share)), (clean - b, clean * (1 - share)))
        return 2 * sum(o * math.log(o / e) for o, e in cells if o > 0 and e > 0)

    heap = [(-evidence(term, len(at)), term) for term, at in places.items()]
    heap = [x for x in heap if -x[0] >= EVIDENCE]
    heapq.heapify(heap)
    chosen, explained = set(), set()
    while heap:
        found, term = heapq.heappop(heap)
        now = -evidence(term, sum(i not in explained for i in places[term]))
        if now > -EVIDENCE:
            continue
        if now > found:  # it has lost documents since; others may come first
            heapq.heappush(heap, (now, term))
            continue
        chosen.add(term)
        explained.update(places[term])
    return chosen


def fit(texts: list[str], labels: list[int]) -> Field:
    """The field of labelled texts; untrained when a class is missing."""
    if len(set(labels)) < 2:
        return Field.untrained()
    docs = [tokens(text) for text in texts]
    marks = toxic_terms(docs, labels)

    def marked(word: bytes) -> bool:
        return word in marks or any(b"^" + word[:n] in marks for n in BEGINNINGS if len(word) >= n)

    number = {word: i for i, word in enumerate(dict.fromkeys(w for words in docs for w in words))}
    by_word = [features(word) for word in number]
    owner = np.repeat(np.arange(len(by_word)), [len(x) for x in by_word])
    feature = np.array([f for x in by_word for f in x], np.int64)
    is_marked = np.array([marked(word) for word in number], bool)
    ids = [np.array([number[w] for w in words], np.int64) for words in docs]
    gold = np.concatenate([is_marked[x] if y else np.zeros(len(x), bool) for x, y in zip(ids, labels, strict=True)])
    lengths = np.array([n for x in ids for n in chain_lengths(len(x))], np.int64)
    word = np.concatenate(ids)
    if not gold.any():
        return Field.untrained()

    # Transitions from counts of the labels; the start counts as after a clean token.
    pairs = np.bincount(2 * gold[:-1].astype(int) + gold[1:], minlength=4).reshape(2, 2) + 1.0
    moves = np.log(pairs / pairs.sum(1, keepdims=True))
    moves -= moves[0, 0]
    chains = Chains(lengths)
    weights, bias = np.zeros(FEATURES), 0.0
    first, second = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    for turn in range(1, ROUNDS + 1):
        potential = bias + np.bincount(owner, weights[feature], len(number))
        gap = gold - chains.marginals(potential[word], moves)
        per_word = np.bincount(word, gap, len(number))
        slope = np.append(np.bincount(feature, per_word[owner], FEATURES), gap.sum())
        slope[:-1] -= 0.05 * weights  # a weak pull to nothing
        first += 0.1 * (slope - first)
        second += 0.01 * (slope**2 - second)
        move = RATE * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-3)
        weights, bias = weights + move[:-1], bias + move[-1]

    potential = bias + np.bincount(owner, weights[feature], len(number))
    marginals = chains.marginals(potential[word], moves)
    ends = np.cumsum([len(x) for x in ids])
    x = np.array([[1.0, *summary(m)] for m in np.split(marginals, ends[:-1])])
    y = np.array(labels, float)
    calibration = np.zeros(3)
    for _ in range(30):  # Newton steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ calibration, -30, 30)))
        slope = x.T @ (y - p) - 0.1 * calibration
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        calibration = calibration + np.linalg.solve(bend, slope)
    return Field(weights.astype(np.float32), float(bias), moves, calibration)


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic`` of at most ``SAMPLE_PER_CLASS`` labelled documents of each class.

    Held-out rows never enter; which of the others do is decided by a hash of
    the id. A document with several labels counts as toxic if one says so.
    """
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~in_fold(F.col("doc_id"), 0))
        .groupBy(F.col("doc_id").cast("bigint").alias("_labelled"))
        .agg(F.max("toxic").alias("_toxic"))
    )
    chosen = None
    for label in (0, 1):
        # A bounded number of ids: the fit's documented bound.
        part = known.where(F.col("_toxic") == label).orderBy(F.xxhash64("_labelled"), "_labelled").limit(SAMPLE_PER_CLASS)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select(F.col("doc_id").alias("_doc"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.join(F.broadcast(chosen), F.col("_doc") == F.col("_labelled")).select(
        "_doc", "text", F.col("_toxic").cast("int").alias("toxic")
    )


def _fit_rows(batches):
    rows = sorted(row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
    field = fit([text for _, text, _ in rows], [label for _, _, label in rows])
    yield pa.RecordBatch.from_pydict(
        {
            "weights": [field.weights.astype("<f4").tobytes()],
            "rest": [[field.bias, *field.moves.ravel().tolist(), *field.calibration.tolist()]],
            "trained": [field.trained],
        }
    )


def train(docs: DataFrame, labels: DataFrame) -> Field:
    """Fit the field on the bounded sample, in one task; only weights reach the driver."""
    row = (
        sample(docs, labels)
        .repartition(1)
        .mapInArrow(_fit_rows, "weights binary, rest array<double>, trained boolean")
        .first()
    )
    if row is None:
        return Field.untrained()
    rest = np.array(row["rest"])
    weights = np.frombuffer(bytes(row["weights"]), "<f4")
    return Field(weights, rest[0], rest[1:5].reshape(2, 2), rest[5:8], row["trained"])


class _Potentials(dict):
    def __init__(self, field: Field):
        self.field = field

    def __missing__(self, word: bytes) -> float:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = self.field.potential(word)
        return found


def tag(batch: list[str], known: _Potentials) -> list[dict]:
    """Score and offending spans (code points) of each text."""
    field = known.field
    if not field.trained:
        return [{"score": 0.0, "toxic_tokens": 0, "spans": ""} for _ in batch]
    found = [[known[w] for w in tokens(text)] for text in batch]
    lengths = np.array([n for x in found for n in chain_lengths(len(x))], np.int64)
    flat = np.fromiter((p for x in found for p in x), np.float64, int(lengths.sum()))
    marginals = Chains(lengths).marginals(flat, field.moves)
    out, at = [], 0
    for text, x in zip(batch, found, strict=True):
        mine = marginals[at : at + len(x)]
        at += len(x)
        score = 1 / (1 + math.exp(-float(np.clip(np.dot([1.0, *summary(mine)], field.calibration), -30, 30))))
        sure = set(np.flatnonzero(mine >= 0.5).tolist())
        spans = ""
        if sure:
            places = (m.span() for i, m in enumerate(_WORD.finditer(text)) if i in sure)
            spans = ",".join(f"{start}:{end}" for start, end in places)
        out.append({"score": score, "toxic_tokens": len(sure), "spans": spans})
    return out


_TAGS = pa.struct([("score", pa.float64()), ("toxic_tokens", pa.int64()), ("spans", pa.string())])
TEXTS_AT_ONCE = 1000


def tagger(docs: DataFrame, field: Field):
    """A column function from texts to ``struct<score, toxic_tokens, spans>``."""
    shared = docs.sparkSession.sparkContext.broadcast(field)  # of fixed size

    @F.arrow_udf("score double, toxic_tokens bigint, spans string")
    def tags(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _Potentials(shared.value)
        for batch in batches:
            texts = [text or "" for text in batch.to_pylist()]
            found = []
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                found += tag(texts[at : at + TEXTS_AT_ONCE], known)
            yield pa.array(found, _TAGS)

    return tags


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, toxic_tokens, spans``.

    ``spans`` are the code point offsets of toxic tokens. The model reads texts
    only. A null text is empty, and an empty text has the score of no toxic
    token; a null id is never held out; repeated rows give repeated results.
    Without labels of both classes every score is 0.
    """
    tags = tagger(docs, train(docs, labels))
    doc_id: Column = F.col("doc_id").cast("bigint")
    return (
        docs.select(doc_id.alias("doc_id"), in_fold(F.col("doc_id"), 0).alias("held_out"), tags(F.col("text")).alias("_tags"))
        .select(
            "doc_id",
            "held_out",
            "_tags.score",
            F.when(F.col("_tags.score") >= 0.5, 1).otherwise(0).alias("predicted"),
            "_tags.toxic_tokens",
            "_tags.spans",
        )
    )


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with all their columns, that are not predicted toxic."""
    tags = tagger(docs, train(docs, labels))
    tagged = docs.select(F.struct("*").alias("doc"), tags(F.col("text")).alias("tags"))
    return tagged.where("tags.score < 0.5").select("doc.*")
