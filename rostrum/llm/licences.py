"""Licence scans: notice phrases and identifier tags, and what their expressions allow.

One Aho-Corasick automaton over the words of a text finds every notice phrase
and every identifier tag in a single pass. The expression behind a tag, with
``and``, ``or``, ``with`` and parentheses, is put into postfix order by a
shunting-yard parser and evaluated to how freely the text may be used.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame

from rostrum.llm.common import each_batch, texts

# Phrases that the contract counts, with their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notices.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "creative commons attribution": "cc-by",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "the unlicense": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
# How freely a text under a licence family may be used: 1 without conditions
# but naming the author, 0 not at all. An identifier belongs to the family
# whose name it begins with; the longest wins.
FREEDOM = {
    "public-domain": 1.0,
    "unlicense": 1.0,
    "cc0": 1.0,
    "mit": 0.95,
    "isc": 0.95,
    "bsd": 0.95,
    "apache": 0.9,
    "cc-by": 0.85,
    "mpl": 0.6,
    "epl": 0.6,
    "lgpl": 0.5,
    "cc-by-sa": 0.5,
    "gpl": 0.3,
    "agpl": 0.2,
    "cc-by-nd": 0.2,
    "cc-by-nc": 0.2,
    "all-rights-reserved": 0.0,
}
UNKNOWN = 0.4  # an identifier of no family
EXCEPTION = 0.2  # what an exception (``with``) adds

_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_FAMILIES = sorted(FREEDOM, key=len, reverse=True)
# Bytes of words: digits, letters and all beyond ASCII; capitals are lowered.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)
_TAG_LINE = re.compile(rb"(?i)spdx-license-identifier:[\x20\t]*([^\r\n]*)")
_EXPRESSION_TOKEN = re.compile(r"[()]|[a-z0-9.+:-]+")


def expression_tokens(line: str) -> list[str]:
    """The longest beginning of a lower-case line that reads as an expression."""
    taken: list[str] = []
    whole, depth, operand_next = 0, 0, True
    at = 0
    while match := re.compile(r"\s*").match(line, at):
        token = _EXPRESSION_TOKEN.match(line, match.end())
        if not token:
            break
        word, at = token[0], token.end()
        if operand_next and word == "(":
            depth += 1
        elif operand_next and word not in _PRECEDENCE and word != ")":
            operand_next = False
        elif not operand_next and word == ")" and depth:
            depth -= 1
        elif not operand_next and word in _PRECEDENCE:
            operand_next = True
        else:
            break
        taken.append(word)
        if not operand_next and depth == 0:
            whole = len(taken)
    return taken[:whole]


def postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: an expression's operands and operators in postfix order."""
    out: list[str] = []
    waiting: list[str] = []
    for token in tokens:
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif token in _PRECEDENCE:
            while waiting and waiting[-1] != "(" and _PRECEDENCE[waiting[-1]] >= _PRECEDENCE[token]:
                out.append(waiting.pop())
            waiting.append(token)
        else:
            out.append(token)
    return out + waiting[::-1]


def freedom(identifier: str) -> float:
    family = next((f for f in _FAMILIES if identifier.startswith(f)), None)
    return UNKNOWN if family is None else FREEDOM[family]


def evaluate(order: list[str]) -> tuple[float, set[str]]:
    """Freedom that a postfix expression grants, and the licences it names.

    ``or`` leaves the freer choice, ``and`` binds to the stricter, and an
    exception loosens the licence it goes with.
    """
    stack: list[tuple[float, set[str]]] = []
    for token in order:
        if token in _PRECEDENCE:
            (b, named_b), (a, named_a) = stack.pop(), stack.pop()
            if token == "with":
                stack.append((min(1.0, a + EXCEPTION), named_a))
            else:
                stack.append((max(a, b) if token == "or" else min(a, b), named_a | named_b))
        else:
            stack.append((freedom(token), {token.rstrip(".,+")}))
    return stack[0]


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase, label in {**NOTICES, **BASE, TAG: TAG}.items():
        # Latin-1 keeps one character per byte, so one automaton serves all texts.
        found.add_word(f" {phrase} ", (phrase, label))
    found.make_automaton()
    return found


def scan(text: str, phrases) -> tuple[int, list[tuple[int, str]], list[tuple[int, str]], float]:
    """Words, base places, other places (word number and label), and the score of a text."""
    raw = text.encode()
    words = raw.translate(_TO_WORDS).split()
    line = f" {b' '.join(words).decode('latin-1')} "
    base, more, grants = [], [], []
    tagged, starts = False, None
    for end, (phrase, label) in phrases.iter(line):
        if label == TAG:
            tagged = True
            continue
        if starts is None:
            starts = [1]  # of each word in the line
            for word in words:
                starts.append(starts[-1] + len(word) + 1)
        place = bisect_left(starts, end - len(phrase))
        (base if phrase in BASE else more).append((place, label))
        grants.append(FREEDOM[label])
    if tagged:
        for match in _TAG_LINE.finditer(raw):
            tokens = expression_tokens(match[1].decode(errors="replace").lower())
            if tokens:
                grant, named = evaluate(postfix(tokens))
                grants.append(grant)
                more += [(-1, name) for name in named if name]
    return len(words), base, more, min(grants, default=0.0)


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
    ]
)
_MADE: list = []


def _scan_batch(batch: pa.RecordBatch) -> dict:
    if not _MADE:
        _MADE.append(automaton())
    out: dict[str, list] = {name: [] for name in _OUT.names[1:]}
    for text in batch.column(1).to_pylist():
        n, base, more, score = scan(text, _MADE[0])
        labels = {label for _, label in base}
        out["n_words"].append(n)
        out["n_base"].append(len(base))
        out["first_word"].append(min((at for at, _ in base), default=None))
        out["last_word"].append(max((at for at, _ in base), default=None))
        out["base_labels"].append(",".join(sorted(labels)))
        out["labels"].append(",".join(sorted(labels | {label for _, label in more})))
        out["score"].append(score)
    return {"doc_id": batch.column(0), **out}


def scan_licences(docs: DataFrame) -> DataFrame:
    """One row per document: words, places of the base phrases, labels and a score.

    The score says how freely the text may be used, 0 to 1, over all notices and
    expressions it carries (as if joined by ``and``); 0 without any. A null text
    is empty: no words, no places, empty labels. Repeated rows give repeated
    results, a null id stays null, and broken expressions count as far as they
    can be read.
    """
    return each_batch(
        texts(docs),
        _scan_batch,
        _OUT,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double",
    )
