"""Removal of repeated strings against a plain reading of its contract."""

from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rostrum.llm import suffix_dedup as suffix
from tests.llm import tricky


def plain(rows, span):
    first = {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - span + 1):
            piece = raw[i : i + span]
            order = suffix.NO_ID if doc_id is None else doc_id
            first[piece] = min(first.get(piece, order), order)
    out = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        order = suffix.NO_ID if doc_id is None else doc_id
        gone = bytearray(len(raw))
        for i in range(len(raw) - span + 1):
            if first[raw[i : i + span]] < order:
                gone[i : i + span] = b"\1" * span
        spans = sum(g and not b for g, b in zip(gone, b"\0" + bytes(gone), strict=False))
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, frame=None, **how):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3) if frame is None else frame
    found = suffix.remove_repeats(frame, **how)
    assert tricky.by_id(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == plain(rows, how.get("span", 50))


def test_tricky_rows(spark):
    check(spark, [(i, t) for i, t, *_ in tricky.rows()], tricky.documents(spark))


def made(seed):
    draw = random.Random(seed)
    words = [f"w{'éxyz'[i % 4]}{i}" for i in range(400)]
    passages = [" ".join(draw.choices(words, k=draw.randrange(5, 60))) for _ in range(12)] + ["ab" * 300, "a" * 500]
    rows = []
    for i in range(90):
        parts = [" ".join(draw.choices(words, k=draw.randrange(0, 40))) for _ in range(draw.randrange(0, 4))]
        parts += draw.choices(passages, k=draw.randrange(0, 4))
        draw.shuffle(parts)
        text = " ".join(parts)
        rows.append((1000 - i if i % 2 else i, text))
        if i % 9 == 0 and text:
            cut = draw.randrange(len(text))
            rows.append((2000 + i, text[:cut] + "#" + text[cut + 1 :]))
            rows.append((3000 + i, text))
    return rows


@pytest.mark.parametrize("how", [{}, {"group_bytes": 4000}, {"group_bytes": 4000, "common": 3}])
def test_copies_and_passages(spark, how):
    check(spark, made(1), **how)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.binary(min_size=0, max_size=6), max_size=8), min_size=1, max_size=7))
def test_merging_front_coded_runs(runs):
    runs = [sorted(set(run)) for run in runs]
    found = list(suffix.merged([suffix.front_coded(run) for run in runs]))
    assert [key for key, *_ in found] == sorted(x for run in runs for x in run)
    assert all(runs[run][i] == key for key, _, run, i in found)
    before = b""
    for key, prefix, *_ in found:
        assert prefix == suffix.common_prefix(before, key, 0)
        before = key


def test_no_documents(spark):
    assert suffix.remove_repeats(tricky.empty(spark)).count() == 0
