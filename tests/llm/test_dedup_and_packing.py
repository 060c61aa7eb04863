"""Exact deduplication, packing, toxicity and the pipeline on small tables."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

import corpus_pipeline
from rostrum.llm import packing, toxicity
from rostrum.llm.exact_dedup import DigestIndex
from tests.llm import tricky

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def index(spark, buckets=4):
    return DigestIndex(spark, f"index_{uuid.uuid4().hex}", buckets)


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def test_exact_dedup(spark):
    found = index(spark).admit(tricky.documents(spark)).collect()
    rows = [(i, normal(t)) for i, t, *_ in tricky.rows()]
    groups: dict[str, list] = {}
    for i, text in rows:
        groups.setdefault(text, []).append(i)
    expected = []
    for i, text in rows:
        ids = [x for x in groups[text] if x is not None]
        expected.append((i, min(ids, default=None), len(groups[text]), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == sorted(expected, key=repr)
    kept = [r for r in found if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_later_batches_meet_the_index(spark):
    seen = index(spark)
    batch = [spark.createDataFrame(rows, "doc_id bigint, text string") for rows in ([(5, "a  b"), (6, "c")], [(1, "a b"), (2, "d"), (3, "d")])]
    assert {(r.doc_id, r.keep_id, r.kept) for r in seen.admit(batch[0]).collect()} == {(5, 5, True), (6, 6, True)}
    again = {(r.doc_id, r.keep_id, r.kept) for r in seen.admit(batch[1]).collect()}
    assert again == {(1, 5, False), (2, 2, True), (3, 2, False)}
    assert seen.table().count() == 3
    assert seen.admit(tricky.empty(spark)).count() == 0


def test_first_copies_keep_all_columns(spark):
    docs = tricky.documents(spark)
    found = index(spark).first_copies(docs)
    assert found.columns == docs.columns
    assert sorted((normal(r.text) for r in found.collect())) == sorted({normal(t) for _, t, *_ in tricky.rows()})


def test_packing_round_trip(spark):
    window = 64
    found = packing.pack(tricky.documents(spark), TOKENIZER, window).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = []
    for i, text, *_ in tricky.rows():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        for start in range(0, len(ids), window):
            part = np.array(ids[start : start + window], "<u4")
            want.append((i, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
    assert sorted(((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found), key=repr) == sorted(want, key=repr)
    sequences: dict[int, list] = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    assert len(sequences) <= sum(r.length for r in found) / window * 1.1 + 2


def test_words_are_encoded_as_whole_texts_are():
    texts = [
        "a <|endoftext|> b", "x<|endoftext|>'s it's ÀÉ é ́x İ Σας 'S", "", "   a　b \x1c c\x85d",
        "don't we'll\t\n I'm ①② ½ 𝟘, a.b c... d., é.", "ÿ, µ. ª º ß. Ω.", "12,5. x1. ",
    ]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    for text, ids in zip(texts, packing.WordIds(TOKENIZER).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_best_fit_decreasing_takes_the_tightest_window():
    draw = np.random.default_rng(0)
    lengths = np.sort(draw.integers(1, 101, 400))[::-1]
    names, offsets = packing.best_fit_decreasing(lengths, 100)
    room: list[int] = []
    for length, name, offset in zip(lengths, names, offsets, strict=True):
        fits = [r for r in room if r >= length]
        if fits:
            assert room[name] == min(fits) and offset == 100 - room[name]
        else:
            assert name == len(room) and offset == 0
            room.append(100)
        room[name] -= length


def test_toxic_documents_are_found(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = ([r.score for r in found if r.toxic == y] for y in (1, 0))
    ahead = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert ahead > 0.88
    assert np.mean([s >= 0.5 for s in clean]) < 0.02


def test_toxicity_of_tricky_rows(spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 20)] + [(None, 1, 1), (3, 0, None)], "doc_id bigint, quality int, toxic int")
    found = toxicity.score_toxicity(tricky.documents(spark), labels).collect()
    assert len(found) == len(tricky.rows()) and all(0 <= r.score <= 1 for r in found)
    none = toxicity.score_toxicity(tricky.documents(spark), labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert toxicity.score_toxicity(tricky.empty(spark), labels).count() == 0


def test_marginals_are_those_of_all_paths():
    draw = np.random.default_rng(5)
    moves = draw.normal(size=(2, 2))
    lengths = np.array([3, 1, 6, 2])
    potentials = draw.normal(size=lengths.sum())
    found = toxicity.Chains(lengths).marginals(potentials, moves)
    at = 0
    for n in lengths:
        mine, total = np.zeros(n), 0.0
        for path in np.ndindex(*[2] * n):
            weight = np.exp(sum(p * s for p, s in zip(potentials[at : at + n], path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
            total += weight
            mine += weight * np.array(path)
        assert np.allclose(found[at : at + n], mine / total)
        at += n


def test_pipeline(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, sf_dir)
        assert kept.columns == docs.columns
        assert kept.join(before, "doc_id", "left_anti").count() == 0
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in kept.select("doc_id").collect()}
    texts = [r.text for r in kept.dropDuplicates(["doc_id"]).collect()]
    assert len({normal(t) for t in texts}) == len(texts)


@pytest.mark.parametrize("stage", [stage for _, stage in corpus_pipeline.STAGES], ids=[name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_tricky_and_no_rows(spark, stage):
    sf_dir = "/root/testdata/sf0.001"
    assert stage(spark, tricky.empty(spark), sf_dir).count() == 0
    assert stage(spark, tricky.documents(spark), sf_dir).count() > 0


def test_index_has_one_file_per_bucket_however_rows_are_dealt(spark, monkeypatch):
    """Before, 50 partitions wrote up to 8 files each."""
    dealt = DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda df, n, *by: dealt(df, max(n, 50), *by))
    docs = spark.range(400).selectExpr("id as doc_id", "cast(id as string) as text")
    found = index(spark, 8)
    assert found.admit(docs).where("kept").count() == 400
    assert len(found.table().inputFiles()) == 8
