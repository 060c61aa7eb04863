"""Temperature mixing: exponents, whole realisation, and the query against SQL."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from checks.compare import difference, duckdb_over
from rostrum.llm import mixing, oracles, packing
from rostrum.llm.queries import QUERIES
from tests.llm import tricky


def test_exponent_meets_the_entropy_or_the_limit():
    tokens = [900.0, 300.0, 100.0, 100.0]
    x = mixing.exponent_for(tokens, target=0.9, most=1e9)
    assert mixing.entropy(mixing.weights(tokens, x)) == pytest.approx(0.9 * mixing.entropy([0.25] * 4), abs=1e-6)
    x = mixing.exponent_for(tokens, target=1.0, most=3.0)
    assert max(mixing.repeats(tokens, x)) == pytest.approx(3.0, abs=1e-6)
    assert mixing.exponent_for([5.0, 5.0]) == mixing.exponent_for([5.0]) == 1.0
    assert mixing.exponent_for(tokens, target=1.0, most=9.0) == pytest.approx(0.0, abs=1e-6)


def skewed(spark, n=3000):
    return spark.range(n).selectExpr(
        "id as doc_id", "repeat('word ', cast(id % 17 as int)) as text",
        "if(id % 10 < 7, 'big', if(id % 10 < 9, 'mid', 'small')) as source", "'x' as _block", "1 as copies",
    )


def test_every_document_comes_and_budgets_hold(spark):
    docs = skewed(spark)
    mixed = mixing.mix(docs, target=1.0, most=2.5).select("doc.doc_id", "doc.source", "round").collect()
    taken = Counter(r.doc_id for r in mixed)
    assert set(taken) == set(range(3000))
    tokens = {i: i % 17 + 1 for i in range(3000)}
    own = {s: sum(tokens[r.doc_id] for r in mixed if r.source == s and r.round == 0) for s in ("big", "mid", "small")}
    got = {s: sum(tokens[r.doc_id] for r in mixed if r.source == s) / own[s] for s in own}
    want = dict(zip(own, mixing.repeats(list(own.values()), mixing.exponent_for(list(own.values()), 1.0, 2.5)), strict=True))
    for source in own:
        assert want[source] - 0.02 <= got[source] <= want[source] + 1e-9
    assert set(taken[r.doc_id] for r in mixed if r.source == "big") == {1}


def test_mixture_keeps_columns_and_order_is_repeatable(spark):
    docs = skewed(spark)
    first, second = (mixing.mixed_documents(docs, 1.0).collect() for _ in range(2))
    assert mixing.mixed_documents(docs).columns == docs.columns and first == second


def test_tricky_rows(spark):
    found = mixing.mixture(tricky.documents(spark)).collect()
    assert len(found) == len(tricky.rows())
    assert {r.source for r in found if r.doc_id is None} == {""}
    assert mixing.mixture(tricky.empty(spark)).count() == mixing.mixed_documents(tricky.empty(spark)).count() == 0


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_matches_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    with duckdb_over(sf_dir) as duck:
        assert difference(QUERIES[name](spark, sf_dir), duck, oracles.SQL[name]) is None
        # and with one source far larger than the others
        duck.execute("create or replace temp table skewed as select * replace (if(doc_id % 3 > 0, 'src0', source) as source) from documents")
        duck.execute("create or replace temp view documents as select * from skewed")
        if name == "op9_mixing":
            docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr(
                "* except (source)", "if(doc_id % 3 > 0, 'src0', source) as source"
            )
            assert difference(mixing.mixture(docs), duck, oracles.SQL[name]) is None


def test_realised_rows_are_the_mixture_in_rounds(spark):
    docs = skewed(spark)
    rows = mixing.realised(docs, target=1.0, most=2.5).collect()
    assert {r.doc_id for r in rows} == set(range(3000)) and max(r.round for r in rows) > 0
    rounds = {}
    for r in rows:
        rounds.setdefault(r.doc_id, []).append(r.round)
        assert r.source == ("big" if r.doc_id % 10 < 7 else "mid" if r.doc_id % 10 < 9 else "small")
    assert all(sorted(rounds[r.doc_id]) == list(range(r.copies)) for r in rows)
    # Each round has an order of its own, and sources interleave in it.
    mid = {k: [r.block for r in sorted(rows, key=lambda r: (r.place, r.block)) if r.source == "mid" and r.round == k] for k in (0, 1)}
    both = set(mid[0]) & set(mid[1])
    assert [b for b in mid[0] if b in both] != [b for b in mid[1] if b in both]
    order = [r.source for r in sorted(rows, key=lambda r: (r.round, r.place, r.doc_id)) if r.round == 0]
    assert len(set(order[:100])) == 3
    assert mixing.realised(tricky.empty(spark)).count() == 0
    assert {r.doc_id for r in mixing.realised(tricky.documents(spark)).collect()} == {r[0] for r in tricky.rows()}


@pytest.mark.parametrize("pieces_per_task", [50_000, 300])
def test_packing_keeps_the_order_of_the_mixture(spark, monkeypatch, pieces_per_task):
    monkeypatch.setattr(packing, "PIECES_PER_TASK", pieces_per_task)
    mixed = corpus_pipeline.mix_sources(spark, skewed(spark), "").cache()
    rows = corpus_pipeline.pack(spark, mixed, "").collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in mixed.collect())
    # Every document has come once before any comes again, and no sequence has one twice.
    rows.sort(key=lambda r: (r.sequence_id, r.offset))
    assert len({r.doc_id for r in rows[:3000]}) == 3000 and len(rows) > 3300
    assert len({(r.sequence_id, r.doc_id) for r in rows}) == len(rows)
    ends = {}
    for r in rows:
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
        assert ends[r.sequence_id] <= packing.WINDOW
    if pieces_per_task == 300:  # stretches follow the places
        place = {r.doc_id: r.place for r in mixing.realised(skewed(spark)).collect() if r.round == 0}
        spans = {}
        for r in rows[:3000]:
            spans.setdefault(r.sequence_id >> 32, []).append(place[r.doc_id])
        found = [spans[k] for k in sorted(spans)]
        assert len(found) > 5 and all(max(a) <= min(b) for a, b in zip(found, found[1:], strict=False))


@pytest.mark.parametrize(("dominant", "short"), [(4000, 800), (9000, 400), (15000, 300), (6000, 0)])
def test_weights_are_met_with_one_dominant_document(spark, dominant, short):
    words = spark.range(short + 1).selectExpr(
        "if(id = 0, -1, id) as doc_id", f"repeat('word ', if(id = 0, {dominant - 1}, 9)) as text", "'small' as source"
    )
    docs = words.unionByName(spark.range(1000, 4000).selectExpr("id as doc_id", "repeat('word ', 9) as text", "'big' as source"))
    own = {"big": 30000.0, "small": float(dominant + 10 * short)}
    for most in (1.3, 1.6, 1.9):
        taken = mixing.realised(docs, target=1.0, most=most).collect()
        x = mixing.exponent_for(list(own.values()), 1.0, most)
        for source, want in zip(own, mixing.repeats(list(own.values()), x), strict=True):
            extra = sum(r.n_tokens for r in taken if r.source == source and r.round == int(want))
            budget = (want - int(want)) * own[source]
            again = {r.block for r in taken if r.source == source and r.round == int(want)}
            left_out = {}
            for r in taken:
                if r.source == source and r.round == 0 and r.block not in again:
                    left_out[r.block] = left_out.get(r.block, 0) + r.n_tokens
            # Within half of the least block left out, or by half of one taken beyond.
            assert budget - extra <= min(left_out.values(), default=0) / 2 + 1
            assert extra - budget <= dominant / 2 + 1
            if short >= 400:
                assert abs(extra - budget) <= 0.01 * own[source] or dominant > budget


def test_last_round_passes_over_a_block_that_does_not_fit(spark):
    rows = [("s", 1, 10, 6, 50.0), ("s", 2, 20, 900, 50.0), ("s", 3, 30, 40, 50.0), ("s", 4, 40, 5, 50.0), ("one", 7, 1, 100, 60.0), ("two", 7, 1, 100, 40.0)]
    ordered = spark.createDataFrame(rows, "_source string, _block bigint, _order bigint, _tokens bigint, _budget double")
    found = {r["_of"]: r["_taken"] for r in mixing._last_round(ordered).collect()}
    assert found == {"s": [1, 3, 4], "one": [7], "two": []}
