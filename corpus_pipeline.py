"""The corpus pipeline: documents to packed training sequences, in five stages."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rostrum.llm import common, jaccard_join, mixing, packing, toxicity
from rostrum.llm.exact_dedup import DigestIndex


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the conditional random field predicts toxic go."""
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, the first stays."""
    return DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}").first_copies(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, the first stays."""
    return jaccard_join.one_of_each(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Smaller sources are repeated, whole documents at most twice; none is left out."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in the order of the mixture; returns the pieces of documents they consist of."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), carry=("source",))
    return packing.pack_in_order(mixing.places(pieces, "doc_id", "start", "ids_crc32"), mixing.PLACED)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", one_of_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack),
]

# Learned models, exact signatures and tokenizers cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each result kept in the shared folder."""
    docs = common.documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = common.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
