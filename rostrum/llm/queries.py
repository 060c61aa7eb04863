"""The registered queries: each applies one operator to a whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rostrum.llm import common, packing
from rostrum.llm.collocations import collocations
from rostrum.llm.exact_dedup import DigestIndex
from rostrum.llm.hidden_markov import score_documents
from rostrum.llm.jaccard_join import near_duplicates
from rostrum.llm.licences import scan_licences
from rostrum.llm.mixing import mixture, realised
from rostrum.llm.periodic import periodic_runs
from rostrum.llm.secrets import scan_secrets
from rostrum.llm.simhash import near_duplicates as near_by_simhash
from rostrum.llm.suffix_dedup import remove_repeats
from rostrum.llm.toxicity import score_toxicity
from rostrum.llm.weighted_sampling import fingerprints


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}")
    return index.admit(common.documents(spark, sf_dir))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        common.documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")
    )


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(common.documents(spark, sf_dir))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(common.documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_toxicity(common.documents(spark, sf_dir), labels)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.documents(spark, sf_dir), words=4, percent=85)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(common.documents(spark, sf_dir))


def op3_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(common.documents(spark, sf_dir))


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(common.documents(spark, sf_dir))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(common.documents(spark, sf_dir))


def op9_realised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return realised(common.documents(spark, sf_dir))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(common.documents(spark, sf_dir))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_by_simhash(common.documents(spark, sf_dir))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(common.documents(spark, sf_dir))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_licences": op2_licences,
    "op3_hidden_markov": op3_hidden_markov,
    "op4_toxicity": op4_toxicity,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_secrets": op7_secrets,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_mixing": op9_mixing,
    "op9_realised": op9_realised,
    "op10_pack": op10_pack,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_simhash": op12_simhash,
    "op13_collocations": op13_collocations,
}
