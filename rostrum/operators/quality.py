"""Data-quality checks. Each returns what is wrong; nothing wrong is an empty result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.plans.registry import Models

# What the models promise about their key columns.
NOT_NULL = (
    ("stg_mandats", "mandat_uid"),
    ("stg_organes", "organe_uid"),
    ("stg_documents", "document_uid"),
    ("stg_dossiers_parlementaires", "dossier_uid"),
    ("stg_dossier_actes_legislatifs", "dossier_uid"),
)
UNIQUE = (
    ("stg_organes", "organe_uid"),
    ("stg_documents", "document_uid"),
    ("stg_dossiers_parlementaires", "dossier_uid"),
)
REQUIRED_SOURCES = (
    "acteurs",
    "mandats",
    "organes",
    "interventions",
    "points_seance",
    "comptes_rendus",
    "scrutins",
    "questions_ecrites",
    "questions_ecrites_renouvellements",
    "scrutin_votes_individuels",
    "scrutin_groupes_votes",
    "documents",
    "dossiers_parlementaires",
    "dossier_actes_legislatifs",
    "amendements",
)


class ValidationError(ValueError):
    """A table breaks a promise its readers rely on."""


def is_missing(column: str) -> Column:
    """True for NULL and for empty text."""
    return F.col(column).isNull() | (F.col(column).cast("string") == "")


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, missing)`` for each of ``columns``, in one pass over ``df``."""
    counted = df.agg(*[F.count_if(is_missing(c)).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "missing")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row, with their number of rows; NULL is no value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def exact_duplicates(mandates: DataFrame) -> DataFrame:
    """Mandates loaded more than once: equal in every column but the load time.

    Rows are first told apart by 64-bit hashes, eight bytes a row; whole rows are
    compared only where a hash comes twice, which few do unless they are repeats.
    """
    business = [c for c in mandates.columns if c != "ingested_at"]
    hashed = mandates.withColumn("_hash", F.xxhash64(*business))
    twice = (
        hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_hash")
    )
    return (
        hashed.join(twice, "_hash", "left_semi")
        .groupBy(*business)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def missing_sources(spark: SparkSession, database: str) -> list[str]:
    """The required raw tables that ``database`` lacks, by name."""
    return sorted(t for t in REQUIRED_SOURCES if not spark.catalog.tableExists(f"{database}.{t}"))


def require_sources(spark: SparkSession, database: str) -> None:
    missing = missing_sources(spark, database)
    if missing:
        raise ValidationError(
            f"raw tables missing in {database}: {', '.join(missing)}; run the ingest jobs first"
        )


def failures(models: Models) -> DataFrame:
    """``(check, model, column_name, failures)`` for every promise of the models."""
    found = [
        *[("unique", m, c, repeated_values(models[m], c)) for m, c in UNIQUE],
        ("no_exact_duplicates", "stg_mandats", "*", exact_duplicates(models["stg_mandats"])),
    ]
    counted = [
        rows.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(check).alias("check"),
            F.lit(model).alias("model"),
            F.lit(column).alias("column_name"),
            "failures",
        )
        for check, model, column, rows in found
    ]
    # A model's missing keys are counted in one pass over it.
    for model in dict.fromkeys(m for m, _ in NOT_NULL):
        columns = [c for m, c in NOT_NULL if m == model]
        nulls = models[model].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        counted.append(
            nulls.unpivot([], columns, "column_name", "failures").select(
                F.lit("not_null").alias("check"), F.lit(model).alias("model"), "column_name", "failures"
            )
        )
    result = counted[0]
    for more in counted[1:]:
        result = result.unionByName(more)
    return result


def require_promises(models: Models) -> None:
    broken = failures(models).where(F.col("failures") > 0).collect()
    if broken:
        raise ValidationError(
            "; ".join(f"{r.check} {r.model}.{r.column_name}: {r.failures}" for r in broken)
        )
