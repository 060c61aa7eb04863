"""Staging views: raw tables under their model column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.plans.registry import Models, view


def _contains(column: str, word: str):
    return F.lower(F.coalesce(column, F.lit(""))).contains(word)


@view
def stg_amendements(m: Models) -> DataFrame:
    """Amendments without their two long texts."""
    return (
        m.raw("amendements")
        .drop("dispositif", "expose_sommaire")
        .withColumnRenamed("uid", "amendement_uid")
    )


@view
def stg_commissions(m: Models) -> DataFrame:
    """Bodies that look like committees by type or label."""
    return (
        m.raw("organes")
        .where(_contains("code_type", "com") | _contains("libelle", "commission"))
        .select(
            F.col("uid").alias("commission_uid"),
            *("code_type", "libelle", "libelle_abrege", "libelle_abrev", "legislature"),
            *("date_debut", "date_fin", "circo_region_type", "circo_region_libelle"),
            *("gp_position_politique", "ingested_at"),
        )
    )


@view
def stg_comptes_rendus(m: Models) -> DataFrame:
    return (
        m.raw("comptes_rendus")
        .withColumn("date_seance", m.sitting_date(F.col("date_seance")))
        .withColumnRenamed("uid", "compte_rendu_uid")
    )


@view
def stg_deputes(m: Models) -> DataFrame:
    full_name = F.concat(
        F.coalesce("prenom", F.lit("")), F.lit(" "), F.coalesce("nom", F.lit(""))
    )
    return (
        m.raw("acteurs")
        .withColumn("nom_complet", full_name)
        .withColumnRenamed("uid", "depute_uid")
    )


@view
def stg_documents(m: Models) -> DataFrame:
    return m.raw("documents").withColumnsRenamed(
        {"uid": "document_uid", "dossier_ref": "dossier_uid"}
    )


@view
def stg_dossier_actes_legislatifs(m: Models) -> DataFrame:
    return m.raw("dossier_actes_legislatifs")


@view
def stg_dossiers_parlementaires(m: Models) -> DataFrame:
    return m.raw("dossiers_parlementaires").withColumnRenamed("uid", "dossier_uid")


def speaker(speeches: DataFrame) -> DataFrame:
    """Speeches with their speaker as a person key."""
    return speeches.withColumn("orateur_id", F.concat(F.lit("PA"), "orateur_id")).withColumnRenamed(
        "orateur_id", "depute_uid"
    )


def sittings(m: Models) -> DataFrame:
    columns = ("compte_rendu_uid", "date_seance", "legislature", "type_assemblee", "session", "num_seance")
    return m.few("sittings", lambda m: m["stg_comptes_rendus"].select(*columns))


@view
def stg_interventions(m: Models) -> DataFrame:
    """Speeches with the date and term of their sitting and the speaker as a person key."""
    return speaker(m.raw("interventions")).join(sittings(m), "compte_rendu_uid", "left")


@view
def stg_mandats(m: Models) -> DataFrame:
    return m.raw("mandats").withColumnsRenamed(
        {"uid": "mandat_uid", "acteur_ref": "depute_uid", "organe_ref": "organe_uid"}
    )


@view
def stg_organes(m: Models) -> DataFrame:
    return m.raw("organes").withColumnRenamed("uid", "organe_uid")


@view
def stg_points_seance(m: Models) -> DataFrame:
    return m.raw("points_seance")


@view
def stg_scrutin_groupes_votes(m: Models) -> DataFrame:
    return m.raw("scrutin_groupes_votes")


@view
def stg_scrutin_votes_individuels(m: Models) -> DataFrame:
    return m.raw("scrutin_votes_individuels").withColumnRenamed("acteur_ref", "depute_uid")


@view
def stg_scrutins(m: Models) -> DataFrame:
    return m.raw("scrutins").withColumnRenamed("uid", "scrutin_uid")
