"""Intermediate views: joins and per-file summaries on top of staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.operators.joins import lookup
from rostrum.plans.registry import Models, view
from rostrum.plans.staging import speaker


@view
def int_depute_mandats(m: Models) -> DataFrame:
    """Mandates with the name of their holder."""
    people = m["stg_deputes"].select("depute_uid", "nom", "prenom", "nom_complet", "trigramme")
    return (
        m["stg_mandats"]
        .join(people, "depute_uid", "left")
        .select(
            *("mandat_uid", "depute_uid", "nom", "prenom", "nom_complet", "trigramme"),
            *("legislature", "type_organe", "organe_uid", "election_departement"),
            *("election_num_departement", "election_num_circo", "date_debut", "date_fin"),
            *("code_qualite", "lib_qualite", "nomin_principale"),
            *("mandature_premiere_election", "mandature_place_hemicycle"),
        )
    )


@view
def int_depute_commissions(m: Models) -> DataFrame:
    """Committee memberships.

    Committees come first, so that mandates in other bodies meet nothing: a single
    body may hold half of all mandates.
    """
    committees = m["stg_commissions"].select(
        "commission_uid",
        F.col("libelle").alias("commission_libelle"),
        F.col("libelle_abrege").alias("commission_libelle_abrege"),
        F.col("code_type").alias("commission_code_type"),
    )
    mandates = m["stg_mandats"].select(
        *("depute_uid", "mandat_uid", "legislature", "date_debut", "date_fin"),
        F.col("organe_uid").alias("commission_uid"),
    )
    people = m["stg_deputes"].select("depute_uid", "nom", "prenom", "nom_complet")
    return (
        mandates.join(m.few("committees", lambda m: committees), "commission_uid")
        .join(people, "depute_uid", "left")
        .select(
            *("depute_uid", "nom", "prenom", "nom_complet", "mandat_uid", "legislature"),
            *("date_debut", "date_fin", "commission_uid", *committees.columns[1:]),
        )
    )


def _mandates_of_type(m: Models, kind: str) -> DataFrame:
    """Mandates in one type of body; ``depute_uid`` only where the person is known.

    Deduplicating the known people keeps the join from multiplying rows that the
    callers would have to remove again.
    """
    known = m["stg_deputes"].select("depute_uid").distinct()
    return (
        m["stg_mandats"]
        .where(F.col("type_organe") == kind)
        .withColumnRenamed("depute_uid", "holder")
        .join(known, F.col("holder") == known["depute_uid"], "left")
    )


@view
def int_depute_dans_partis(m: Models) -> DataFrame:
    bodies = m["stg_organes"].select(
        "organe_uid", F.col("libelle").alias("gp_libelle"), "gp_couleur"
    )
    return (
        _mandates_of_type(m, "GP")
        .select("depute_uid", "organe_uid")
        .distinct()
        .join(bodies, "organe_uid", "left")
        .select("depute_uid", "gp_libelle", "gp_couleur")
        .distinct()
        .orderBy("gp_libelle", "depute_uid", "gp_couleur")  # equal labels spread over tasks
    )


@view
def int_liste_siege(m: Models) -> DataFrame:
    return (
        _mandates_of_type(m, "ASSEMBLEE")
        .select("depute_uid", "mandature_place_hemicycle")
        .distinct()
        .orderBy("mandature_place_hemicycle", "depute_uid")
    )


@view
def int_mandats_actifs(m: Models) -> DataFrame:
    """Districts that are still open."""
    return (
        m["stg_organes"]
        .where(F.col("date_fin").isNull() & (F.col("code_type") == "CIRCONSCRIPTION"))
        .select(
            *("organe_uid", "circo_dep_code", "circo_dep_libelle", "circo_numero"),
            *("circo_region_type", "circo_region_libelle"),
        )
    )


@view
def int_groupes(m: Models) -> DataFrame:
    """Bodies that are political groups by type or label."""
    by_type = F.lower(F.coalesce("code_type", F.lit(""))).isin("gp", "groupepolitique")
    by_label = F.lower(F.coalesce("libelle", F.lit(""))).contains("groupe")
    return (
        m["stg_organes"]
        .where(by_type | by_label)
        .select(
            F.col("organe_uid").alias("groupe_uid"),
            F.col("libelle").alias("groupe_libelle"),
            F.col("libelle_abrev").alias("groupe_libelle_abrev"),
            "gp_position_politique",
            "gp_couleur",
            F.col("legislature").alias("groupe_legislature"),
            F.col("date_debut").alias("groupe_date_debut"),
            F.col("date_fin").alias("groupe_date_fin"),
        )
    )


def _speakers(m: Models) -> DataFrame:
    """The persons who are named as a speaker."""
    named = speaker(m.raw("interventions")).select("depute_uid").distinct()
    people = m["stg_deputes"].select(
        "depute_uid", "nom_complet", "trigramme", "profession_categorie", "profession_famille"
    )
    return people.join(named, "depute_uid", "left_semi")


@view
def int_interventions_enriched(m: Models) -> DataFrame:
    """Speeches with their speaker; an unknown speaker keeps the transcript's name.

    Speakers are few beside their speeches: as long as that holds, no speech moves.
    """
    people = m.few("speakers", _speakers)
    spread_by = ("compte_rendu_uid", "point_id", "intervention_id", "ordre_absolu_seance")
    return lookup(m["stg_interventions"], people, "depute_uid", spread_by).select(
        *("intervention_id", "compte_rendu_uid", "point_id", "point_valeur_ptsodj"),
        *("date_seance", "legislature", "session", "num_seance", "roledebat", "texte"),
        "depute_uid",
        F.coalesce("nom_complet", "orateur_nom").alias("orateur_nom"),
        *("trigramme", "profession_categorie", "profession_famille"),
    )


@view
def int_scrutin_groupes(m: Models) -> DataFrame:
    return m["stg_scrutin_groupes_votes"].withColumnsRenamed(
        {"groupe_organe_ref": "groupe_uid", "organe_ref_assemblee": "assemblee_uid"}
    )


@view
def int_scrutin_groupes_enriched(m: Models) -> DataFrame:
    """Groups with the ballots they took part in; groups without any stay."""
    ballots = m["int_scrutin_groupes"].select("groupe_uid", "scrutin_uid", "position_majoritaire")
    # Broadcast where a reader wants groups with ballots only: groups are too few to join by.
    groups = m.few("groups", lambda m: m["int_groupes"].drop("groupe_libelle_abrev"))
    return groups.join(ballots, "groupe_uid", "left")


def count_where(condition: Column) -> Column:
    """Rows that meet the condition, as a count that is 0 rather than NULL."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _fold_acts(m: Models) -> DataFrame:
    """Acts folded by file and by the ballot they refer to; one row more per file counts its acts.

    Acts are counted apart, so that only file and act move for the distinct count.
    """
    acts = m["stg_dossier_actes_legislatifs"].where(F.col("dossier_uid").isNotNull())
    described = acts.groupBy("dossier_uid", F.col("vote_ref").alias("scrutin_uid")).agg(
        F.count(F.lit(1)).alias("actes"),
        F.min("date_acte").alias("premier"),
        F.max("date_acte").alias("dernier"),
        count_where(F.col("acte_code").startswith("PROM")).alias("promulgations"),
    )
    counts = acts.groupBy("dossier_uid").agg(F.count_distinct("acte_uid").alias("uids"))
    return described.unionByName(counts, allowMissingColumns=True)


def acts_of_files(m: Models) -> DataFrame:
    """As :func:`_fold_acts`, read by several models."""
    return m.shared("acts_of_files", _fold_acts)


@view
def int_dossier_actes(m: Models) -> DataFrame:
    return (
        acts_of_files(m)
        .groupBy("dossier_uid")
        .agg(
            F.min("premier").alias("date_premier_acte"),
            F.max("dernier").alias("date_dernier_acte"),
            F.sum("uids").alias("nombre_actes_total"),
            (F.sum("promulgations") > 0).alias("est_adopte"),
        )
    )


@view
def int_dossier_documents(m: Models) -> DataFrame:
    return (
        m["stg_documents"]
        .where(F.col("dossier_uid").isNotNull())
        .groupBy("dossier_uid")
        .agg(F.count_distinct("document_uid").alias("nombre_documents_total"))
    )


def ballots_of_files(m: Models) -> DataFrame:
    """Distinct ``(dossier_uid, scrutin_uid)`` with ``actes``, the acts that refer to it.

    A file may name a ballot in several acts and its vote totals then count once
    per act. Carrying that number as a weight keeps the following joins small.
    """
    return (
        acts_of_files(m).where(F.col("scrutin_uid").isNotNull()).select("dossier_uid", "scrutin_uid", "actes")
    )


@view
def int_dossier_scrutins(m: Models) -> DataFrame:
    outcome = F.lower("sort_code")
    ballots = m["stg_scrutins"].select(
        "scrutin_uid",
        F.coalesce((outcome == "adopté").cast("long"), F.lit(0)).alias("adopte"),
        F.coalesce((outcome == "rejeté").cast("long"), F.lit(0)).alias("rejete"),
        *("synthese_nombre_votants", "synthese_pour", "synthese_contre", "synthese_abstentions"),
    )

    def weighted(column: str, name: str) -> Column:
        return F.sum(F.col(column) * F.col("actes")).alias(name)

    return (
        ballots_of_files(m)
        .join(ballots, "scrutin_uid")
        .groupBy("dossier_uid")
        .agg(
            F.count_distinct("scrutin_uid").alias("nombre_scrutins_total"),
            weighted("adopte", "nombre_scrutins_adoptes"),
            weighted("rejete", "nombre_scrutins_rejetes"),
            weighted("synthese_nombre_votants", "volume_votants_total"),
            weighted("synthese_pour", "volume_votes_pour"),
            weighted("synthese_contre", "volume_votes_contre"),
            weighted("synthese_abstentions", "volume_votes_abstentions"),
        )
    )


@view
def int_dossier_amendements(m: Models) -> DataFrame:
    """Outcomes are matched with exact case here, unlike those of ballots."""
    return (
        m["stg_amendements"]
        .where(F.col("dossier_legislatif_ref").isNotNull())
        .groupBy(F.col("dossier_legislatif_ref").alias("dossier_uid"))
        .agg(
            F.count_distinct("amendement_uid").alias("nombre_amendements_total"),
            count_where(F.col("sort") == "Adopté").alias("nombre_amendements_adoptes"),
            count_where(F.col("sort").isin("Rejeté", "Tombé")).alias("nombre_amendements_rejetes"),
        )
    )
