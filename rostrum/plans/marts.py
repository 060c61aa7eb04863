"""Marts: the tables dashboards read.

Facts (speeches, mandates, votes) are summarised by their join key before they
meet anything else, so joins run on one row per key and a busy key only costs
its map-side partial aggregate. Marts that use no column of the persons table
read the speeches without it: the join would add nothing to their distinct
counts, minima and maxima.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.functions.coerce import strip
from rostrum.operators.attribution import attribute_by_interval
from rostrum.operators.latest import latest_per_key
from rostrum.operators.repeats import hash_of, repeated_hashes
from rostrum.plans.intermediate import ballots_of_files
from rostrum.plans.registry import Models, table
from rostrum.plans.staging import sittings, speaker


def _or_zero(*names: str) -> list[Column]:
    return [F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names]


# What marts count speeches by.
_TRAITS = ("depute_uid", "date_seance", "legislature", "compte_rendu_uid")


def _one_row(df: DataFrame, key: str, traits: Sequence[str], agree: str) -> DataFrame:
    """A row per ``key``, NULL included: its ``traits``, and whether all its rows ``agree`` in them."""
    found = F.struct(*traits)
    least, greatest = F.min(found).alias("least"), F.max(found).alias("greatest")
    same = F.col("least").eqNullSafe(F.col("greatest"))
    return df.groupBy(key).agg(least, greatest).select(key, "least.*", same.alias(agree))


def _days_of_sittings(m: Models) -> DataFrame:
    return m.few(
        "days of sittings",
        lambda m: _one_row(
            m["stg_comptes_rendus"], "compte_rendu_uid", ("date_seance", "legislature"), "once"
        ),
    )


def _fold_speeches(m: Models) -> DataFrame:
    """Speeches folded by speaker and sitting.

    ``alone`` rows hold the number of ids that have one speaker and one sitting
    and whose sitting has one date and term. All other speeches are the rows
    that are not, one for each distinct id, speaker and sitting. Ids are told
    apart by their hashes; only those that come twice are compared.
    """
    keys = ("depute_uid", "compte_rendu_uid")
    speeches = speaker(m.raw("interventions")).select(
        "intervention_id", *keys, hash_of("intervention_id")
    )
    repeated = m.few("repeated speeches", lambda m: repeated_hashes(speeches))
    again = speeches.join(repeated, "_hash", "left_semi").drop("_hash")
    folded = _one_row(again, "intervention_id", keys, "same")
    ids = folded.where("not same").select(F.col("intervention_id").alias("_id"))
    differing = again.join(ids, F.col("intervention_id").eqNullSafe(F.col("_id")), "left_semi").distinct()
    agreed = (
        speeches.join(repeated, "_hash", "left_anti")
        .drop("_hash")
        .unionByName(folded.where("same").drop("same"))
    )
    unsure = _days_of_sittings(m).where("not once").select("compte_rendu_uid")
    alone = (
        agreed.join(unsure, "compte_rendu_uid", "left_anti")
        .groupBy(*keys)
        .agg(F.count("intervention_id").alias("speeches"))
    )
    others = agreed.join(unsure, "compte_rendu_uid", "left_semi").unionByName(differing)
    return alone.withColumn("alone", F.lit(True)).unionByName(
        others.withColumn("alone", F.lit(False)), allowMissingColumns=True
    )


def _dated_speeches(m: Models) -> DataFrame:
    return m.shared("dated_speeches", _fold_speeches)


def _alone(m: Models) -> DataFrame:
    """Speeches that are alone, one row per speaker and sitting, with their number and traits."""
    speeches = _dated_speeches(m).where("alone")
    return speeches.join(_days_of_sittings(m), "compte_rendu_uid", "left").select(*_TRAITS, "speeches")


def _folded(m: Models, *keys: str) -> DataFrame:
    """Speeches that are alone, folded by ``keys``: their number and first and last day.

    Ids are all different here, so no id has to move for a distinct count.
    """
    return (
        _alone(m)
        .groupBy(*keys)
        .agg(
            F.sum("speeches").alias("speeches"),
            F.min("date_seance").alias("first_day"),
            F.max("date_seance").alias("last_day"),
        )
    )


def _several(m: Models) -> DataFrame:
    """The distinct ``(intervention_id, *traits)`` of speeches that are not alone."""
    rows = _dated_speeches(m).where("not alone").select("intervention_id", "depute_uid", "compte_rendu_uid")
    return (
        rows.join(sittings(m), "compte_rendu_uid", "left").select("intervention_id", *_TRAITS).distinct()
    )


def _speeches_per_person(m: Models) -> DataFrame:
    return m.shared("speeches_per_person", _count_speeches)


def _count_speeches(m: Models) -> DataFrame:
    several = (
        _several(m)
        .groupBy("depute_uid")
        .agg(
            F.count_distinct("intervention_id").alias("speeches"),
            F.min("date_seance").alias("first_day"),
            F.max("date_seance").alias("last_day"),
        )
    )
    return (
        _folded(m, "depute_uid")
        .unionByName(several)
        .where(F.col("depute_uid").isNotNull())
        .groupBy("depute_uid")
        .agg(
            F.sum("speeches").alias("nb_interventions"),
            F.min("first_day").alias("premiere_intervention"),
            F.max("last_day").alias("derniere_intervention"),
        )
    )


@table
def mart_depute_activity(m: Models) -> DataFrame:
    """Per holder of a mandate: mandates, speeches, first and last speech."""
    people = (
        m["stg_deputes"]
        .groupBy("depute_uid")
        .agg(F.max("nom_complet").alias("nom_complet"), F.max("trigramme").alias("trigramme"))
    )
    mandates = (
        m["stg_mandats"]
        .groupBy("depute_uid")
        .agg(F.count_distinct("mandat_uid").alias("nb_mandats"))
    )
    return (
        mandates.join(people, "depute_uid", "left")
        .join(_speeches_per_person(m), "depute_uid", "left")
        .select(
            *("depute_uid", "nom_complet", "trigramme", "nb_mandats"),
            *_or_zero("nb_interventions"),
            *("premiere_intervention", "derniere_intervention"),
        )
    )


def _activity_by_body(m: Models, memberships: DataFrame, body: str) -> DataFrame:
    """Speeches attributed to the bodies their speaker belonged to on the day."""
    attributed = partial(
        attribute_by_interval,
        intervals=memberships,
        key="depute_uid",
        at="date_seance",
        start="date_debut",
        end="date_fin",
        uid="mandat_uid",
        label=body,
    )
    # Speeches that are alone go to the same body if person and day are the same.
    days = _folded(m, "depute_uid", "date_seance").select(
        F.struct("depute_uid", "date_seance").alias("day"), "depute_uid", "date_seance", "speeches"
    )
    alone = attributed(days, event_id="day", carry=("speeches",))
    several = attributed(_several(m), event_id="intervention_id")
    # A speech has one body at most, so counting its id is already distinct.
    counted = several.withColumn("speeches", F.col("intervention_id").isNotNull().cast("long"))
    return alone.drop("day").unionByName(counted.drop("intervention_id")).groupBy(body).agg(
        F.sum("speeches").alias("speeches"),
        F.count_distinct("depute_uid").alias("nb_orateurs"),
        F.min("date_seance").alias("premiere_intervention"),
        F.max("date_seance").alias("derniere_intervention"),
    )


def _members_by_body(memberships: DataFrame, body: str) -> DataFrame:
    return memberships.groupBy(body).agg(
        F.count_distinct("depute_uid").alias("nb_deputes"),
        F.count_distinct("mandat_uid").alias("nb_mandats"),
    )


def _memberships(m: Models, bodies: DataFrame, body: str) -> DataFrame:
    """Mandates held in one of ``bodies``."""
    return (
        m["stg_mandats"]
        .select(
            "mandat_uid", "depute_uid", "date_debut", "date_fin", F.col("organe_uid").alias(body)
        )
        .join(bodies.select(body), body, "left_semi")
    )


@table
def mart_groupe_activity(m: Models) -> DataFrame:
    """Per political group: members and the speeches of its members while they belonged to it."""
    groups = (
        m["int_groupes"]
        .select(
            *("groupe_uid", "groupe_libelle", "gp_position_politique", "gp_couleur"),
            "groupe_legislature",
        )
        .distinct()
    )
    memberships = _memberships(m, groups, "groupe_uid")
    return (
        groups.join(_members_by_body(memberships, "groupe_uid"), "groupe_uid", "left")
        .join(_activity_by_body(m, memberships, "groupe_uid"), "groupe_uid", "left")
        .withColumnRenamed("speeches", "nb_interventions")
        .select(
            *groups.columns,
            *_or_zero("nb_deputes", "nb_mandats", "nb_interventions", "nb_orateurs"),
            *("premiere_intervention", "derniere_intervention"),
        )
    )


@table
def mart_commission_activity(m: Models) -> DataFrame:
    """Per committee with members: the same as for groups."""
    committees = (
        m["stg_commissions"]
        .groupBy("commission_uid")
        .agg(
            F.max("libelle").alias("commission_libelle"),
            F.max("libelle_abrege").alias("commission_libelle_abrege"),
            F.max("code_type").alias("commission_code_type"),
        )
    )
    memberships = _memberships(m, committees, "commission_uid")
    return (
        committees.join(_members_by_body(memberships, "commission_uid"), "commission_uid")
        .join(_activity_by_body(m, memberships, "commission_uid"), "commission_uid", "left")
        .withColumnRenamed("speeches", "nb_interventions_des_membres")
        .select(
            *committees.columns,
            *("nb_deputes", "nb_mandats"),
            *_or_zero("nb_interventions_des_membres", "nb_orateurs"),
            *("premiere_intervention", "derniere_intervention"),
        )
    )


@table
def mart_interventions_time(m: Models) -> DataFrame:
    """Per sitting date and term: speeches, speakers and transcripts."""
    days = ("date_seance", "legislature")
    several = _several(m).where(F.col("date_seance").isNotNull())
    ids = several.groupBy(*days).agg(F.count_distinct("intervention_id").alias("speeches"))
    alone = _alone(m).where(F.col("date_seance").isNotNull())
    traits = several.select(*_TRAITS, F.lit(0).cast("long").alias("speeches"))
    none = F.lit(None).cast("string")
    counted = ids.select(none.alias("depute_uid"), *days, none.alias("compte_rendu_uid"), "speeches")
    return (
        alone.unionByName(traits)
        .unionByName(counted)
        .groupBy(*days)
        .agg(
            F.sum("speeches").alias("nb_interventions"),
            F.count_distinct("depute_uid").alias("nb_orateurs"),
            F.count_distinct("compte_rendu_uid").alias("nb_comptes_rendus"),
        )
    )


@table
def mart_interventions_enriched(m: Models) -> DataFrame:
    return m["int_interventions_enriched"].select(
        *("intervention_id", "compte_rendu_uid", "point_id", "point_valeur_ptsodj"),
        *("date_seance", "legislature", "session", "num_seance", "roledebat", "depute_uid"),
        *("orateur_nom", "trigramme", "profession_categorie", "profession_famille", "texte"),
    )


def _latest_mandate_order() -> list[Column]:
    """Latest end first, open-ended before all, then latest start, then greatest id.

    An ended mandate always comes after one that still runs, whatever day it is.
    """
    return [
        F.coalesce("date_fin", F.lit("9999-12-31").cast("date")),
        F.coalesce("date_debut", F.lit("1900-01-01").cast("date")),
        F.col("mandat_uid"),
    ]


def _people_with_district(m: Models) -> DataFrame:
    """One row per person elected in a district: their latest such mandate."""
    people = latest_per_key(
        m["stg_deputes"], "depute_uid", [F.col("nom_complet")], ["nom_complet", "trigramme"]
    )
    elected = m["stg_mandats"].where(
        F.col("election_num_departement").isNotNull() & F.col("election_num_circo").isNotNull()
    )
    current = latest_per_key(
        elected,
        "depute_uid",
        _latest_mandate_order(),
        [
            *("mandat_uid", "legislature", "date_debut", "date_fin", "election_departement"),
            *("election_num_departement", "election_num_circo"),
        ],
    )
    return (
        current.join(people, "depute_uid", "left")
        .withColumn("departement_code", F.upper(strip(F.col("election_num_departement"))))
        .withColumn("circonscription_numero", F.lpad(strip(F.col("election_num_circo")), 2, "0"))
        .withColumn(
            "circonscription_code",
            F.concat("departement_code", F.lit("-"), "circonscription_numero"),
        )
        .drop("election_num_departement", "election_num_circo")
    )


def _list(column: str) -> Column:
    """The values of a group in order, joined by a comma; NULL when there is none."""
    return F.expr(f"listagg({column}, ', ') within group (order by {column})")


def _distinct_list(column: str) -> Column:
    """As :func:`_list` over distinct values.

    Sets fold duplicates in the map tasks and need no row expansion, which
    several DISTINCT aggregates side by side would.
    """
    found = F.sort_array(F.collect_set(column))
    return F.when(F.size(found) > 0, F.array_join(found, ", "))


@table
def mart_deputes_circonscriptions(m: Models) -> DataFrame:
    """Per person: current district, own speeches, and the totals of that district."""
    speeches = _speeches_per_person(m).withColumnsRenamed(
        {
            "nb_interventions": "nb_interventions_depute",
            "premiere_intervention": "premiere_intervention_depute",
            "derniere_intervention": "derniere_intervention_depute",
        }
    )
    people = (
        _people_with_district(m)
        .join(speeches, "depute_uid", "left")
        .withColumns({"nb_interventions_depute": _or_zero("nb_interventions_depute")[0]})
    )
    districts = people.groupBy("circonscription_code").agg(
        # people holds each person once, so the plain count is the distinct one
        F.count("depute_uid").alias("nb_deputes"),
        F.count_distinct("mandat_uid").alias("nb_mandats"),
        F.sum("nb_interventions_depute").alias("nb_interventions"),
        F.min("premiere_intervention_depute").alias("premiere_intervention"),
        F.max("derniere_intervention_depute").alias("derniere_intervention"),
        _list("nom_complet").alias("deputes"),
    )
    return people.join(districts, "circonscription_code", "left").select(
        *("depute_uid", "nom_complet", "trigramme", "legislature", "mandat_uid", "date_debut"),
        *("date_fin", "election_departement", "departement_code", "circonscription_numero"),
        *("circonscription_code", "nb_interventions_depute", "premiere_intervention_depute"),
        *("derniere_intervention_depute", "nb_deputes", "nb_mandats", "nb_interventions"),
        *("premiere_intervention", "derniere_intervention", "deputes"),
    )


@table
def mart_circonscription_activity(m: Models) -> DataFrame:
    """Per district: people, speeches, and the groups, positions and colours of its people."""
    groups = m["int_groupes"].select(
        "groupe_uid", "groupe_libelle", "gp_position_politique", "gp_couleur"
    )
    in_group = m["stg_mandats"].select(
        *("mandat_uid", "depute_uid", "date_debut", "date_fin"),
        F.col("organe_uid").alias("groupe_uid"),
    )
    affiliation = latest_per_key(
        in_group.join(groups, "groupe_uid"),
        "depute_uid",
        [*_latest_mandate_order(), F.col("groupe_uid")],
        ["groupe_libelle", "gp_position_politique", "gp_couleur"],
    )
    people = (
        _people_with_district(m)
        .join(_speeches_per_person(m), "depute_uid", "left")
        .join(affiliation, "depute_uid", "left")
    )
    keys = ("circonscription_code", "departement_code", "circonscription_numero")
    return (
        people.groupBy(*keys)
        .agg(
            F.max("election_departement").alias("election_departement"),
            F.max("legislature").alias("legislature"),
            F.count("depute_uid").alias("nb_deputes"),
            F.count_distinct("mandat_uid").alias("nb_mandats"),
            F.coalesce(F.sum("nb_interventions"), F.lit(0)).alias("nb_interventions"),
            F.min("premiere_intervention").alias("premiere_intervention"),
            F.max("derniere_intervention").alias("derniere_intervention"),
            _distinct_list("groupe_libelle").alias("groupes_politiques"),
            _distinct_list("gp_position_politique").alias("positionnements_politiques"),
            _distinct_list("gp_couleur").alias("couleurs_groupes"),
            _distinct_list("nom_complet").alias("deputes"),
        )
        .withColumn(
            "circonscription_code_nodash",
            F.concat("departement_code", "circonscription_numero"),
        )
        .select(
            *("circonscription_code", "circonscription_code_nodash", "departement_code"),
            *("circonscription_numero", "election_departement", "legislature", "nb_deputes"),
            *("nb_mandats", "nb_interventions", "premiere_intervention", "derniere_intervention"),
            *("groupes_politiques", "positionnements_politiques", "couleurs_groupes", "deputes"),
        )
    )


@table
def mart_depute_place_hemicycle(m: Models) -> DataFrame:
    """Person by seat by group. Each input is distinct, hence so is the join."""
    people = m["stg_deputes"].select("depute_uid", "nom", "prenom").distinct()
    return (
        m["int_depute_dans_partis"]
        .join(m["int_liste_siege"], "depute_uid", "left")
        .join(people, "depute_uid", "left")
        .select(
            *("depute_uid", "nom", "prenom", "mandature_place_hemicycle"),
            *("gp_libelle", "gp_couleur"),
        )
        .orderBy("mandature_place_hemicycle", "depute_uid", "gp_libelle", "gp_couleur")
    )


@table
def mart_dossiers_enriched(m: Models) -> DataFrame:
    """Per file: its acts, documents, ballots and amendments in one row."""
    joined = m["stg_dossiers_parlementaires"].drop("nombre_actes_legislatifs")
    described = joined.columns
    for summary in ("actes", "documents", "scrutins", "amendements"):
        joined = joined.join(m[f"int_dossier_{summary}"], "dossier_uid", "left")
    return joined.select(
        *described,
        *("date_premier_acte", "date_dernier_acte"),
        *_or_zero("nombre_actes_total"),
        F.coalesce("est_adopte", F.lit(False)).alias("est_adopte"),
        *_or_zero(
            *("nombre_documents_total", "nombre_scrutins_total", "nombre_scrutins_adoptes"),
            *("nombre_scrutins_rejetes", "volume_votants_total", "volume_votes_pour"),
            *("volume_votes_contre", "volume_votes_abstentions", "nombre_amendements_total"),
            *("nombre_amendements_adoptes", "nombre_amendements_rejetes"),
        ),
    )


@table
def mart_dossiers_votes_groupes(m: Models) -> DataFrame:
    """Per file, group and assembly: group votes, once per act that refers to the ballot."""
    votes = (
        m["stg_scrutin_groupes_votes"]
        .select(
            *("scrutin_uid", "groupe_organe_ref", "organe_ref_assemblee"),
            *("pour", "contre", "abstentions"),
        )
        .repartition("scrutin_uid")  # for the fold and the join
        .groupBy("scrutin_uid", "groupe_organe_ref", "organe_ref_assemblee")
        .agg(
            F.count(F.lit(1)).alias("lignes"),
            *[F.sum(c).alias(c) for c in ("pour", "contre", "abstentions")],
        )
    )

    def weighted(column: str) -> Column:
        return F.sum(F.col(column) * F.col("actes"))

    totals = (
        ballots_of_files(m)
        .join(votes, "scrutin_uid")
        .groupBy("dossier_uid", "groupe_organe_ref", "organe_ref_assemblee")
        .agg(
            weighted("lignes").alias("total_scrutins_participes"),
            weighted("pour").alias("volume_total_pour"),
            weighted("contre").alias("volume_total_contre"),
            weighted("abstentions").alias("volume_total_abstention"),
        )
    )
    adopted = m["int_dossier_actes"].select("dossier_uid", "est_adopte")
    files = m["stg_dossiers_parlementaires"].select("dossier_uid", "titre_dossier", "legislature")
    groups = m["stg_organes"].select(
        F.col("organe_uid").alias("groupe_organe_ref"),
        F.col("libelle").alias("groupe_libelle"),
        F.col("libelle_abrege").alias("groupe_libelle_abrege"),
    )
    return (
        totals.join(files, "dossier_uid")
        .join(adopted, "dossier_uid", "left")
        .join(groups, "groupe_organe_ref", "left")
        .select(
            *("dossier_uid", "titre_dossier", "legislature"),
            F.coalesce("est_adopte", F.lit(False)).alias("est_adopte"),
            *("groupe_organe_ref", "groupe_libelle", "groupe_libelle_abrege"),
            *("organe_ref_assemblee", "total_scrutins_participes"),
            *_or_zero("volume_total_pour", "volume_total_contre", "volume_total_abstention"),
        )
    )


@table
def mart_groupes_co_vote(m: Models) -> DataFrame:
    """Per pair of groups: ballots in which both had the same majority position.

    Repeated rows of a group in a ballot are folded into a weight first. The
    groups of a position then make one list, equal lists are folded into a weight
    too, and each pair of a list is made once, without a join.
    """
    stands = (
        m["int_scrutin_groupes_enriched"]
        .where(F.col("scrutin_uid").isNotNull() & F.col("position_majoritaire").isNotNull())
        .select("scrutin_uid", "position_majoritaire", "groupe_uid")
        .repartition("scrutin_uid", "position_majoritaire")  # for the fold and the lists
        .groupBy("scrutin_uid", "position_majoritaire", "groupe_uid")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    lists = (
        stands.groupBy("scrutin_uid", "position_majoritaire")
        .agg(F.sort_array(F.collect_list(F.struct("groupe_uid", "n"))).alias("together"))
        .groupBy("together")
        .agg(F.count(F.lit(1)).alias("ballots"))
    )
    return (
        lists.withColumn("first", F.explode("together"))
        .withColumn("second", F.explode("together"))
        .where(F.col("first.groupe_uid") < F.col("second.groupe_uid"))
        .groupBy(
            F.col("first.groupe_uid").alias("groupe_uid_1"), F.col("second.groupe_uid").alias("groupe_uid_2")
        )
        .agg(F.sum(F.col("first.n") * F.col("second.n") * F.col("ballots")).alias("nb_co_votes"))
        .select("nb_co_votes", "groupe_uid_1", "groupe_uid_2")
        .orderBy(F.desc("nb_co_votes"))
    )
