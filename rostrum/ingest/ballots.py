"""Ballots feed: ballots, the votes of groups, and individual votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.functions.coerce import to_bool_loose, to_date, to_int, to_str
from rostrum.functions.nodes import fields, objects, voters
from rostrum.ingest.parsing import parse_documents
from rostrum.schemas import shape

_TALLY = fields("nonVotants", "pour", "contre", "abstentions", "nonVotantsVolontaires")
_VOTERS_BY_POSITION = fields("pours", "contres", "abstentions", "nonVotants")
_BALLOT = fields(
    *("uid", "numero", "legislature", "organeRef", "sessionRef", "seanceRef", "dateScrutin"),
    *("quantiemeJourSeance", "titre", "modePublicationDesVotes", "lieuVote"),
    ("typeVote", fields("codeTypeVote", "libelleTypeVote", "typeMajorite")),
    ("sort", fields("code", "libelle")),
    ("demandeur", fields("texte", "referenceLegislative")),
    ("objet", fields("libelle", "dossierLegislatif", "referenceLegislative")),
    (
        "syntheseVote",
        fields(
            *("nombreVotants", "suffragesExprimes", "nbrSuffragesRequis", "annonce"),
            ("decompte", _TALLY),
        ),
    ),
    (
        "ventilationVotes",
        fields(("organe", fields("organeRef", ("groupes", fields("groupe"))))),
    ),
    ("miseAuPoint", _VOTERS_BY_POSITION),
)
_GROUP = fields(
    *("organeRef", "nombreMembresGroupe"),
    (
        "vote",
        fields(
            "positionMajoritaire",
            ("decompteVoix", _TALLY),
            ("decompteNominatif", _VOTERS_BY_POSITION),
        ),
    ),
)
_VOTER = fields("acteurRef", "mandatRef", "parDelegation", "numPlace", "causePositionVote")
# Voter container -> position stored with its voters.
_POSITIONS = {
    "pours": "pour",
    "contres": "contre",
    "abstentions": "abstention",
    "nonVotants": "non_votant",
}


def parse_ballots(documents: DataFrame) -> DataFrame:
    """``(uid, doc)``, ballots without a key left out."""
    return (
        parse_documents(documents, "json/", "scrutin", _BALLOT)
        .select(to_str(F.col("doc.uid")).alias("uid"), "doc")
        .where(F.col("uid").isNotNull())
    )


def scrutins(ballots: DataFrame) -> DataFrame:
    s = F.col("doc")
    tally = s.syntheseVote.decompte
    return shape(
        ballots,
        "scrutins",
        numero=to_str(s.numero),
        legislature=to_str(s.legislature),
        organe_ref=to_str(s.organeRef),
        session_ref=to_str(s.sessionRef),
        seance_ref=to_str(s.seanceRef),
        date_scrutin=to_date(s.dateScrutin),
        quantieme_jour_seance=to_int(s.quantiemeJourSeance),
        type_vote_code=to_str(s.typeVote.codeTypeVote),
        type_vote_libelle=to_str(s.typeVote.libelleTypeVote),
        type_majorite=to_str(s.typeVote.typeMajorite),
        sort_code=to_str(s.sort.code),
        sort_libelle=to_str(s.sort.libelle),
        titre=to_str(s.titre),
        demandeur_texte=to_str(s.demandeur.texte),
        demandeur_reference_legislative=to_str(s.demandeur.referenceLegislative),
        objet_libelle=to_str(s.objet.libelle),
        objet_dossier_legislatif=to_str(s.objet.dossierLegislatif),
        objet_reference_legislative=to_str(s.objet.referenceLegislative),
        mode_publication_votes=to_str(s.modePublicationDesVotes),
        lieu_vote=to_str(s.lieuVote),
        synthese_nombre_votants=to_int(s.syntheseVote.nombreVotants),
        synthese_suffrages_exprimes=to_int(s.syntheseVote.suffragesExprimes),
        synthese_nbr_suffrages_requis=to_int(s.syntheseVote.nbrSuffragesRequis),
        synthese_annonce=to_str(s.syntheseVote.annonce),
        synthese_non_votants=to_int(tally.nonVotants),
        synthese_pour=to_int(tally.pour),
        synthese_contre=to_int(tally.contre),
        synthese_abstentions=to_int(tally.abstentions),
        synthese_non_votants_volontaires=to_int(tally.nonVotantsVolontaires),
    )


def _groups() -> Column:
    return objects(F.col("doc.ventilationVotes.organe.groupes.groupe"), _GROUP)


def scrutin_groupes_votes(ballots: DataFrame) -> DataFrame:
    rows = ballots.select(
        F.col("uid").alias("scrutin_uid"),
        to_str(F.col("doc.ventilationVotes.organe.organeRef")).alias("organe_ref_assemblee"),
        F.explode(_groups()).alias("g"),
    )
    g = F.col("g")
    tally = g.vote.decompteVoix
    return shape(
        rows,
        "scrutin_groupes_votes",
        groupe_organe_ref=to_str(g.organeRef),
        nombre_membres_groupe=to_int(g.nombreMembresGroupe),
        position_majoritaire=to_str(g.vote.positionMajoritaire),
        non_votants=to_int(tally.nonVotants),
        pour=to_int(tally.pour),
        contre=to_int(tally.contre),
        abstentions=to_int(tally.abstentions),
        non_votants_volontaires=to_int(tally.nonVotantsVolontaires),
    )


def scrutin_votes_individuels(ballots: DataFrame) -> DataFrame:
    """Voters of the four positions, from the breakdown by group and from the corrections.

    Corrections name no group. A voter without id is ``''``, not NULL.
    """
    by_position = F.struct(
        F.lit(None).cast("string").alias("group"),
        F.lit("mise_au_point").alias("source"),
        F.col("doc.miseAuPoint").alias("voters"),
    )
    groups = F.transform(
        F.coalesce(_groups(), F.array().cast(f"array<{_GROUP.simpleString()}>")),
        lambda g: F.struct(
            to_str(g.organeRef).alias("group"),
            F.lit("ventilation").alias("source"),
            g.vote.decompteNominatif.alias("voters"),
        ),
    )
    origins = ballots.select(
        F.col("uid").alias("scrutin_uid"), F.inline(F.concat(groups, F.array(by_position)))
    )
    containers = origins.select(
        "scrutin_uid",
        F.col("group").alias("groupe_organe_ref"),
        "source",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(position).alias("position_vote"),
                        F.col(f"voters.{container}").alias("container"),
                    )
                    for container, position in _POSITIONS.items()
                ]
            )
        ),
    )
    # Most positions of a group are missing or empty objects; those hold no voter.
    rows = containers.where("container != '{}'").select(
        *("scrutin_uid", "groupe_organe_ref", "source", "position_vote"),
        F.explode(voters(F.col("container"), _VOTER)).alias("v"),
    )
    v = F.col("v")
    return shape(
        rows,
        "scrutin_votes_individuels",
        acteur_ref=F.coalesce(to_str(v.acteurRef), F.lit("")),
        mandat_ref=to_str(v.mandatRef),
        par_delegation=to_bool_loose(v.parDelegation),
        num_place=to_str(v.numPlace),
        cause_position_vote=to_str(v.causePositionVote),
    )
