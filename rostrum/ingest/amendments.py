"""Amendments feed: amendments, their authors and their co-signers.

Unlike the other feeds it leaves out documents that are not JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.functions.coerce import to_date, to_str
from rostrum.functions.nodes import fields, values
from rostrum.ingest.parsing import parse_documents
from rostrum.schemas import shape
from rostrum.sources.archive import folder_key

_CODED = fields("code", "libelle")
_AMENDMENT = fields(
    *("uid", "legislature", "examenRef", "texteLegislatifRef"),
    ("identification", fields("numeroLong", "numeroOrdreDepot", "prefixeOrganeExamen")),
    (
        "pointeurFragmentTexte",
        fields(("division", fields("titre", "articleDesignationCourte", "type"))),
    ),
    ("corps", fields(("contenuAuteur", fields("dispositif", "exposeSommaire")))),
    (
        "cycleDeVie",
        fields(
            *("dateDepot", "datePublication", "sort"),
            ("etatDesTraitements", fields(("etat", _CODED), ("sousEtat", _CODED))),
        ),
    ),
    (
        "signataires",
        fields(
            ("auteur", fields("typeAuteur", "acteurRef", "groupePolitiqueRef")),
            ("cosignataires", fields("acteurRef")),
        ),
    ),
)


def parse_amendments(documents: DataFrame) -> DataFrame:
    """``(uid, dossier, doc)``, amendments without a key left out."""
    return (
        parse_documents(documents, "", "amendement", _AMENDMENT, bad_json="skip")
        .select(
            to_str(F.col("doc.uid")).alias("uid"),
            to_str(folder_key(F.col("entry"))).alias("dossier"),
            "doc",
        )
        .where(F.col("uid").isNotNull())
    )


def amendements(amendments: DataFrame) -> DataFrame:
    a = F.col("doc")
    division, states = a.pointeurFragmentTexte.division, a.cycleDeVie.etatDesTraitements
    author = a.signataires.auteur
    return shape(
        amendments,
        "amendements",
        legislature=to_str(a.legislature),
        numero_long=to_str(a.identification.numeroLong),
        numero_ordre_depot=to_str(a.identification.numeroOrdreDepot),
        prefixe_organe_examen=to_str(a.identification.prefixeOrganeExamen),
        examen_ref=to_str(a.examenRef),
        texte_legislatif_ref=to_str(a.texteLegislatifRef),
        division_titre=to_str(division.titre),
        article_designation_courte=to_str(division.articleDesignationCourte),
        division_type=to_str(division.type),
        dispositif=to_str(a.corps.contenuAuteur.dispositif),
        expose_sommaire=to_str(a.corps.contenuAuteur.exposeSommaire),
        date_depot=to_date(a.cycleDeVie.dateDepot),
        date_publication=to_date(a.cycleDeVie.datePublication),
        etat_code=to_str(states.etat.code),
        etat_libelle=to_str(states.etat.libelle),
        sous_etat_code=to_str(states.sousEtat.code),
        sous_etat_libelle=to_str(states.sousEtat.libelle),
        sort=to_str(a.cycleDeVie.sort),
        auteur_type=to_str(author.typeAuteur),
        auteur_acteur_ref=to_str(author.acteurRef),
        auteur_groupe_politique_ref=to_str(author.groupePolitiqueRef),
        dossier_legislatif_ref=F.col("dossier"),
    )


def amendement_signataires(amendments: DataFrame) -> DataFrame:
    """The author, at position 0, of amendments that name one."""
    author = F.col("doc.signataires.auteur")
    return shape(
        amendments,
        "amendement_signataires",
        amendement_uid=F.col("uid"),
        acteur_ref=to_str(author.acteurRef),
        type_auteur=to_str(author.typeAuteur),
        groupe_politique_ref=to_str(author.groupePolitiqueRef),
        ordre_presentation=F.lit(0),
    ).where(F.col("acteur_ref").isNotNull())


def amendement_cosignataires(amendments: DataFrame) -> DataFrame:
    """Co-signers numbered from 1; an empty place is left out but keeps its number."""
    places = amendments.select(
        F.col("uid").alias("amendement_uid"),
        F.posexplode(values(F.col("doc.signataires.cosignataires.acteurRef"))).alias("n", "ref"),
    )
    return shape(
        places,
        "amendement_cosignataires",
        cosignataire_acteur_ref=to_str(F.col("ref")),
        ordre_presentation=F.col("n") + 1,
    ).where(F.col("cosignataire_acteur_ref").isNotNull())
