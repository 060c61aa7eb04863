"""Deputies feed: persons with their addresses and mandates, bodies, recusals."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.functions.coerce import ingested_at, to_bool, to_date, to_int, to_str, to_ts
from rostrum.functions.nodes import fields, objects, organe_refs
from rostrum.ingest.parsing import parse_documents
from rostrum.schemas import shape

_PERSON = fields(
    "uid",
    "uri_hatvp",
    (
        "etatCivil",
        fields(
            ("ident", fields("civ", "prenom", "nom", "alpha", "trigramme")),
            ("infoNaissance", fields("dateNais", "villeNais", "depNais", "paysNais")),
        ),
    ),
    (
        "profession",
        fields("libelleCourant", ("socProcINSEE", fields("catSocPro", "famSocPro"))),
    ),
    ("adresses", fields("adresse")),
    ("mandats", fields("mandat")),
)
_ADDRESS = fields(
    *("uid", "type", "typeLibelle", "@xsi:type", "intitule", "numeroRue", "nomRue"),
    *("complementAdresse", "codePostal", "ville", "valElec"),
)
_MANDATE = fields(
    *("uid", "@xsi:type", "legislature", "typeOrgane", "organes", "dateDebut", "dateFin"),
    *("datePublication", "preseance", "nominPrincipale"),
    ("infosQualite", fields("codeQualite", "libQualite")),
    (
        "election",
        fields("causeMandat", ("lieu", fields("departement", "numDepartement", "numCirco"))),
    ),
    (
        "mandature",
        fields("datePriseFonction", "causeFin", "premiereElection", "placeHemicycle"),
    ),
)
_BODY = fields(
    *("uid", "@xsi:type", "codeType", "libelle", "libelleAbrege", "libelleAbrev", "regime"),
    *("legislature", "numero", "couleurAssociee", "preseance", "positionPolitique"),
    ("viMoDe", fields("dateDebut", "dateFin")),
    (
        "lieu",
        fields(
            ("region", fields("type", "libelle")), ("departement", fields("code", "libelle"))
        ),
    ),
)
_RECUSAL = fields(
    *("uid", "legislature", "refActeur", "dateCreation", "datePublication"),
    ("portee", fields("code", "libelle")),
    ("lecture", fields("code")),
    ("instance", fields("code")),
    ("cible", fields("referenceTextuelle", ("type", fields("code")))),
)


def parse_persons(documents: DataFrame) -> DataFrame:
    """``(uid, doc)``; the key is text or an object with ``#text``, taken as it is."""
    parsed = parse_documents(documents, "json/acteur/", "acteur", _PERSON, no_root="fail")
    written = F.col("doc.uid")
    uid = F.when(
        written.startswith("{"), F.get_json_object(written, "$['#text']")
    ).otherwise(written)
    missing = F.raise_error(F.concat(F.lit("no uid in "), "entry")).cast("string")
    return parsed.select(F.coalesce(uid, missing).alias("uid"), "doc")


def parse_bodies(documents: DataFrame) -> DataFrame:
    return parse_documents(documents, "json/organe/", "organe", _BODY, no_root="fail")


def parse_recusals(documents: DataFrame) -> DataFrame:
    return parse_documents(documents, "json/deport/", "deport", _RECUSAL, no_root="fail")


def acteurs(persons: DataFrame, run_time: datetime) -> DataFrame:
    ident, birth = F.col("doc.etatCivil.ident"), F.col("doc.etatCivil.infoNaissance")
    job = F.col("doc.profession")
    return shape(
        persons,
        "acteurs",
        civilite=to_str(ident.civ),
        prenom=to_str(ident.prenom),
        nom=to_str(ident.nom),
        alpha=to_str(ident.alpha),
        trigramme=to_str(ident.trigramme),
        date_naissance=to_date(birth.dateNais),
        ville_naissance=to_str(birth.villeNais),
        departement_naissance=to_str(birth.depNais),
        pays_naissance=to_str(birth.paysNais),
        profession_libelle=to_str(job.libelleCourant),
        profession_categorie=to_str(job.socProcINSEE.catSocPro),
        profession_famille=to_str(job.socProcINSEE.famSocPro),
        uri_hatvp=to_str(F.col("doc.uri_hatvp")),
        ingested_at=ingested_at(run_time),
    )


def adresses(persons: DataFrame, run_time: datetime) -> DataFrame:
    rows = persons.select(
        F.col("uid").alias("acteur_uid"),
        F.explode(objects(F.col("doc.adresses.adresse"), _ADDRESS)).alias("a"),
    )
    a = F.col("a")
    return shape(
        rows,
        "adresses",
        uid=to_str(a.uid),
        type_code=to_str(a.type),
        type_libelle=to_str(a.typeLibelle),
        xsi_type=to_str(a["@xsi:type"]),
        intitule=to_str(a.intitule),
        numero_rue=to_str(a.numeroRue),
        nom_rue=to_str(a.nomRue),
        complement=to_str(a.complementAdresse),
        code_postal=to_str(a.codePostal),
        ville=to_str(a.ville),
        val_elec=to_str(a.valElec),
        ingested_at=ingested_at(run_time),
    )


def mandats(persons: DataFrame, run_time: datetime) -> DataFrame:
    """One row per mandate and body; a mandate without body keeps a row."""
    held = persons.select(
        F.col("uid").alias("acteur_ref"),
        F.explode(objects(F.col("doc.mandats.mandat"), _MANDATE)).alias("m"),
    )
    rows = held.select(
        "acteur_ref", "m", F.explode_outer(organe_refs(F.col("m.organes"))).alias("organe_ref")
    )
    m = F.col("m")
    elected = m["@xsi:type"] == "MandatParlementaire_type"

    def if_elected(value: Column) -> Column:
        return F.when(elected, value)

    return shape(
        rows,
        "mandats",
        uid=to_str(m.uid),
        xsi_type=to_str(m["@xsi:type"]),
        legislature=to_str(m.legislature),
        type_organe=to_str(m.typeOrgane),
        date_debut=to_date(m.dateDebut),
        date_fin=to_date(m.dateFin),
        date_publication=to_date(m.datePublication),
        preseance=to_int(m.preseance),
        nomin_principale=to_bool(m.nominPrincipale),
        code_qualite=to_str(m.infosQualite.codeQualite),
        lib_qualite=to_str(m.infosQualite.libQualite),
        election_departement=if_elected(to_str(m.election.lieu.departement)),
        election_num_departement=if_elected(to_str(m.election.lieu.numDepartement)),
        election_num_circo=if_elected(to_str(m.election.lieu.numCirco)),
        election_cause_mandat=if_elected(to_str(m.election.causeMandat)),
        mandature_date_prise_fonction=if_elected(to_date(m.mandature.datePriseFonction)),
        mandature_cause_fin=if_elected(to_str(m.mandature.causeFin)),
        mandature_premiere_election=if_elected(to_bool(m.mandature.premiereElection)),
        mandature_place_hemicycle=if_elected(to_int(m.mandature.placeHemicycle)),
        ingested_at=ingested_at(run_time),
    )


def organes(bodies: DataFrame, run_time: datetime) -> DataFrame:
    o = F.col("doc")
    return shape(
        bodies,
        "organes",
        uid=to_str(o.uid),
        xsi_type=to_str(o["@xsi:type"]),
        code_type=to_str(o.codeType),
        libelle=to_str(o.libelle),
        libelle_abrege=to_str(o.libelleAbrege),
        libelle_abrev=to_str(o.libelleAbrev),
        regime=to_str(o.regime),
        legislature=to_str(o.legislature),
        date_debut=to_date(o.viMoDe.dateDebut),
        date_fin=to_date(o.viMoDe.dateFin),
        circo_numero=to_str(o.numero),
        circo_region_type=to_str(o.lieu.region.type),
        circo_region_libelle=to_str(o.lieu.region.libelle),
        circo_dep_code=to_str(o.lieu.departement.code),
        circo_dep_libelle=to_str(o.lieu.departement.libelle),
        gp_couleur=to_str(o.couleurAssociee),
        gp_preseance=to_int(o.preseance),
        gp_position_politique=to_str(o.positionPolitique),
        ingested_at=ingested_at(run_time),
    )


def deports(recusals: DataFrame, run_time: datetime) -> DataFrame:
    d = F.col("doc")
    return shape(
        recusals,
        "deports",
        uid=to_str(d.uid),
        legislature=to_str(d.legislature),
        acteur_ref=to_str(d.refActeur),
        date_creation=to_ts(d.dateCreation),
        date_publication=to_ts(d.datePublication),
        portee_code=to_str(d.portee.code),
        portee_libelle=to_str(d.portee.libelle),
        lecture_code=to_str(d.lecture.code),
        instance_code=to_str(d.instance.code),
        cible_type_code=to_str(d.cible.type.code),
        cible_reference_textuelle=to_str(d.cible.referenceTextuelle),
        ingested_at=ingested_at(run_time),
    )
