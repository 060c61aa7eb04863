"""Source documents built by Spark from the adapter's raw rows, and what parsing must give back.

Each builder returns documents ``(entry, body)``, one per row or ballot, in the
varied shapes the feeds use: one object or a list, padded text, decoy members,
missing nodes. ``SQL`` holds what the ingest job must make of them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.adapter import RUN_TIME, bench_table, raw_table
from rostrum.ingest import INGEST
from rostrum.schemas import FEEDS

_RUN = datetime.fromisoformat(RUN_TIME)


def _struct(nodes: dict) -> Column:
    built = []
    for key, value in nodes.items():
        value = _struct(value) if isinstance(value, dict) else value
        value = F.lit(value) if isinstance(value, str) else value
        built.append(value.alias(key))
    return F.struct(*built)


def _json(nodes: dict, nulls: bool = False) -> Column:
    return F.to_json(_struct(nodes), {"ignoreNullFields": str(not nulls).lower()})


def _with(json: Column, **raw: Column) -> Column:
    """A JSON object with more members, given as JSON text (NULL adds nothing)."""
    inner = F.expr("''")
    for key, text in raw.items():
        inner = F.concat(inner, F.coalesce(F.concat(F.lit(f',"{key}":'), text), F.lit("")))
    return F.concat(F.lit('{"_":0'), inner, _tail(json))


def _tail(json: Column) -> Column:
    rest = json.substr(F.lit(2), F.length(json))
    return F.when(json == "{}", rest).otherwise(F.concat(F.lit(","), rest))


def _wrap(key: str, text: Column) -> Column:
    return F.concat(F.lit('{"' + key + '":'), text, F.lit("}"))


def _list(*texts: Column | str) -> Column:
    parts = [F.lit(t) if isinstance(t, str) else t for t in texts]
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))


def _one_or_list(text: Column, by: Column) -> Column:
    """The node by itself, in a list, or in a list among members that are not objects."""
    k = F.pmod(F.xxhash64(by), F.lit(3))
    return (
        F.when(k == 0, text)
        .when(k == 1, _list(text))
        .otherwise(_list('"decoy"', text, "null", "7", '["decoy"]'))
    )


def _pad(column: str) -> Column:
    return F.concat(F.lit(" \t"), F.col(column), F.lit("\n "))


def _entry(folder: str, key: Column) -> Column:
    return F.concat(F.lit(f"json/{folder}"), key, F.lit(".json")).alias("entry")


def _acteurs(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    as_object = _json({"@xsi:type": "IdActeur_type", "#text": c("uid")})
    as_text = F.concat(F.lit('"'), c("uid"), F.lit('"'))
    even = F.pmod(F.xxhash64("uid"), F.lit(2)) == 0
    person = _json(
        {
            "etatCivil": {
                "ident": {
                    "civ": c("civilite"),
                    "prenom": _pad("prenom"),
                    "nom": _pad("nom"),
                    "alpha": c("alpha"),
                    "trigramme": c("trigramme"),
                },
                "infoNaissance": {
                    "dateNais": F.concat(c("date_naissance").cast("string"), F.lit("T00:00:00")),
                    "villeNais": c("ville_naissance"),
                    "depNais": c("departement_naissance"),
                    "paysNais": F.coalesce(c("pays_naissance"), F.lit("   ")),
                },
            },
            "profession": {
                "libelleCourant": c("profession_libelle"),
                "socProcINSEE": {
                    "catSocPro": c("profession_categorie"),
                    "famSocPro": c("profession_famille"),
                },
            },
            "uri_hatvp": c("uri_hatvp"),
        },
        nulls=True,
    )
    body = _wrap("acteur", _with(person, uid=F.when(even, as_object).otherwise(as_text)))
    return raw_table(spark, sf, "acteurs").select(_entry("acteur/", c("uid")), body.alias("body"))


def _person_with(folder_key: str, node: Column) -> Column:
    holder = _json({"uid": F.col(folder_key)})
    return _wrap("acteur", _with(holder, **{"adresses": node}))


def _adresses(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    address = _json(
        {
            "uid": c("uid"),
            "type": c("type_code"),
            "typeLibelle": c("type_libelle"),
            "@xsi:type": c("xsi_type"),
            "intitule": _pad("intitule"),
            "numeroRue": c("numero_rue"),
            "nomRue": c("nom_rue"),
            "complementAdresse": c("complement"),
            "codePostal": c("code_postal"),
            "ville": c("ville"),
            "valElec": c("val_elec"),
        }
    )
    body = _person_with("acteur_uid", _wrap("adresse", _one_or_list(address, c("uid"))))
    return raw_table(spark, sf, "adresses").select(_entry("acteur/", c("uid")), body.alias("body"))


def _mandats(spark: SparkSession, sf: str) -> DataFrame:
    """Three bodies where ``preseance`` is 5, no body node where it is 6, else one."""
    c = F.col
    elected = c("xsi_type") == "MandatParlementaire_type"

    def decoy(column: str) -> Column:
        return F.when(elected, c(column).cast("string")).otherwise("1")

    def bit(column: str) -> Column:
        return F.when(c(column), "1").when(~c(column), "0")

    mandate = _json(
        {
            "uid": c("uid"),
            "@xsi:type": c("xsi_type"),
            "legislature": c("legislature"),
            "typeOrgane": c("type_organe"),
            "dateDebut": c("date_debut").cast("string"),
            "dateFin": F.date_format("date_fin", "yyyyMMdd"),
            "datePublication": c("date_publication").cast("string"),
            "preseance": c("preseance"),
            "nominPrincipale": bit("nomin_principale"),
            "infosQualite": {"codeQualite": c("code_qualite"), "libQualite": c("lib_qualite")},
            "election": {
                "lieu": {
                    "departement": decoy("election_departement"),
                    "numDepartement": decoy("election_num_departement"),
                    "numCirco": decoy("election_num_circo"),
                },
                "causeMandat": decoy("election_cause_mandat"),
            },
            "mandature": {
                "datePriseFonction": decoy("mandature_date_prise_fonction"),
                "premiereElection": F.when(
                    elected, bit("mandature_premiere_election")
                ).otherwise("1"),
                "placeHemicycle": decoy("mandature_place_hemicycle"),
            },
        }
    )
    quoted = F.concat(F.lit('"'), c("organe_ref"), F.lit('"'))
    refs = (
        F.when(c("preseance") == 5, _list(quoted, '"PX1"', '"PX2"'))
        .when(c("preseance") == 4, _list(quoted))
        .otherwise(quoted)
    )
    bodies = F.when(c("preseance") != 6, _wrap("organeRef", refs))
    node = _wrap("mandat", _one_or_list(_with(mandate, organes=bodies), c("uid")))
    body = _wrap("acteur", _with(_json({"uid": c("acteur_ref")}), mandats=node))
    return raw_table(spark, sf, "mandats").select(_entry("acteur/", c("uid")), body.alias("body"))


def _organes(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    body = _json(
        {
            "organe": {
                "uid": _pad("uid"),
                "@xsi:type": c("xsi_type"),
                "codeType": c("code_type"),
                "libelle": c("libelle"),
                "libelleAbrege": c("libelle_abrege"),
                "libelleAbrev": c("libelle_abrev"),
                "legislature": c("legislature"),
                "viMoDe": {
                    "dateDebut": c("date_debut").cast("string"),
                    "dateFin": c("date_fin").cast("string"),
                },
                "lieu": {
                    "departement": {"code": c("circo_dep_code"), "libelle": c("circo_dep_libelle")}
                },
                "numero": c("circo_numero"),
                "couleurAssociee": c("gp_couleur"),
                "preseance": c("gp_preseance"),
                "positionPolitique": c("gp_position_politique"),
            }
        },
        nulls=True,
    )
    return raw_table(spark, sf, "organes").select(_entry("organe/", c("uid")), body.alias("body"))


def _stamp(column: str) -> Column:
    """A UTC instant written with ``Z``, with an offset, or without zone."""
    k = F.pmod(F.xxhash64(column), F.lit(3))
    instant = F.col(column)
    plain = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")
    shifted = F.date_format(instant + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss")
    return (
        F.when(k == 0, F.concat(plain, F.lit("Z")))
        .when(k == 1, F.concat(shifted, F.lit(".000+02:00")))
        .otherwise(plain)
    )


def _deports(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    body = _json(
        {
            "deport": {
                "uid": c("uid"),
                "legislature": c("legislature"),
                "refActeur": c("acteur_ref"),
                "dateCreation": _stamp("date_creation"),
                "datePublication": _stamp("date_publication"),
                "portee": {"code": c("portee_code"), "libelle": c("portee_libelle")},
                "lecture": {"code": c("lecture_code")},
                "instance": {"code": c("instance_code")},
                "cible": {
                    "type": {"code": c("cible_type_code")},
                    "referenceTextuelle": c("cible_reference_textuelle"),
                },
            }
        }
    )
    return raw_table(spark, sf, "deports").select(_entry("deport/", c("uid")), body.alias("body"))


def _escaped(column: str) -> Column:
    text = F.replace(F.col(column), F.lit("&"), F.lit("&amp;"))
    return F.replace(text, F.lit("<"), F.lit("&lt;"))


_XML_HEAD = (
    "<?xml version='1.0' encoding='UTF-8'?>"
    '<compteRendu xmlns="http://schemas.assemblee-nationale.fr/referentiel">'
)


def _element(name: str, column: Column) -> Column:
    return F.coalesce(
        F.concat(F.lit(f"<{name}>"), column, F.lit(f"</{name}>")), F.lit("")
    )


def _comptes_rendus(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    meta = F.concat(
        _element("dateSeance", c("date_seance")),
        _element("dateSeanceJour", c("date_seance_jour")),
        F.lit("<numSeanceJour> \n </numSeanceJour>"),
        *[
            _element(tag, c(column))
            for tag, column in (
                ("numSeance", "num_seance"),
                ("typeAssemblee", "type_assemblee"),
                ("legislature", "legislature"),
                ("session", "session"),
                ("etat", "etat"),
                ("diffusion", "diffusion"),
                ("version", "version"),
            )
        ],
    )
    body = F.concat(
        F.lit(_XML_HEAD),
        _element("uid", _pad("uid")),
        _element("seanceRef", c("seance_ref")),
        _element("sessionRef", c("session_ref")),
        _element("metadonnees", meta),
        F.lit("<contenu><quantiemes><journee>J</journee></quantiemes></contenu></compteRendu>"),
    )
    raw = raw_table(spark, sf, "comptes_rendus")
    return raw.select(_entry("", c("uid")), body.alias("body"))


def transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """A transcript per conversation turn: an opening, a point with one paragraph per line."""
    c = F.col
    turns = bench_table(spark, sf, "conversations").withColumn("safe", _escaped("text"))
    key = F.concat_ws("-", "conv_id", "turn")
    lines = F.transform(
        F.split("safe", "\n"),
        lambda line, i: F.concat(
            F.lit('<paragraphe id_syceron="IN'), key, F.lit("-"), i.cast("string"),
            F.lit('" code_parole="" ordre_absolu_seance="'), i.cast("string"), F.lit('">'),
            F.when(
                i % 3 != 2,
                F.concat(
                    F.lit("<orateurs><orateur><nom> "), c("role"), F.lit(" </nom><id>"),
                    c("conv_id").cast("string"), F.lit("</id><qualite/></orateur>"),
                    F.lit("<orateur><nom>second</nom></orateur></orateurs>"),
                ),
            ).otherwise(""),
            F.when(i % 4 != 3, F.concat(F.lit("<texte> <br/>"), line, F.lit(
                "<br/>fin <italique> (<b> bruit</b> ) </italique> </texte>"))).otherwise(""),
            F.lit("</paragraphe>"),
        ),
    )
    body = F.concat(
        F.lit(_XML_HEAD),
        F.lit("<uid>CR"), key, F.lit("</uid><contenu>"),
        F.lit('<ouvertureSeance id_syceron="OP'), key, F.lit('"/>'),
        F.lit('<autre id_syceron="decoy"/>'),
        F.lit('<point id_syceron="PT'), key, F.lit('" valeur_ptsodj="'), c("turn").cast("string"),
        F.lit('" nivpoint="1"><texte>'), F.replace(c("safe"), F.lit("\n"), F.lit("<br/>")),
        F.lit("</texte>"), F.array_join(lines, ""), F.lit("</point></contenu></compteRendu>"),
    )
    return turns.select(_entry("", key), body.alias("body"))


def _scrutins(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    body = _json(
        {
            "scrutin": {
                "uid": c("uid"),
                "numero": c("numero"),
                "legislature": c("legislature"),
                "organeRef": c("organe_ref"),
                "dateScrutin": c("date_scrutin").cast("string"),
                "quantiemeJourSeance": c("quantieme_jour_seance").cast("string"),
                "typeVote": {
                    "codeTypeVote": c("type_vote_code"),
                    "libelleTypeVote": c("type_vote_libelle"),
                },
                "sort": {"code": _pad("sort_code")},
                "titre": c("titre"),
                "demandeur": {"texte": c("demandeur_texte")},
                "objet": {"libelle": c("objet_libelle")},
                "modePublicationDesVotes": c("mode_publication_votes"),
                "syntheseVote": {
                    "nombreVotants": c("synthese_nombre_votants"),
                    "suffragesExprimes": c("synthese_suffrages_exprimes").cast("string"),
                    "decompte": {
                        "nonVotants": "n/a",
                        "pour": c("synthese_pour").cast("string"),
                        "contre": c("synthese_contre").cast("string"),
                        "abstentions": c("synthese_abstentions").cast("string"),
                    },
                },
            }
        },
        nulls=True,
    )
    return raw_table(spark, sf, "scrutins").select(_entry("", c("uid")), body.alias("body"))


def _ballot(uid: str, groups: Column, **raw: Column) -> Column:
    organ = _with(_json({"organeRef": "PO0"}), groupes=_wrap("groupe", groups))
    breakdown = _wrap("organe", organ)
    return _wrap("scrutin", _with(_json({"uid": F.col(uid)}), ventilationVotes=breakdown, **raw))


def _scrutin_groupes_votes(spark: SparkSession, sf: str) -> DataFrame:
    """A ballot per document; it holds one group per nation at most."""
    c = F.col
    group = _json(
        {
            "organeRef": c("groupe_organe_ref"),
            "nombreMembresGroupe": c("nombre_membres_groupe").cast("string"),
            "vote": {
                "positionMajoritaire": c("position_majoritaire"),
                "decompteVoix": {
                    "nonVotants": c("non_votants").cast("string"),
                    "pour": c("pour").cast("string"),
                    "contre": c("contre").cast("string"),
                    "abstentions": c("abstentions").cast("string"),
                },
            },
        }
    )
    ballots = (
        raw_table(spark, sf, "scrutin_groupes_votes")
        .groupBy("scrutin_uid")
        .agg(F.collect_list(group).alias("groups"))
    )
    alone = (F.size("groups") == 1) & (F.pmod(F.xxhash64("scrutin_uid"), F.lit(2)) == 0)
    groups = F.when(alone, F.get("groups", 0)).otherwise(
        _list('"decoy"', F.array_join("groups", ","), "null")
    )
    body = _ballot("scrutin_uid", groups)
    return ballots.select(_entry("", c("scrutin_uid")), body.alias("body"))


def _scrutin_votes_individuels(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    voter = _json(
        {
            "acteurRef": F.nullif(c("acteur_ref"), F.lit("")),
            "mandatRef": c("mandat_ref"),
            "parDelegation": c("par_delegation").cast("string"),
            "numPlace": c("num_place"),
            "causePositionVote": c("cause_position_vote"),
        }
    )
    k = F.pmod(F.xxhash64("mandat_ref"), F.lit(4))
    container = (
        F.when(k == 0, _wrap("votant", voter))
        .when(k == 1, _wrap("votant", _list("null", voter)))
        .when(k == 2, _list(voter, '"decoy"'))
        .otherwise(voter)
    )
    named = F.concat(c("position_vote"), F.lit("s"))
    voters = F.concat(F.lit('{"'), named, F.lit('":'), container, F.lit(',"nonVotants":{}}'))
    corrected = c("source") == "mise_au_point"
    group = _with(
        _json({"organeRef": c("groupe_organe_ref")}),
        vote=_wrap("decompteNominatif", voters),
    )
    body = _ballot(
        "scrutin_uid",
        F.when(corrected, F.lit("null")).otherwise(group),
        miseAuPoint=F.when(corrected, voters),
    )
    raw = raw_table(spark, sf, "scrutin_votes_individuels")
    return raw.select(_entry("", c("mandat_ref")), body.alias("body"))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    coded = {
        "famille": {
            "depot": {"code": c("famille_depot_code")},
            "classe": {"libelle": c("famille_classe_libelle")},
        },
        "type": {"code": c("type_code"), "libelle": c("type_libelle")},
    }
    document = _json(
        {
            "uid": c("uid"),
            "legislature": c("legislature"),
            "classification": coded,
            "denominationStructurelle": c("denomination_structurelle"),
            "provenance": c("provenance"),
            "titres": {"titrePrincipal": c("titre_principal")},
            "dossierRef": c("dossier_ref"),
            "cycleDeVie": {
                "chrono": {"dateCreation": _stamp("date_creation"), "dateDepot": _stamp("date_depot")}
            },
            "notice": {
                "numNotice": c("num_notice"),
                "adoptionConforme": F.initcap(c("adoption_conforme").cast("string")),
            },
            "imprimerie": {"nbPage": c("nb_page").cast("string")},
        }
    )
    author = _json({"acteur": {"acteurRef": c("auteur_ref"), "qualite": c("auteur_qualite")}})
    authors = F.when(c("auteur_ref").isNotNull(), author).otherwise(
        F.lit('[{"acteur":{"acteurRef":"decoy"}},{"acteur":{"acteurRef":"decoy"}}]')
    )
    body = _wrap("document", _with(document, auteurs=_wrap("auteur", authors)))
    return raw_table(spark, sf, "documents").select(
        _entry("document/", c("uid")), body.alias("body")
    )


def _dossiers(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    n = c("nombre_actes_legislatifs")
    act = F.lit('{"uid":"A"}')
    acts = F.when(n == 1, act).when(n == 2, _list(act, act))
    organ = F.when(
        F.pmod(F.xxhash64("uid"), F.lit(2)) == 0, _json({"uid": c("initiateur_organe_ref")})
    ).otherwise(F.concat(F.lit('"'), c("initiateur_organe_ref"), F.lit('"')))
    person = _json(
        {"acteurRef": c("initiateur_acteur_ref"), "mandatRef": c("initiateur_mandat_ref")}
    )
    people = F.when(c("initiateur_acteur_ref").isNotNull(), person).otherwise(
        F.lit('[{"acteurRef":"decoy"},{"acteurRef":"decoy"}]')
    )
    initiator = _with(
        F.lit("{}"),
        acteurs=_wrap("acteur", people),
        organes=_wrap("organe", _wrap("organeRef", organ)),
    )
    dossier = _json(
        {
            "uid": c("uid"),
            "legislature": c("legislature"),
            "titreDossier": {"titre": c("titre_dossier"), "titreChemin": c("titre_chemin")},
            "procedureParlementaire": {
                "code": c("procedure_parlementaire_code"),
                "libelle": c("procedure_parlementaire_libelle"),
            },
        }
    )
    body = _wrap(
        "dossierParlementaire",
        _with(dossier, initiateur=initiator, actesLegislatifs=_wrap("acteLegislatif", acts)),
    )
    return raw_table(spark, sf, "dossiers_parlementaires").select(
        _entry("dossierParlementaire/", c("uid")), body.alias("body")
    )


def _actes(spark: SparkSession, sf: str) -> DataFrame:
    """Acts with a ballot hold a child without key, which holds two acts with keys of their own.

    Beside each act stands one without any key, whose child must vanish with it.
    """
    c = F.col
    leaves = [
        _json({"uid": F.concat("acte_uid", F.lit(f"/{i}")), "codeActe": f"L3-{i}"}) for i in (1, 2)
    ]
    child = _with(
        F.lit('{"codeActe":"L2"}'), actesLegislatifs=_wrap("acteLegislatif", _list(*leaves))
    )
    children = F.when(c("vote_ref").isNotNull(), _wrap("acteLegislatif", child))
    act = _with(
        _json(
            {
                "uid": c("acte_uid"),
                "codeActe": c("acte_code"),
                "libelleActe": {"nomCanonique": c("acte_libelle_canonique")},
                "organeRef": c("organe_ref"),
                "dateActe": _stamp("date_acte"),
                "@xsi:type": c("type_acte"),
                "texteAssocie": c("texte_associe"),
                "voteRefs": {"voteRef": c("vote_ref")},
            }
        ),
        actesLegislatifs=children,
    )
    orphan = '{"codeActe":"decoy","actesLegislatifs":{"acteLegislatif":{"uid":"decoy"}}}'
    acts = F.when(c("texte_associe").isNull(), act).otherwise(_list(orphan, act, "{}"))
    body = _wrap(
        "dossierParlementaire",
        _with(_json({"uid": c("dossier_uid")}), actesLegislatifs=_wrap("acteLegislatif", acts)),
    )
    return raw_table(spark, sf, "dossier_actes_legislatifs").select(
        _entry("dossierParlementaire/", c("acte_uid")), body.alias("body")
    )


def _amendement_entry() -> Column:
    path = F.concat("dossier_legislatif_ref", F.lit("/TEXTE/"), "uid")
    return _entry("", path)


def _amendements(spark: SparkSession, sf: str) -> DataFrame:
    """Amendments, each next to a document cut short, which must be left out."""
    c = F.col
    body = _json(
        {
            "amendement": {
                "uid": c("uid"),
                "legislature": c("legislature"),
                "identification": {
                    "numeroLong": c("numero_long"),
                    "numeroOrdreDepot": c("numero_ordre_depot"),
                    "prefixeOrganeExamen": c("prefixe_organe_examen"),
                },
                "examenRef": c("examen_ref"),
                "pointeurFragmentTexte": "not an object",
                "corps": {"contenuAuteur": {"dispositif": _pad("dispositif")}},
                "cycleDeVie": {
                    "dateDepot": c("date_depot").cast("string"),
                    "datePublication": c("date_publication").cast("string"),
                    "sort": c("sort"),
                    "etatDesTraitements": {"etat": {"code": c("etat_code")}},
                },
                "signataires": {
                    "auteur": {
                        "typeAuteur": c("auteur_type"),
                        "acteurRef": c("auteur_acteur_ref"),
                        "groupePolitiqueRef": c("auteur_groupe_politique_ref"),
                    }
                },
            }
        },
        nulls=True,
    )
    cut = body.substr(F.lit(1), F.length(body) - 5)
    both = raw_table(spark, sf, "amendements").select(
        _amendement_entry(), F.explode(F.array(body, cut)).alias("body")
    )
    return both


def _cosignataires(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    uid = F.concat(F.lit("AM"), c("o_orderkey").cast("string"))
    first, third = [
        F.concat(F.lit('" PA'), (c("o_custkey") + n).cast("string"), F.lit('"')) for n in (1, 3)
    ]
    refs = F.when(c("o_orderkey") % 2 == 0, _list(first, "null", third)).otherwise(first)
    signed = _wrap("cosignataires", _wrap("acteurRef", refs))
    body = _wrap("amendement", _with(_json({"uid": uid}), signataires=signed))
    return bench_table(spark, sf, "orders").select(_entry("", uid), body.alias("body"))


def _questions(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col

    def text(kind: str, body: str, day: str, page: Column | None) -> Column:
        journal = {"dateJO": c(day).cast("string")} | ({} if page is None else {"pageJO": page})
        node = _json({"texte": c(body), "infoJO": journal})
        return _wrap(kind, _one_or_list(node, F.concat(F.lit(kind), "uid")))

    person = _json({"identite": {"acteurRef": c("auteur_acteur_ref")}})
    group = _one_or_list(_json({"abrege": c("auteur_groupe_abrege")}), c("uid"))
    ident = _json(
        {"numero": c("numero"), "regime": c("regime"), "legislature": c("legislature")}
    )
    question = _with(
        _json({"uid": c("uid"), "type": c("type"), "indexationAN": {"rubrique": c("rubrique")}}),
        identifiant=_one_or_list(ident, F.concat(F.lit("i"), "uid")),
        auteur=_with(person, groupe=group),
        minInt=_json({"abrege": c("min_int_abrege")}),
        textesQuestion=text(
            "texteQuestion", "texte_question", "date_jo_question", c("page_jo_question")
        ),
        textesReponse=text("texteReponse", "texte_reponse", "date_jo_reponse", None),
    )
    body = _wrap("question", _one_or_list(question, F.concat(F.lit("q"), "uid")))
    raw = raw_table(spark, sf, "questions_ecrites")
    return raw.select(_entry("", c("uid")), body.alias("body"))


def _question_parts(table: str, outer: str, inner: str, node: Column):
    def build(spark: SparkSession, sf: str) -> DataFrame:
        parts = _wrap(inner, _one_or_list(node, F.xxhash64("question_uid", "date_jo")))
        body = _wrap("question", _with(_json({"uid": F.col("question_uid")}), **{outer: parts}))
        raw = raw_table(spark, sf, table)
        return raw.select(_entry("", F.col("question_uid")), body.alias("body"))

    return build


def _min_attribs(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    node = _json(
        {
            "infoJO": {"typeJO": c("type_jo"), "dateJO": c("date_jo").cast("string")},
            "denomination": {
                "organeRef": c("organe_ref"),
                "abrege": c("abrege"),
                "developpe": c("developpe"),
            },
        }
    )
    table = "questions_ecrites_min_attribs"
    return _question_parts(table, "minAttribs", "minAttrib", node)(spark, sf)


def _renouvellements(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    node = _json(
        {
            "infoJO": {
                "typeJO": c("type_jo"),
                "dateJO": F.coalesce(c("date_jo").cast("string"), F.lit("bientot")),
                "numJO": c("num_jo"),
            }
        }
    )
    table = "questions_ecrites_renouvellements"
    return _question_parts(table, "renouvellements", "renouvellement", node)(spark, sf)


DOCUMENTS = {
    "acteurs": _acteurs,
    "adresses": _adresses,
    "mandats": _mandats,
    "organes": _organes,
    "deports": _deports,
    "comptes_rendus": _comptes_rendus,
    "points_seance": transcripts,
    "interventions": transcripts,
    "scrutins": _scrutins,
    "scrutin_groupes_votes": _scrutin_groupes_votes,
    "scrutin_votes_individuels": _scrutin_votes_individuels,
    "documents": _documents,
    "dossiers_parlementaires": _dossiers,
    "dossier_actes_legislatifs": _actes,
    "amendements": _amendements,
    "amendement_signataires": _amendements,
    "amendement_cosignataires": _cosignataires,
    "questions_ecrites": _questions,
    "questions_ecrites_min_attribs": _min_attribs,
    "questions_ecrites_renouvellements": _renouvellements,
}


def ingest(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = DOCUMENTS[table](spark, sf_dir)
    if table in FEEDS["deputies"]:
        return INGEST[table](documents, _RUN)
    return INGEST[table](documents)


_KEY = "cast(conv_id as varchar) || '-' || cast(turn as varchar)"

# Where parsing gives back something else than the adapter's rows.
INGESTED = {
    "mandats": """
        select * replace (unnest(case when preseance = 5 then [organe_ref, 'PX1', 'PX2']
                                      when preseance = 6 then [null]
                                      else [organe_ref] end) as organe_ref)
        from mandats""",
    "dossier_actes_legislatifs": """
        select * from dossier_actes_legislatifs
        union all
        select dossier_uid, acte_uid || suffix, code, null, null, null, null, null, null, null
        from dossier_actes_legislatifs,
             (values ('', 'L2'), ('/1', 'L3-1'), ('/2', 'L3-2')) as below(suffix, code)
        where vote_ref is not null""",
    "points_seance": f"""
        select 'CR' || {_KEY} as compte_rendu_uid, kind || {_KEY} as point_id,
               case when kind = 'OP' then 'ouvertureSeance' else 'point' end as point_type,
               case when kind = 'PT' then cast(turn as varchar) end as valeur_ptsodj,
               case when kind = 'PT' then '1' end as nivpoint,
               cast(null as varchar) as ordinal_prise,
               cast(null as varchar) as ordre_absolu_seance,
               cast(null as varchar) as code_grammaire, cast(null as varchar) as code_style,
               cast(null as varchar) as sommaire,
               case when kind = 'PT' then trim(text, chr(10) || ' ') else '' end as titre
        from conversations, (values ('OP'), ('PT')) as kinds(kind)""",
    "interventions": f"""
        select 'CR' || {_KEY} as compte_rendu_uid, 'PT' || {_KEY} as point_id,
               cast(turn as varchar) as point_valeur_ptsodj,
               'IN' || {_KEY} || '-' || cast(i - 1 as varchar) as intervention_id,
               cast(i - 1 as varchar) as ordre_absolu_seance,
               cast(null as varchar) as ordinal_prise, cast(null as varchar) as code_grammaire,
               cast(null as varchar) as code_style, '' as code_parole,
               cast(null as varchar) as roledebat,
               case when (i - 1) % 3 <> 2 then role end as orateur_nom,
               case when (i - 1) % 3 <> 2 then cast(conv_id as varchar) end as orateur_id,
               cast(null as varchar) as orateur_qualite,
               case when (i - 1) % 4 <> 3
                    then trim(line || chr(10) || 'fin (bruit )', chr(10) || ' ') else '' end as texte
        from (select conv_id, turn, role, unnest(string_split(text, chr(10))) as line,
                     generate_subscripts(string_split(text, chr(10)), 1) as i
              from conversations) l""",
}
