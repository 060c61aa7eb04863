"""Legislative files feed: documents, files, and the acts nested in files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.functions.coerce import to_bool_word, to_int, to_str, to_ts
from rostrum.functions.nodes import fields, objects, text_or_uid
from rostrum.ingest.parsing import parse_documents
from rostrum.schemas import shape

_CODED = fields("code", "libelle")
_DOCUMENT = fields(
    *("uid", "legislature", "denominationStructurelle", "provenance", "dossierRef"),
    (
        "classification",
        fields(
            ("famille", fields(("depot", _CODED), ("classe", _CODED), ("espece", _CODED))),
            ("type", _CODED),
            ("sousType", _CODED),
        ),
    ),
    ("titres", fields("titrePrincipal", "titrePrincipalCourt")),
    (
        "cycleDeVie",
        fields(
            ("chrono", fields("dateCreation", "dateDepot", "datePublication", "datePublicationWeb"))
        ),
    ),
    ("notice", fields("numNotice", "formule", "adoptionConforme")),
    ("auteurs", fields(("auteur", fields(("acteur", fields("acteurRef", "qualite")))))),
    ("imprimerie", fields("ISBN", "ISSN", "DIAN", "nbPage")),
)
_FILE = fields(
    *("uid", "legislature"),
    ("titreDossier", fields("titre", "titreChemin")),
    ("procedureParlementaire", _CODED),
    (
        "initiateur",
        fields(
            ("acteurs", fields(("acteur", fields("acteurRef", "mandatRef")))),
            ("organes", fields(("organe", fields("organeRef")))),
        ),
    ),
    ("actesLegislatifs", fields("acteLegislatif")),
)
_ACT = fields(
    *("uid", "codeActe", "organeRef", "dateActe", "@xsi:type", "texteAssocie"),
    ("libelleActe", fields("nomCanonique", "libelleCourt")),
    ("voteRefs", fields("voteRef")),
    ("actesLegislatifs", fields("acteLegislatif")),
)
_NAMED_ACTS = T.ArrayType(
    T.StructType([T.StructField("acte_uid", T.StringType()), T.StructField("act", _ACT)])
)


def parse_files_documents(documents: DataFrame) -> DataFrame:
    return _with_uid(parse_documents(documents, "json/document/", "document", _DOCUMENT))


def parse_files(documents: DataFrame) -> DataFrame:
    prefix, root = "json/dossierParlementaire/", "dossierParlementaire"
    return _with_uid(parse_documents(documents, prefix, root, _FILE))


def _with_uid(parsed: DataFrame) -> DataFrame:
    return parsed.select(to_str(F.col("doc.uid")).alias("uid"), "doc").where(
        F.col("uid").isNotNull()
    )


def documents(parsed: DataFrame) -> DataFrame:
    """The author is kept only where the document has a single one."""
    d = F.col("doc")
    family, chrono = d.classification.famille, d.cycleDeVie.chrono
    author = d.auteurs.auteur.acteur
    return shape(
        parsed,
        "documents",
        legislature=to_str(d.legislature),
        type_code=to_str(d.classification.type.code),
        type_libelle=to_str(d.classification.type.libelle),
        denomination_structurelle=to_str(d.denominationStructurelle),
        provenance=to_str(d.provenance),
        titre_principal=to_str(d.titres.titrePrincipal),
        titre_principal_court=to_str(d.titres.titrePrincipalCourt),
        dossier_ref=to_str(d.dossierRef),
        date_creation=to_ts(chrono.dateCreation),
        date_depot=to_ts(chrono.dateDepot),
        date_publication=to_ts(chrono.datePublication),
        date_publication_web=to_ts(chrono.datePublicationWeb),
        famille_depot_code=to_str(family.depot.code),
        famille_depot_libelle=to_str(family.depot.libelle),
        famille_classe_code=to_str(family.classe.code),
        famille_classe_libelle=to_str(family.classe.libelle),
        famille_espece_code=to_str(family.espece.code),
        famille_espece_libelle=to_str(family.espece.libelle),
        type_sous_type_code=to_str(d.classification.sousType.code),
        type_sous_type_libelle=to_str(d.classification.sousType.libelle),
        num_notice=to_str(d.notice.numNotice),
        formule=to_str(d.notice.formule),
        adoption_conforme=to_bool_word(d.notice.adoptionConforme),
        auteur_ref=to_str(author.acteurRef),
        auteur_qualite=to_str(author.qualite),
        isbn=to_str(d.imprimerie.ISBN),
        issn=to_str(d.imprimerie.ISSN),
        dian=to_str(d.imprimerie.DIAN),
        nb_page=to_int(d.imprimerie.nbPage),
    )


def _empty(node: Column) -> Column:
    """True for a node that counts as absent: missing or an empty or zero value."""
    return F.coalesce(node.isin("", "{}", "[]", "0", "0.0", "false"), F.lit(True))


def dossiers_parlementaires(parsed: DataFrame) -> DataFrame:
    """``nombre_actes_legislatifs`` counts the acts of the top level only."""
    d = F.col("doc")
    acts = d.actesLegislatifs.acteLegislatif
    count = (
        F.when(_empty(acts), F.lit(0))
        .when(acts.startswith("["), F.size(F.from_json(acts, "array<string>")))
        .otherwise(F.lit(1))
    )
    author = d.initiateur.acteurs.acteur
    return shape(
        parsed,
        "dossiers_parlementaires",
        legislature=to_str(d.legislature),
        titre_dossier=to_str(d.titreDossier.titre),
        titre_chemin=to_str(d.titreDossier.titreChemin),
        procedure_parlementaire_code=to_str(d.procedureParlementaire.code),
        procedure_parlementaire_libelle=to_str(d.procedureParlementaire.libelle),
        initiateur_acteur_ref=to_str(author.acteurRef),
        initiateur_mandat_ref=to_str(author.mandatRef),
        initiateur_organe_ref=text_or_uid(d.initiateur.organes.organe.organeRef),
        nombre_actes_legislatifs=count,
    )


def _named(acts: Column, parent: Column) -> Column:
    """Acts with their key, which an act without one takes from its parent.

    An act that has neither is left out together with all below it.
    """
    found = F.when(~_empty(acts), objects(acts, _ACT))
    keyed = F.transform(
        found,
        lambda a: F.struct(F.coalesce(to_str(a.uid), parent).alias("acte_uid"), a.alias("act")),
    )
    kept = F.filter(keyed, lambda k: k.acte_uid.isNotNull())
    return F.coalesce(kept, F.array().cast(_NAMED_ACTS)).cast(_NAMED_ACTS)


def _all_acts(top: Column) -> Column:
    """Every act below a file, to any depth, as one array.

    The loop stays inside the row: each step opens the acts found but not opened
    yet and appends their children. A container of acts opens at most one level,
    so the number of containers in the text bounds the number of steps; steps
    that find everything opened leave the state as it is.
    """
    first = _named(top, F.lit(None).cast("string"))
    start = F.struct(first.alias("found"), F.lit(0).alias("opened"))
    steps = F.sequence(F.lit(1), F.regexp_count(top, F.lit('"acteLegislatif"')))

    def step(acc: Column, _: Column) -> Column:
        total = F.size(acc.found)
        waiting = F.slice(acc.found, acc.opened + 1, total - acc.opened)
        below = F.flatten(
            F.transform(
                waiting, lambda k: _named(k.act.actesLegislatifs.acteLegislatif, k.acte_uid)
            )
        )
        opened = F.struct(F.concat(acc.found, below).alias("found"), total.alias("opened"))
        return F.when(acc.opened == total, acc).otherwise(opened)

    looped = F.aggregate(steps, start, step, lambda acc: acc.found)
    return F.when(top.contains('"acteLegislatif"'), looped).otherwise(first)


def dossier_actes_legislatifs(parsed: DataFrame) -> DataFrame:
    top = F.col("doc.actesLegislatifs.acteLegislatif")
    rows = parsed.select(F.col("uid").alias("dossier_uid"), F.inline(_all_acts(top)))
    a = F.col("act")
    return shape(
        rows,
        "dossier_actes_legislatifs",
        acte_code=to_str(a.codeActe),
        acte_libelle_canonique=to_str(a.libelleActe.nomCanonique),
        acte_libelle_court=to_str(a.libelleActe.libelleCourt),
        organe_ref=to_str(a.organeRef),
        date_acte=to_ts(a.dateActe),
        type_acte=to_str(a["@xsi:type"]),
        texte_associe=to_str(a.texteAssocie),
        vote_ref=to_str(a.voteRefs.voteRef),
    )
