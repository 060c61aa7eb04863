"""The twenty raw tables: column names, types and required columns.

A spec line is ``name`` for a nullable string, ``name:type`` for another type,
and a leading ``!`` marks a required column (neither NULL nor empty).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "ts": T.TimestampType(),
}

# The table layouts every consumer of the raw tables relies on.
_SPECS = {
    "acteurs": """!uid civilite prenom nom alpha trigramme date_naissance:date ville_naissance
        departement_naissance pays_naissance profession_libelle profession_categorie
        profession_famille uri_hatvp !ingested_at:ts""",
    "adresses": """!uid !acteur_uid type_code type_libelle xsi_type intitule numero_rue nom_rue
        complement code_postal ville val_elec !ingested_at:ts""",
    "mandats": """!uid !acteur_ref xsi_type legislature type_organe organe_ref date_debut:date
        date_fin:date date_publication:date preseance:long nomin_principale:bool code_qualite
        lib_qualite election_departement election_num_departement election_num_circo
        election_cause_mandat mandature_date_prise_fonction:date mandature_cause_fin
        mandature_premiere_election:bool mandature_place_hemicycle:long !ingested_at:ts""",
    "organes": """!uid xsi_type code_type libelle libelle_abrege libelle_abrev regime legislature
        date_debut:date date_fin:date circo_numero circo_region_type circo_region_libelle
        circo_dep_code circo_dep_libelle gp_couleur gp_preseance:long gp_position_politique
        !ingested_at:ts""",
    "deports": """!uid legislature !acteur_ref date_creation:ts date_publication:ts portee_code
        portee_libelle lecture_code instance_code cible_type_code cible_reference_textuelle
        !ingested_at:ts""",
    "comptes_rendus": """uid seance_ref session_ref date_seance date_seance_jour num_seance_jour
        num_seance type_assemblee legislature session etat diffusion version""",
    "points_seance": """compte_rendu_uid point_id point_type valeur_ptsodj nivpoint ordinal_prise
        ordre_absolu_seance code_grammaire code_style sommaire titre""",
    "interventions": """compte_rendu_uid point_id point_valeur_ptsodj intervention_id
        ordre_absolu_seance ordinal_prise code_grammaire code_style code_parole roledebat
        orateur_nom orateur_id orateur_qualite texte""",
    "scrutins": """!uid numero legislature organe_ref session_ref seance_ref date_scrutin:date
        quantieme_jour_seance:long type_vote_code type_vote_libelle type_majorite sort_code
        sort_libelle titre demandeur_texte demandeur_reference_legislative objet_libelle
        objet_dossier_legislatif objet_reference_legislative mode_publication_votes lieu_vote
        synthese_nombre_votants:long synthese_suffrages_exprimes:long
        synthese_nbr_suffrages_requis:long synthese_annonce synthese_non_votants:long
        synthese_pour:long synthese_contre:long synthese_abstentions:long
        synthese_non_votants_volontaires:long""",
    "scrutin_groupes_votes": """!scrutin_uid organe_ref_assemblee groupe_organe_ref
        nombre_membres_groupe:long position_majoritaire non_votants:long pour:long contre:long
        abstentions:long non_votants_volontaires:long""",
    "scrutin_votes_individuels": """!scrutin_uid groupe_organe_ref !position_vote acteur_ref
        mandat_ref par_delegation:bool num_place cause_position_vote !source""",
    "documents": """!uid legislature type_code type_libelle denomination_structurelle provenance
        titre_principal titre_principal_court dossier_ref date_creation:ts date_depot:ts
        date_publication:ts date_publication_web:ts famille_depot_code famille_depot_libelle
        famille_classe_code famille_classe_libelle famille_espece_code famille_espece_libelle
        type_sous_type_code type_sous_type_libelle num_notice formule adoption_conforme:bool
        auteur_ref auteur_qualite isbn issn dian nb_page:long""",
    "dossiers_parlementaires": """!uid legislature titre_dossier titre_chemin
        procedure_parlementaire_code procedure_parlementaire_libelle initiateur_acteur_ref
        initiateur_mandat_ref initiateur_organe_ref nombre_actes_legislatifs:long""",
    "dossier_actes_legislatifs": """!dossier_uid !acte_uid acte_code acte_libelle_canonique
        acte_libelle_court organe_ref date_acte:ts type_acte texte_associe vote_ref""",
    "amendements": """!uid legislature numero_long numero_ordre_depot prefixe_organe_examen
        examen_ref texte_legislatif_ref division_titre article_designation_courte division_type
        dispositif expose_sommaire date_depot:date date_publication:date etat_code etat_libelle
        sous_etat_code sous_etat_libelle sort auteur_type auteur_acteur_ref
        auteur_groupe_politique_ref dossier_legislatif_ref""",
    "amendement_signataires": """!amendement_uid !acteur_ref type_auteur groupe_politique_ref
        ordre_presentation:long""",
    "amendement_cosignataires": """!amendement_uid !cosignataire_acteur_ref
        ordre_presentation:long""",
    "questions_ecrites": """!uid numero regime legislature type rubrique tete_analyse analyse
        auteur_acteur_ref auteur_mandat_ref auteur_groupe_organe_ref auteur_groupe_abrege
        auteur_groupe_developpe min_int_organe_ref min_int_abrege min_int_developpe
        texte_question date_jo_question:date page_jo_question texte_reponse
        date_jo_reponse:date page_jo_reponse""",
    "questions_ecrites_min_attribs": "!question_uid type_jo date_jo:date organe_ref abrege developpe",
    "questions_ecrites_renouvellements": "!question_uid type_jo date_jo:date num_jo",
}

# Which tables each feed publishes together.
FEEDS = {
    "deputies": ("acteurs", "adresses", "mandats", "organes", "deports"),
    "debates": ("comptes_rendus", "points_seance", "interventions"),
    "ballots": ("scrutins", "scrutin_groupes_votes", "scrutin_votes_individuels"),
    "files": ("documents", "dossiers_parlementaires", "dossier_actes_legislatifs"),
    "amendments": ("amendements", "amendement_signataires", "amendement_cosignataires"),
    "questions": (
        "questions_ecrites",
        "questions_ecrites_min_attribs",
        "questions_ecrites_renouvellements",
    ),
}


def _columns(table: str) -> list[tuple[str, T.DataType, bool]]:
    columns = []
    for token in _SPECS[table].split():
        name, _, kind = token.lstrip("!").partition(":")
        columns.append((name, _TYPES[kind or "string"], token.startswith("!")))
    return columns


RAW_TABLES: tuple[str, ...] = tuple(_SPECS)
SCHEMAS: dict[str, T.StructType] = {
    table: T.StructType([T.StructField(n, t, True) for n, t, _ in _columns(table)])
    for table in RAW_TABLES
}
REQUIRED: dict[str, tuple[str, ...]] = {
    table: tuple(n for n, _, required in _columns(table) if required) for table in RAW_TABLES
}


def shape(df: DataFrame, table: str, **columns: Column) -> DataFrame:
    """Select the columns of ``table`` in order, cast to their declared types.

    A column comes from the keyword of the same name, else from ``df``; a
    declared column found in neither is NULL.
    """
    present = set(df.columns)
    picked = []
    for field in SCHEMAS[table]:
        source = columns.get(field.name)
        if source is None:
            source = F.col(field.name) if field.name in present else F.lit(None)
        picked.append(source.cast(field.dataType).alias(field.name))
    return df.select(picked)
