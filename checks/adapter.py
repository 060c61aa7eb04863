"""Raw tables computed from the benchmark tables, for tests and benchmarks only.

Each table is one plain SELECT that means the same to Spark and to DuckDB, so a
model can run on Spark over the very rows its oracle sees. Columns not derived
here are NULL. The data carry NULLs, orphans, repeats and uneven keys on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rostrum.plans import Models
from rostrum.schemas import RAW_TABLES, SCHEMAS

RUN_TIME = "2024-07-01 12:00:00"

_NOW = f"cast('{RUN_TIME}' as timestamp)"
_SHIP_DAY = "replace(cast(cast(l_shipdate as date) as string), '-', '')"
_SPEECH = (
    "cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' || "
    "cast(l_partkey as string) || '-' || cast(l_suppkey as string)"
)
_TURN = "cast(conv_id as string) || '-' || cast(turn as string)"


def _text(expression: str) -> str:
    return f"cast({expression} as string)"


def _day(base: str, offset: str) -> str:
    return f"cast('{base}' as date) + cast({offset} as int)"


# table -> ({column: expression}, FROM and WHERE)
_TABLES: dict[str, tuple[dict[str, str], str]] = {
    "acteurs": (
        {
            "uid": "'PA' || cast(c_custkey as string)",
            "civilite": "case when c_custkey % 2 = 0 then 'M.' else 'Mme' end",
            "prenom": "case when c_custkey % 7 <> 0 then c_mktsegment end",
            "nom": "c_name",
            "alpha": "lower(c_name)",
            "trigramme": "'T' || cast(c_custkey % 1000 as string)",
            "date_naissance": _day("1950-01-01", "c_custkey % 15000"),
            "ville_naissance": "'Ville ' || cast(c_nationkey as string)",
            "departement_naissance": _text("c_nationkey"),
            "pays_naissance": "case when c_custkey % 5 <> 0 then 'France' end",
            "profession_libelle": "lower(c_mktsegment)",
            "profession_categorie": _text("c_nationkey % 8"),
            "profession_famille": "case when c_custkey % 3 <> 0 then cast(c_nationkey % 30 as string) end",
            "uri_hatvp": "'https://example.org/' || cast(c_custkey as string)",
            "ingested_at": _NOW,
        },
        "from {customer} where c_custkey % 50 <> 0",
    ),
    "adresses": (
        {
            "uid": "'AD' || cast(c_custkey as string) || '-' || cast(n as string)",
            "acteur_uid": "'PA' || cast(c_custkey as string)",
            "type_code": _text("n"),
            "type_libelle": "case when n = 1 then 'Postale' else 'Mail' end",
            "xsi_type": "'Adresse_Type'",
            "intitule": "lower(c_mktsegment)",
            "numero_rue": _text("c_custkey % 200"),
            "nom_rue": "'rue ' || cast(c_nationkey as string)",
            "complement": "case when c_custkey % 4 = 0 then 'Bat ' || cast(n as string) end",
            "code_postal": _text("10000 + c_custkey % 80000"),
            "ville": "'Ville ' || cast(c_nationkey as string)",
            "val_elec": "case when n = 2 then lower(c_name) || '@example.org' end",
            "ingested_at": _NOW,
        },
        "from (select *, 1 as n from {customer} union all"
        " select *, 2 as n from {customer} where c_custkey % 2 = 0) a",
    ),
    "mandats": (
        {
            "uid": "'PM' || cast(o_orderkey as string)",
            "acteur_ref": "'PA' || cast(o_custkey as string)",
            "xsi_type": "case when o_orderstatus = 'O' then 'MandatParlementaire_type'"
            " else 'MandatSimple_Type' end",
            "legislature": _text("15 + o_orderkey % 3"),
            "type_organe": "case o_orderstatus when 'F' then 'GP' when 'P' then 'COMPER'"
            " else 'ASSEMBLEE' end",
            "organe_ref": "case o_orderstatus when 'F' then 'PG' || cast(o_orderkey % 25 as string)"
            " when 'P' then 'PCBrand#' || cast(o_orderkey % 25 + 1 as string) else 'PO0' end",
            "date_debut": "case when o_orderkey % 11 <> 0 then cast(o_orderdate as date) end",
            "date_fin": "case when o_orderkey % 4 <> 0 then"
            " cast(o_orderdate as date) + cast(o_orderkey % 1500 as int) end",
            "date_publication": "cast(o_orderdate as date) + 1",
            "preseance": "o_orderkey % 10",
            "nomin_principale": "o_orderkey % 2 = 0",
            "code_qualite": "substr(o_orderpriority, 1, 1)",
            "lib_qualite": "substr(o_orderpriority, 3, 20)",
            "election_departement": "case when o_orderstatus = 'O' then"
            " 'Departement ' || cast(o_custkey % 96 + 1 as string) end",
            "election_num_departement": "case when o_orderstatus = 'O' and o_orderkey % 9 <> 0 then"
            " cast(o_custkey % 96 + 1 as string) end",
            "election_num_circo": "case when o_orderstatus = 'O' then"
            " cast(o_orderkey % 12 + 1 as string) end",
            "election_cause_mandat": "case when o_orderstatus = 'O' then 'Election' end",
            "mandature_date_prise_fonction": "case when o_orderstatus = 'O' then"
            " cast(o_orderdate as date) + 7 end",
            "mandature_premiere_election": "case when o_orderstatus = 'O' then o_orderkey % 3 = 0 end",
            "mandature_place_hemicycle": "case when o_orderstatus = 'O' then o_custkey % 577 end",
            "ingested_at": _NOW,
        },
        "from {orders}",
    ),
    "organes": (
        {
            **{c: c for c in ("uid", "code_type", "libelle", "libelle_abrege", "date_fin")},
            **{c: c for c in ("circo_numero", "circo_dep_code", "gp_couleur")},
            **{c: c for c in ("gp_position_politique", "gp_preseance")},
            "xsi_type": "'Organe_Type'",
            "libelle_abrev": "libelle_abrege",
            "legislature": "case when code_type <> 'ASSEMBLEE' then '17' end",
            "date_debut": "cast('1995-01-01' as date)",
            "circo_dep_libelle": "'Departement ' || circo_dep_code",
            "ingested_at": _NOW,
        },
        """from (
        select 'PG' || cast(n_nationkey as string) as uid, 'GP' as code_type,
               'Groupe ' || n_name as libelle, n_name as libelle_abrege, cast(null as date) as date_fin,
               cast(null as string) as circo_numero, cast(null as string) as circo_dep_code,
               '#' || lpad(cast(n_nationkey as string), 6, '0') as gp_couleur,
               r_name as gp_position_politique, cast(n_nationkey as bigint) as gp_preseance
        from {nation} join {region} on n_regionkey = r_regionkey
        union all
        select distinct 'PC' || p_brand, 'COMPER', 'Commission ' || p_brand, p_brand,
               cast(null as date), cast(null as string), cast(null as string),
               cast(null as string), cast(null as string), cast(null as bigint)
        from {part}
        union all
        select 'PD' || cast(s_suppkey as string), 'CIRCONSCRIPTION', s_name, s_name,
               case when s_suppkey % 3 = 0 then cast('2001-01-01' as date) end,
               cast(s_suppkey % 12 + 1 as string), cast(s_suppkey % 96 + 1 as string),
               cast(null as string), cast(null as string), cast(null as bigint)
        from {supplier}
        union all
        select distinct 'PO0', 'ASSEMBLEE', 'Assemblee', 'AN', cast(null as date),
               cast(null as string), cast(null as string), cast(null as string),
               cast(null as string), cast(null as bigint)
        from {region}) o""",
    ),
    "deports": (
        {
            "uid": "'DP' || cast(c_custkey as string)",
            "legislature": _text("15 + c_custkey % 3"),
            "acteur_ref": "'PA' || cast(c_custkey as string)",
            "date_creation": f"cast({_day('2020-01-01', 'c_custkey % 1000')} as timestamp)",
            "date_publication": "case when c_custkey % 4 <> 0 then "
            f"cast({_day('2020-01-03', 'c_custkey % 1000')} as timestamp) end",
            "portee_code": "case when c_custkey % 2 = 0 then 'T' else 'P' end",
            "portee_libelle": "case when c_custkey % 2 = 0 then 'Totale' else 'Partielle' end",
            "lecture_code": "'L' || cast(c_custkey % 3 as string)",
            "instance_code": "case when c_custkey % 6 <> 0 then 'AN' end",
            "cible_type_code": "'TEXT'",
            "cible_reference_textuelle": "lower(c_mktsegment)",
            "ingested_at": _NOW,
        },
        "from {customer}",
    ),
    "comptes_rendus": (
        {
            "uid": "'CR' || replace(cast(day as string), '-', '')",
            "seance_ref": "'SE' || replace(cast(day as string), '-', '')",
            "session_ref": "'SS' || substr(cast(day as string), 1, 4)",
            "date_seance": "case when cast(substr(cast(day as string), 9, 2) as int) <= 3"
            " then replace(cast(day as string), '-', '') || '000000000'"
            " else cast(day as string) end",
            "date_seance_jour": _text("day"),
            "num_seance": "substr(cast(day as string), 6, 2)",
            "type_assemblee": "'AN'",
            "legislature": "case when substr(cast(day as string), 1, 4) < '2000' then '15' else '16' end",
            "session": "'Session ' || substr(cast(day as string), 1, 4)",
            "etat": "'complet'",
            "diffusion": "'public'",
            "version": "'avant_JO'",
        },
        "from (select distinct cast(l_shipdate as date) as day from {lineitem}) d",
    ),
    "points_seance": (
        {
            "compte_rendu_uid": "'CR' || cast(conv_id as string)",
            "point_id": f"'PT' || {_TURN}",
            "point_type": "case when turn = 0 then 'ouvertureSeance' else 'point' end",
            "valeur_ptsodj": _text("turn"),
            "nivpoint": "'1'",
            "ordinal_prise": _text("turn + 1"),
            "ordre_absolu_seance": _text("turn * 10"),
            "code_style": "role",
            "titre": "text",
        },
        "from {conversations}",
    ),
    "interventions": (
        {
            "compte_rendu_uid": f"'CR' || {_SHIP_DAY}",
            "point_id": "'PT' || cast(l_orderkey as string)",
            "point_valeur_ptsodj": _text("l_linenumber"),
            "intervention_id": f"'IN' || {_SPEECH}",
            "ordre_absolu_seance": _text("l_linenumber * 10"),
            "code_grammaire": "'PAROLE'",
            "code_style": "'NORMAL'",
            "roledebat": "case when l_linestatus = 'O' then 'president' end",
            "orateur_nom": "'Orateur ' || cast(l_partkey as string)",
            "orateur_id": "case when l_orderkey % 13 <> 0 then cast(l_partkey % 1500 as string) end",
            "orateur_qualite": "l_returnflag",
            "texte": f"'Texte ' || {_SPEECH}",
        },
        "from {lineitem}",
    ),
    "scrutins": (
        {
            "uid": "'VT' || cast(p_partkey as string)",
            "numero": _text("p_partkey"),
            "legislature": _text("15 + p_partkey % 3"),
            "organe_ref": "'PO0'",
            "date_scrutin": _day("1998-01-01", "p_partkey % 2000"),
            "quantieme_jour_seance": "p_partkey % 9",
            "type_vote_code": "substr(p_type, 1, 3)",
            "type_vote_libelle": "p_type",
            "sort_code": "case when p_size % 2 = 0 then 'adopté' else 'Rejeté' end",
            "titre": "p_name",
            "demandeur_texte": "case when p_partkey % 3 = 0 then p_brand end",
            "objet_libelle": "p_name || ' ' || p_type",
            "mode_publication_votes": "'DecompteNominatif'",
            "synthese_nombre_votants": "coalesce(pour + contre + abst, 0)",
            "synthese_suffrages_exprimes": "pour + contre",
            "synthese_pour": "pour",
            "synthese_contre": "contre",
            "synthese_abstentions": "abst",
        },
        "from {part} left join (select l_partkey,"
        " count(case when l_returnflag = 'A' then 1 end) as pour,"
        " count(case when l_returnflag = 'R' then 1 end) as contre,"
        " count(case when l_returnflag = 'N' then 1 end) as abst"
        " from {lineitem} group by l_partkey) v on p_partkey = l_partkey",
    ),
    "scrutin_groupes_votes": (
        {
            "scrutin_uid": "'VT' || cast(l_partkey as string)",
            "organe_ref_assemblee": "'PO0'",
            "groupe_organe_ref": "'PG' || cast(s_nationkey as string)",
            "nombre_membres_groupe": "pour + contre + abst + 1",
            "position_majoritaire": "case when pour >= contre and pour >= abst then 'pour'"
            " when contre >= abst then 'contre' else 'abstention' end",
            "non_votants": "cast(1 as bigint)",
            "pour": "pour",
            "contre": "contre",
            "abstentions": "abst",
        },
        "from (select l_partkey, s_nationkey,"
        " count(case when l_returnflag = 'A' then 1 end) as pour,"
        " count(case when l_returnflag = 'R' then 1 end) as contre,"
        " count(case when l_returnflag = 'N' then 1 end) as abst"
        " from {lineitem} join {supplier} on l_suppkey = s_suppkey"
        " group by l_partkey, s_nationkey) g",
    ),
    "scrutin_votes_individuels": (
        {
            "scrutin_uid": "'VT' || cast(l_partkey as string)",
            "groupe_organe_ref": "case when l_orderkey % 5 <> 0 then"
            " 'PG' || cast(l_suppkey % 25 as string) end",
            "position_vote": "case l_returnflag when 'A' then 'pour' when 'R' then 'contre'"
            " else 'abstention' end",
            "acteur_ref": "case when l_orderkey % 17 = 0 then ''"
            " else 'PA' || cast(l_partkey % 1500 as string) end",
            "mandat_ref": "'PM' || cast(l_orderkey as string)",
            "par_delegation": "case l_linenumber % 3 when 0 then true when 1 then false end",
            "num_place": _text("l_partkey % 577"),
            "cause_position_vote": "case when l_linestatus = 'F' then 'PAN' end",
            "source": "case when l_orderkey % 5 = 0 then 'mise_au_point' else 'ventilation' end",
        },
        "from {lineitem}",
    ),
    "documents": (
        {
            "uid": "'DOC' || cast(doc_id as string)",
            "legislature": _text("15 + doc_id % 3"),
            "type_code": "upper(substr(lang, 1, 4))",
            "type_libelle": "lang",
            "denomination_structurelle": "source",
            "provenance": "source",
            "titre_principal": "replace(text, chr(10), ' ') || '.'",
            "dossier_ref": "case when doc_id % 17 <> 0 then 'DL' || cast(doc_id % 150 as string) end",
            "date_creation": f"cast({_day('1999-01-01', 'doc_id % 700')} as timestamp)",
            "date_depot": "case when doc_id % 6 <> 0 then "
            f"cast({_day('1999-02-01', 'doc_id % 700')} as timestamp) end",
            "famille_depot_code": "case when doc_id % 2 = 0 then 'PRJLOI' end",
            "famille_classe_libelle": "lang",
            "num_notice": _text("doc_id"),
            "adoption_conforme": "case doc_id % 3 when 0 then true when 1 then false end",
            "auteur_ref": "case when doc_id % 4 = 0 then 'PA' || cast(doc_id as string) end",
            "auteur_qualite": "case when doc_id % 4 = 0 then 'rapporteur' end",
            "nb_page": "n_chars",
        },
        "from {documents}",
    ),
    "dossiers_parlementaires": (
        {
            "uid": "'DL' || cast(s_suppkey as string)",
            "legislature": _text("15 + s_suppkey % 3"),
            "titre_dossier": "s_name",
            "titre_chemin": "lower(s_name)",
            "procedure_parlementaire_code": _text("s_nationkey"),
            "procedure_parlementaire_libelle": "'Procedure ' || cast(s_nationkey as string)",
            "initiateur_acteur_ref": "case when s_suppkey % 2 = 0 then"
            " 'PA' || cast(s_suppkey as string) end",
            "initiateur_mandat_ref": "case when s_suppkey % 2 = 0 then"
            " 'PM' || cast(s_suppkey as string) end",
            "initiateur_organe_ref": "case when s_suppkey % 3 <> 0 then"
            " 'PG' || cast(s_nationkey as string) end",
            "nombre_actes_legislatifs": "s_suppkey % 3",
        },
        "from {supplier}",
    ),
    "dossier_actes_legislatifs": (
        {
            "dossier_uid": "'DL' || cast(l_suppkey as string)",
            "acte_uid": f"'AC' || {_SPEECH}",
            "acte_code": "case when l_returnflag = 'A' and l_suppkey % 3 = 0 then 'PROM-PUB'"
            " when l_returnflag = 'N' then 'AN1-DEPOT' else 'SN1-DEPOT' end",
            "acte_libelle_canonique": "case when l_linenumber % 2 = 0 then 'Depot' end",
            "organe_ref": "'PG' || cast(l_suppkey % 25 as string)",
            "date_acte": "l_shipdate",
            "type_acte": "'Etape_Type'",
            "texte_associe": "case when l_orderkey % 4 = 0 then 'DOC' || cast(l_partkey as string) end",
            "vote_ref": "case when l_linenumber = 1 then 'VT' || cast(l_partkey as string) end",
        },
        "from {lineitem}",
    ),
    "amendements": (
        {
            "uid": "'AM' || cast(o_orderkey as string)",
            "legislature": _text("15 + o_orderkey % 3"),
            "numero_long": _text("o_orderkey"),
            "numero_ordre_depot": _text("o_orderkey % 100"),
            "prefixe_organe_examen": "'AN'",
            "examen_ref": "'EX' || cast(o_custkey as string)",
            "dispositif": "o_orderpriority",
            "date_depot": "cast(o_orderdate as date)",
            "date_publication": "case when o_orderkey % 5 <> 0 then cast(o_orderdate as date) + 2 end",
            "etat_code": "o_orderstatus",
            "sort": "case when o_orderkey % 10 = 0 then lower(outcome) else outcome end",
            "auteur_type": "case when o_orderkey % 8 <> 0 then 'Depute' end",
            "auteur_acteur_ref": "case when o_orderkey % 8 <> 0 then"
            " 'PA' || cast(o_custkey as string) end",
            "auteur_groupe_politique_ref": "case when o_orderkey % 8 <> 0 then"
            " 'PG' || cast(o_custkey % 25 as string) end",
            "dossier_legislatif_ref": "'DL' || cast(o_custkey % 150 as string)",
        },
        "from (select *, case o_orderstatus when 'F' then 'Adopté' when 'O' then 'Rejeté'"
        " else 'Tombé' end as outcome from {orders}) a",
    ),
    "amendement_signataires": (
        {
            "amendement_uid": "'AM' || cast(o_orderkey as string)",
            "acteur_ref": "'PA' || cast(o_custkey as string)",
            "type_auteur": "'Depute'",
            "groupe_politique_ref": "'PG' || cast(o_custkey % 25 as string)",
            "ordre_presentation": "cast(0 as bigint)",
        },
        "from {orders} where o_orderkey % 8 <> 0",
    ),
    "amendement_cosignataires": (
        {
            "amendement_uid": "'AM' || cast(o_orderkey as string)",
            "cosignataire_acteur_ref": "'PA' || cast(o_custkey + n as string)",
            "ordre_presentation": "cast(n as bigint)",
        },
        "from (select *, 1 as n from {orders} union all"
        " select *, 3 as n from {orders} where o_orderkey % 2 = 0) s",
    ),
    "questions_ecrites": (
        {
            "uid": f"'QE' || {_TURN}",
            "numero": _text("conv_id"),
            "regime": "'5eme Republique'",
            "legislature": _text("15 + conv_id % 3"),
            "type": "'QE'",
            "rubrique": "role",
            "auteur_acteur_ref": "'PA' || cast(conv_id as string)",
            "auteur_groupe_abrege": "case when turn % 2 = 0 then 'G' || cast(conv_id % 9 as string) end",
            "min_int_abrege": "'Min ' || cast(turn as string)",
            "texte_question": "text",
            "date_jo_question": _day("2010-01-01", "conv_id % 900 + turn"),
            "page_jo_question": _text("turn + 1"),
            "texte_reponse": "case when turn % 3 <> 0 then upper(role) end",
            "date_jo_reponse": "case when turn % 3 <> 0 then "
            + _day("2010-03-01", "conv_id % 900")
            + " end",
        },
        "from {conversations}",
    ),
    "questions_ecrites_min_attribs": (
        {
            "question_uid": f"'QE' || {_TURN}",
            "type_jo": "'JO_QUESTION'",
            "date_jo": _day("2010-01-01", "conv_id % 900 + n"),
            "organe_ref": "'PO' || cast(n as string)",
            "abrege": "role",
            "developpe": "case when n = 1 then 'Ministere' end",
        },
        "from (select *, 1 as n from {conversations} union all"
        " select *, 2 as n from {conversations} where turn % 2 = 0) q",
    ),
    "questions_ecrites_renouvellements": (
        {
            "question_uid": f"'QE' || {_TURN}",
            "type_jo": "'JO_QUESTION'",
            "date_jo": "case when n = 1 then " + _day("2011-01-01", "conv_id % 900") + " end",
            "num_jo": _text("n + turn"),
        },
        "from (select *, 1 as n from {conversations} where turn % 4 <> 1 union all"
        " select *, 2 as n from {conversations} where turn % 4 = 2) q",
    ),
}

_SQL_TYPES = {
    T.StringType(): "string",
    T.LongType(): "bigint",
    T.BooleanType(): "boolean",
    T.DateType(): "date",
    T.TimestampType(): "timestamp",
}

BENCH_TABLES = (
    *("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"),
    *("documents", "embeddings", "pages", "benchmark", "labels", "conversations"),
)


def select(table: str) -> str:
    """The SELECT of a raw table, with ``{name}`` for each benchmark table."""
    columns, source = _TABLES[table]
    picked = [
        f"cast({columns.get(f.name, 'null')} as {_SQL_TYPES[f.dataType]}) as {f.name}"
        for f in SCHEMAS[table]
    ]
    return f"select {', '.join(picked)} {source}"


def duckdb_select(table: str) -> str:
    return select(table).format(**{name: name for name in BENCH_TABLES})


def bench_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    sql = select(table)
    used = [name for name in BENCH_TABLES if "{" + name + "}" in sql]
    return spark.sql(sql, **{name: bench_table(spark, sf_dir, name) for name in used})


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {table: raw_table(spark, sf_dir, table) for table in RAW_TABLES}


class _Lazy(dict):
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__()
        self._source = (spark, sf_dir)

    def __missing__(self, table: str) -> DataFrame:
        self[table] = raw_table(*self._source, table)
        return self[table]


def models(spark: SparkSession, sf_dir: str) -> Models:
    return Models(_Lazy(spark, sf_dir))
