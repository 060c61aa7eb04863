"""Ingest jobs on hand-written documents: the usual shape and the odd ones."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest

from rostrum.ingest import INGEST, feed
from rostrum.schemas import FEEDS, SCHEMAS

NOW = datetime(2024, 7, 15, 12)


def documents(spark, *pairs):
    rows = [(entry, body if isinstance(body, str) else json.dumps(body)) for entry, body in pairs]
    return spark.createDataFrame(rows, "entry string, body string")


def run(spark, table, *pairs):
    job = INGEST[table]
    docs = documents(spark, *pairs)
    df = job(docs, NOW) if table in FEEDS["deputies"] else job(docs)
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in SCHEMAS[table]
    ]
    return [row.asDict() for row in df.collect()]


def values(rows, *names):
    return [tuple(row[n] for n in names) for row in rows]


PERSON = {
    "uid": {"@xsi:type": "IdActeur_type", "#text": "PA10"},
    "etatCivil": {
        "ident": {"civ": "Mme", "prenom": " Ana ", "nom": "Lo", "alpha": "Lo", "trigramme": "ALO"},
        "infoNaissance": {"dateNais": "1975-03-09", "villeNais": "Lyon"},
    },
    "profession": None,
    "adresses": {"adresse": {"uid": "AD1", "typeLibelle": "Mail", "valElec": "a@example.org"}},
    "mandats": {
        "mandat": {
            "uid": "PM1",
            "@xsi:type": "MandatParlementaire_type",
            "typeOrgane": "ASSEMBLEE",
            "organes": {"organeRef": "PO1"},
            "dateDebut": "2024-07-01",
            "dateFin": None,
            "preseance": "20",
            "nominPrincipale": "1",
            "infosQualite": {"libQualite": "membre"},
            "election": {"lieu": {"numDepartement": "69", "numCirco": "2"}, "causeMandat": "vote"},
            "mandature": {"premiereElection": "0", "placeHemicycle": "311"},
        }
    },
}


def person(**changes):
    return {"acteur": {**PERSON, **changes}}


def test_person(spark):
    row = run(spark, "acteurs", ("json/acteur/PA10.json", person()))[0]
    assert row["uid"] == "PA10" and row["prenom"] == "Ana"
    assert row["date_naissance"] == date(1975, 3, 9)
    assert row["profession_libelle"] is None and row["pays_naissance"] is None
    assert row["ingested_at"] == NOW


def test_other_folders_and_suffixes_are_not_read(spark):
    good = person()
    kept = run(
        spark,
        "acteurs",
        ("json/acteur/a.json", good),
        ("json/organe/a.json", "not json"),
        ("json/acteur/a.xml", "not json"),
    )
    assert len(kept) == 1


@pytest.mark.parametrize(
    "body",
    ["{", "", '{"acteur": {"uid": "PA1"}} x', {"other": 1}, {"acteur": {}}, {"acteur": ["PA1"]}],
)
def test_deputies_fail_on_documents_they_cannot_read(spark, body):
    with pytest.raises(Exception, match="in json/acteur/a.json"):
        run(spark, "acteurs", ("json/acteur/a.json", body))


def test_addresses_single_or_list(spark):
    one = run(spark, "adresses", ("json/acteur/a.json", person()))
    assert values(one, "uid", "acteur_uid", "val_elec") == [("AD1", "PA10", "a@example.org")]
    two = person(adresses={"adresse": [{"uid": "AD1"}, {"uid": "AD2"}]})
    assert len(run(spark, "adresses", ("json/acteur/a.json", two))) == 2
    for none in (None, {}, {"adresse": None}, {"adresse": []}):
        assert run(spark, "adresses", ("json/acteur/a.json", person(adresses=none))) == []


def test_mandate(spark):
    row = run(spark, "mandats", ("json/acteur/a.json", person()))[0]
    assert row["acteur_ref"] == "PA10" and row["organe_ref"] == "PO1"
    assert row["preseance"] == 20 and row["nomin_principale"] is True
    assert row["election_num_circo"] == "2" and row["election_cause_mandat"] == "vote"
    assert row["mandature_premiere_election"] is False
    assert row["mandature_place_hemicycle"] == 311
    assert row["date_debut"] == date(2024, 7, 1) and row["date_fin"] is None


def test_mandates_without_one_or_with_several_bodies(spark):
    def mandate(uid, organes):
        return {"uid": uid, "@xsi:type": "MandatSimple_Type", "organes": organes, "election": {"causeMandat": "x"}}

    many = person(
        mandats={
            "mandat": [
                mandate("PM1", {"organeRef": ["PO1", "PO2", "PO3"]}),
                mandate("PM2", None),
                mandate("PM3", {"organeRef": []}),
                mandate("PM4", {}),
            ]
        }
    )
    rows = run(spark, "mandats", ("json/acteur/a.json", many))
    assert sorted(values(rows, "uid", "organe_ref"), key=str) == [
        *[("PM1", f"PO{i}") for i in (1, 2, 3)], ("PM2", None), ("PM3", None), ("PM4", None)
    ]
    assert {r["election_cause_mandat"] for r in rows} == {None}
    for odd in ({"organeRef": {"uid": "PO1"}}, {"organeRef": 5}, {"organeRef": None}):
        with pytest.raises(Exception, match="organeRef must be text or a list"):
            bad = person(mandats={"mandat": mandate("PM1", odd)})
            run(spark, "mandats", ("json/acteur/a.json", bad))


def test_body_and_recusal(spark):
    body = {
        "organe": {
            "uid": "PO1",
            "@xsi:type": "GroupePolitique_type",
            "codeType": "GP",
            "viMoDe": {"dateDebut": "2024-07-19", "dateFin": None},
            "lieu": {"departement": {"code": "69", "libelle": "Rhone"}, "region": None},
            "couleurAssociee": "#123456",
            "preseance": "x",
        }
    }
    row = run(spark, "organes", ("json/organe/PO1.json", body))[0]
    assert (row["code_type"], row["circo_dep_code"], row["gp_preseance"]) == ("GP", "69", None)
    assert row["date_debut"] == date(2024, 7, 19)
    recusal = {
        "deport": {
            "uid": "D1",
            "refActeur": "PA1",
            "dateCreation": "2024-07-10T12:00:00+02:00",
            "cible": {"type": {"code": "TEXT"}, "referenceTextuelle": "loi"},
        }
    }
    row = run(spark, "deports", ("json/deport/D1.json", recusal))[0]
    assert row["date_creation"] == datetime(2024, 7, 10, 10)
    assert (row["cible_type_code"], row["portee_code"]) == ("TEXT", None)


def ballot(**nodes):
    return {"scrutin": {"uid": "VT1", **nodes}}


def votes_of(**containers):
    group = {"organeRef": "PO9", "vote": {"decompteNominatif": containers}}
    return {"organe": {"organeRef": "PO0", "groupes": {"groupe": group}}}


def test_ballot(spark):
    full = ballot(
        dateScrutin="2024-10-08",
        sort={"code": "rejeté"},
        syntheseVote={"nombreVotants": "573", "decompte": {"pour": "197", "contre": "?"}},
        demandeur=None,
    )
    row = run(spark, "scrutins", ("json/VT1.json", full))[0]
    assert (row["synthese_nombre_votants"], row["synthese_pour"]) == (573, 197)
    assert row["synthese_contre"] is None and row["sort_code"] == "rejeté"


def test_ballots_without_key_are_left_out_but_bad_json_fails(spark):
    skipped = [{"scrutin": {"uid": " "}}, {"scrutin": None}, {"scrutin": ["x"]}, {}, "null"]
    pairs = [(f"json/{i}.json", body) for i, body in enumerate(skipped)]
    assert run(spark, "scrutins", *pairs) == []
    with pytest.raises(Exception, match="bad JSON in json/x.json"):
        run(spark, "scrutins", ("json/x.json", '{"scrutin": {"uid": "VT1"'))


def test_group_votes_keep_objects_only(spark):
    groups = ["x", {"organeRef": "PO1", "vote": {"decompteVoix": {"pour": "3"}}}, None, {}]
    body = ballot(ventilationVotes={"organe": {"organeRef": "PO0", "groupes": {"groupe": groups}}})
    rows = run(spark, "scrutin_groupes_votes", ("json/a.json", body))
    assert sorted(values(rows, "groupe_organe_ref", "pour"), key=str) == [("PO1", 3), (None, None)]
    assert {r["organe_ref_assemblee"] for r in rows} == {"PO0"}


@pytest.mark.parametrize(
    "container, expected",
    [
        ({"votant": {"acteurRef": "PA1"}}, ["PA1"]),
        ({"votant": [{"acteurRef": "PA1"}, None, "x", {"acteurRef": "PA2"}]}, ["PA1", "PA2"]),
        ([{"acteurRef": "PA1"}, "x"], ["PA1"]),
        ({"acteurRef": "PA1"}, ["PA1"]),
        ({"votant": {}}, [""]),
        ({"votant": None}, []),
        ({"votant": "x"}, []),
        ({}, []),
        ([], []),
        ("x", []),
        (None, []),
    ],
)
def test_voter_containers(spark, container, expected):
    body = ballot(ventilationVotes=votes_of(pours=container))
    rows = run(spark, "scrutin_votes_individuels", ("json/a.json", body))
    assert sorted(r["acteur_ref"] for r in rows) == expected


@pytest.mark.parametrize(
    "container, expected",
    [
        ({"votant": None, "acteurRef": "PA1"}, []),
        ({"other": {"votant": 1}}, [""]),
        ({"other": {"votant": 1}, "acteurRef": "PA1"}, ["PA1"]),
        ([{"votant": {"acteurRef": "PA2"}, "acteurRef": "PA1"}, {"votant": "x"}], ["PA1", ""]),
        ({"votant": [], "acteurRef": "PA1"}, []),
        ("PA1", []),
    ],
)
def test_rare_voter_containers(spark, container, expected):
    ballot = {"scrutin": {"uid": "VT1", "miseAuPoint": {"pours": container, "contres": {}}}}
    rows = run(spark, "scrutin_votes_individuels", ("json/a.json", ballot))
    assert [row["acteur_ref"] for row in rows] == expected


def test_checks_of_documents_are_not_repeated_in_filters(spark):
    """As filters they were written out again for every condition put on the parsed node."""
    docs = documents(spark, ("json/a.json", {"scrutin": {"uid": "VT1"}}))
    plan = INGEST["scrutin_votes_individuels"](docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bad JSON") == 1


def test_positions_and_corrections(spark):
    def voter(n, **more):
        return {"votant": {"acteurRef": f"PA{n}", **more}}

    breakdown = votes_of(
        pours=voter(1, parDelegation="true"),
        contres=voter(2, parDelegation="0"),
        abstentions=voter(3, parDelegation="?"),
        nonVotants=voter(4),
        nonVotantsVolontaires=voter(5),
    )
    body = ballot(ventilationVotes=breakdown, miseAuPoint={"contres": voter(6)})
    rows = run(spark, "scrutin_votes_individuels", ("json/a.json", body))
    names = ("acteur_ref", "position_vote", "groupe_organe_ref", "par_delegation", "source")
    assert sorted(values(rows, *names)) == [
        ("PA1", "pour", "PO9", True, "ventilation"),
        ("PA2", "contre", "PO9", False, "ventilation"),
        ("PA3", "abstention", "PO9", None, "ventilation"),
        ("PA4", "non_votant", "PO9", None, "ventilation"),
        ("PA6", "contre", None, None, "mise_au_point"),
    ]
    alone = run(
        spark,
        "scrutin_votes_individuels",
        ("json/a.json", ballot(miseAuPoint={"pours": voter(1)})),
    )
    assert values(alone, "acteur_ref", "source") == [("PA1", "mise_au_point")]


def test_document(spark):
    body = {
        "document": {
            "uid": "DOC1",
            "classification": {"type": {"code": "RAPP"}, "famille": None},
            "titres": None,
            "cycleDeVie": {"chrono": {"dateDepot": "2024-09-11T00:00:00.000+02:00"}},
            "notice": {"adoptionConforme": "True"},
            "auteurs": {"auteur": {"acteur": {"acteurRef": "PA1", "qualite": "auteur"}}},
            "imprimerie": {"nbPage": "12", "DIAN": "4/2024"},
        }
    }
    row = run(spark, "documents", ("json/document/DOC1.json", body))[0]
    assert row["date_depot"] == datetime(2024, 9, 10, 22)
    assert (row["adoption_conforme"], row["nb_page"], row["auteur_ref"]) == (True, 12, "PA1")
    assert row["titre_principal"] is None and row["famille_depot_code"] is None
    body["document"]["auteurs"]["auteur"] = [{"acteur": {"acteurRef": "PA1"}}] * 2
    body["document"]["notice"]["adoptionConforme"] = ""
    row = run(spark, "documents", ("json/document/DOC1.json", body))[0]
    assert (row["auteur_ref"], row["adoption_conforme"]) == (None, False)


def dossier(acts, **nodes):
    node = {"uid": "DL1", "actesLegislatifs": {"acteLegislatif": acts}, **nodes}
    return ("json/dossierParlementaire/DL1.json", {"dossierParlementaire": node})


@pytest.mark.parametrize(
    "acts, count",
    [(None, 0), ([], 0), ({}, 0), ({"uid": "A"}, 1), ([{"uid": "A"}, "x", None], 3), ("x", 1)],
)
def test_top_level_acts_are_counted(spark, acts, count):
    row = run(spark, "dossiers_parlementaires", dossier(acts))[0]
    assert row["nombre_actes_legislatifs"] == count


def test_initiators(spark):
    initiator = {
        "acteurs": {"acteur": {"acteurRef": "PA1", "mandatRef": "PM1"}},
        "organes": {"organe": {"organeRef": {"uid": "PO1"}}},
    }
    names = ("initiateur_acteur_ref", "initiateur_mandat_ref", "initiateur_organe_ref")
    rows = run(spark, "dossiers_parlementaires", dossier(None, initiateur=initiator))
    assert values(rows, *names) == [("PA1", "PM1", "PO1")]
    initiator["organes"]["organe"]["organeRef"] = "PO2"
    initiator["acteurs"]["acteur"] = [{"acteurRef": "PA1"}]
    rows = run(spark, "dossiers_parlementaires", dossier(None, initiateur=initiator))
    assert values(rows, *names) == [(None, None, "PO2")]


def flattened(acts, parent=None):
    """Brute force: the key and code of every act below ``acts``."""
    found = []
    for act in acts if isinstance(acts, list) else [acts] if acts else []:
        uid = isinstance(act, dict) and (act.get("uid") or parent)
        if uid:
            found.append((uid, act.get("codeActe")))
            below = (act.get("actesLegislatifs") or {}).get("acteLegislatif")
            found += flattened(below, uid)
    return found


def nested(depth, **act):
    if depth == 0:
        return {"codeActe": "leaf", **act}
    child = nested(depth - 1, **({"uid": f"A{depth}"} if depth % 3 else {}))
    return {"codeActe": f"d{depth}", **act, "actesLegislatifs": {"acteLegislatif": child}}


@pytest.mark.parametrize(
    "acts",
    [
        None,
        {},
        {"uid": "A"},
        [{"uid": "A"}, "x", None, {"codeActe": "no key"}, {"uid": "B", "codeActe": "c"}],
        nested(12, uid="TOP"),
        [nested(3, uid="T"), nested(5), nested(1, uid="U")],
        {"uid": "A", "actesLegislatifs": {"acteLegislatif": [{}, {"uid": "B"}, ["x"], "y"]}},
        {"uid": "A", "actesLegislatifs": {"acteLegislatif": {}}},
        {"uid": "A", "actesLegislatifs": None},
        {"uid": "A", "texteAssocie": 'has "acteLegislatif" in it'},
        [
            {"uid": f"A{i}", "actesLegislatifs": {"acteLegislatif": [{"uid": f"B{i}{j}"} for j in range(9)]}}
            for i in range(9)
        ],
    ],
)
def test_acts_of_any_depth(spark, acts):
    rows = run(spark, "dossier_actes_legislatifs", dossier(acts))
    assert sorted(values(rows, "acte_uid", "acte_code"), key=str) == sorted(
        flattened(acts), key=str
    )
    assert {r["dossier_uid"] for r in rows} <= {"DL1"}


def test_act_columns(spark):
    act = {
        "uid": "A",
        "@xsi:type": "Etape_Type",
        "dateActe": "2024-10-01T00:00:00Z",
        "libelleActe": {"nomCanonique": "Lecture"},
        "voteRefs": {"voteRef": ["VT1", "VT2"]},
    }
    row = run(spark, "dossier_actes_legislatifs", dossier(act))[0]
    assert (row["type_acte"], row["acte_libelle_canonique"]) == ("Etape_Type", "Lecture")
    assert row["date_acte"] == datetime(2024, 10, 1)
    assert row["vote_ref"] == '["VT1","VT2"]'


def amendment(**nodes):
    return {"amendement": {"uid": "AM1", **nodes}}


def test_amendment(spark):
    body = amendment(
        identification={"numeroLong": "12"},
        pointeurFragmentTexte="not an object",
        corps={"contenuAuteur": {"dispositif": " Supprimer "}},
        cycleDeVie={"dateDepot": "2024-10-02", "etatDesTraitements": {"etat": ["x"]}, "sort": "adopté"},
        signataires={"auteur": {"typeAuteur": "Député", "acteurRef": "PA1"}},
    )
    path = "json/DL5/TEXTE/AM1.json"
    row = run(spark, "amendements", (path, body))[0]
    assert row["dossier_legislatif_ref"] == "DL5" and row["dispositif"] == "Supprimer"
    assert row["etat_code"] is None and row["division_titre"] is None
    assert row["auteur_acteur_ref"] == "PA1" and row["date_depot"] == date(2024, 10, 2)
    author = run(spark, "amendement_signataires", (path, body))
    assert values(author, "amendement_uid", "acteur_ref", "ordre_presentation") == [("AM1", "PA1", 0)]


def test_amendments_skip_what_they_cannot_read(spark):
    bad = ['{"amendement": {"uid": "AM1"', "", "null", {"amendement": []}, {"amendement": {"uid": ""}}]
    pairs = [(f"json/DL1/{i}.json", body) for i, body in enumerate(bad)]
    good = ("json/DL1/good.json", amendment())
    assert values(run(spark, "amendements", *pairs, good), "uid") == [("AM1",)]
    assert run(spark, "amendement_signataires", *pairs, good) == []


@pytest.mark.parametrize(
    "refs, expected",
    [
        (["PA2", None, "PA3"], [(1, "PA2"), (3, "PA3")]),
        ([" ", "PA3"], [(2, "PA3")]),
        ("PA2", [(1, "PA2")]),
        (None, []),
        ([], []),
    ],
)
def test_cosigners_keep_their_number(spark, refs, expected):
    body = amendment(signataires={"cosignataires": {"acteurRef": refs}})
    rows = run(spark, "amendement_cosignataires", ("json/DL1/a.json", body))
    assert sorted(values(rows, "ordre_presentation", "cosignataire_acteur_ref")) == expected


def test_question_nodes_may_be_lists(spark):
    question = {
        "uid": "QE1",
        "type": "QE",
        "identifiant": ["x", {"numero": "7", "legislature": "17"}, {"numero": "8"}],
        "auteur": {"identite": {"acteurRef": "PA1"}, "groupe": [{"abrege": "G"}]},
        "indexationAN": {"rubrique": "eau", "analyses": {"analyse": ["a", "b"]}},
        "textesQuestion": [{"texteQuestion": {"texte": " t ", "infoJO": {"dateJO": "2024-10-08"}}}],
        "textesReponse": None,
        "minAttribs": {
            "minAttrib": [
                {"infoJO": {"typeJO": "J", "dateJO": "2024-10-08"}, "denomination": {"abrege": "M"}},
                "x",
            ]
        },
        "renouvellements": {"renouvellement": {"infoJO": [{"numJO": "3", "dateJO": "bad"}]}},
    }
    for body in ({"question": question}, {"question": ["x", question]}):
        pair = ("json/QE1.json", body)
        row = run(spark, "questions_ecrites", pair)[0]
        assert (row["numero"], row["legislature"], row["auteur_groupe_abrege"]) == ("7", "17", "G")
        assert (row["texte_question"], row["date_jo_question"]) == ("t", date(2024, 10, 8))
        assert row["analyse"] == '["a","b"]' and row["texte_reponse"] is None
        rows = run(spark, "questions_ecrites_min_attribs", pair)
        assert values(rows, "question_uid", "type_jo", "abrege") == [("QE1", "J", "M")]
        rows = run(spark, "questions_ecrites_renouvellements", pair)
        assert values(rows, "num_jo", "date_jo") == [("3", None)]
    assert run(spark, "questions_ecrites", ("json/a.json", {"question": {"uid": None}})) == []


def transcript(uid, content):
    return f"""<?xml version='1.0' encoding='UTF-8'?>
        <compteRendu xmlns="http://schemas.assemblee-nationale.fr/referentiel">
        <uid>{uid}</uid><seanceRef> S1 </seanceRef>
        <metadonnees><dateSeance>20241001150000000</dateSeance><etat/></metadonnees>
        {content}</compteRendu>"""


CONTENT = """<contenu>
    <quantiemes><journee>x</journee></quantiemes>
    <ouvertureSeance id_syceron="1"><paragraphe id_syceron="2"/></ouvertureSeance>
    <point id_syceron="3" valeur_ptsodj="4"><texte>Titre <b> gras </b></texte>
      <paragraphe id_syceron="5" code_parole="">
        <orateurs><orateur><nom>A</nom><id>7</id><qualite> </qualite></orateur>
                  <orateur><nom>B</nom></orateur></orateurs>
        <texte>Un<br/>deux <i> (trois <b> quatre </b> ) </i> cinq<br/></texte>
      </paragraphe>
    </point>
    <annexe id_syceron="9"/></contenu>"""


def test_transcript(spark):
    pair = ("a.xml", transcript("CR1", CONTENT))
    header = run(spark, "comptes_rendus", pair)[0]
    assert (header["uid"], header["seance_ref"], header["etat"]) == ("CR1", "S1", None)
    assert header["date_seance"] == "20241001150000000"
    points = run(spark, "points_seance", pair)
    assert values(points, "compte_rendu_uid", "point_id", "point_type", "titre") == [
        ("CR1", "1", "ouvertureSeance", ""),
        ("CR1", "3", "point", "Titre gras"),
    ]
    speeches = run(spark, "interventions", pair)
    names = ("point_id", "intervention_id", "orateur_nom", "orateur_id", "orateur_qualite", "texte")
    assert values(speeches, *names) == [
        ("1", "2", None, None, None, ""),
        ("3", "5", "A", "7", None, "Un\ndeux (trois quatre ) cinq"),
    ]
    assert speeches[1]["code_parole"] == "" and speeches[1]["point_valeur_ptsodj"] == "4"


def test_transcripts_without_key_or_content_are_kept(spark):
    pairs = [("a.xml", transcript("", "")), ("b", transcript("CR2", "<contenu/>"))]
    assert sorted(values(run(spark, "comptes_rendus", *pairs), "uid"), key=str) == [("CR2",), (None,)]
    assert run(spark, "points_seance", *pairs) == []
    with pytest.raises(Exception, match="ParseError"):
        run(spark, "comptes_rendus", ("a.xml", "<a>"))


def test_a_feed_parses_each_kind_once(spark):
    kept = []

    def keep(kind, parsed):
        kept.append(kind)
        return parsed

    docs = documents(spark, ("json/acteur/a.json", person()))
    tables = feed("deputies").tables(docs, NOW, keep)
    assert tuple(tables) == FEEDS["deputies"]
    assert sorted(kept) == ["parse_bodies", "parse_persons", "parse_recusals"]
    assert {name: table.count() for name, table in tables.items()} == {
        "acteurs": 1, "adresses": 1, "mandats": 1, "organes": 0, "deports": 0
    }
    with pytest.raises(KeyError):
        feed("weather")
