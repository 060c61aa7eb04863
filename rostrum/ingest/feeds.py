"""The six feeds: how their documents are parsed and which tables come of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame

from rostrum.ingest import amendments, ballots, debates, deputies, files, questions
from rostrum.schemas import FEEDS
from rostrum.sources.transcripts import parse_transcripts

Parser = Callable[[DataFrame], DataFrame]

# table -> (parser of its documents, builder from the parsed documents)
_TABLES: dict[str, tuple[Parser, Callable[..., DataFrame]]] = {
    "acteurs": (deputies.parse_persons, deputies.acteurs),
    "adresses": (deputies.parse_persons, deputies.adresses),
    "mandats": (deputies.parse_persons, deputies.mandats),
    "organes": (deputies.parse_bodies, deputies.organes),
    "deports": (deputies.parse_recusals, deputies.deports),
    "comptes_rendus": (parse_transcripts, debates.comptes_rendus),
    "points_seance": (parse_transcripts, debates.points_seance),
    "interventions": (parse_transcripts, debates.interventions),
    "scrutins": (ballots.parse_ballots, ballots.scrutins),
    "scrutin_groupes_votes": (ballots.parse_ballots, ballots.scrutin_groupes_votes),
    "scrutin_votes_individuels": (ballots.parse_ballots, ballots.scrutin_votes_individuels),
    "documents": (files.parse_files_documents, files.documents),
    "dossiers_parlementaires": (files.parse_files, files.dossiers_parlementaires),
    "dossier_actes_legislatifs": (files.parse_files, files.dossier_actes_legislatifs),
    "amendements": (amendments.parse_amendments, amendments.amendements),
    "amendement_signataires": (amendments.parse_amendments, amendments.amendement_signataires),
    "amendement_cosignataires": (
        amendments.parse_amendments,
        amendments.amendement_cosignataires,
    ),
    "questions_ecrites": (questions.parse_questions, questions.questions_ecrites),
    "questions_ecrites_min_attribs": (
        questions.parse_questions,
        questions.questions_ecrites_min_attribs,
    ),
    "questions_ecrites_renouvellements": (
        questions.parse_questions,
        questions.questions_ecrites_renouvellements,
    ),
}
# Beginnings and ends of the names of a feed's documents in its archives.
ENTRIES: dict[str, tuple[tuple[str, str], ...]] = {
    "deputies": (("json/acteur/", ".json"), ("json/organe/", ".json"), ("json/deport/", ".json")),
    "debates": (("xml/", ".xml"),),
    "ballots": (("json/", ".json"),),
    "files": (("json/document/", ".json"), ("json/dossierParlementaire/", ".json")),
    "amendments": (("", ".json"),),
    "questions": (("json/", ".json"),),
}
_STAMPED = frozenset(FEEDS["deputies"])


def _ingest(table: str, documents: DataFrame, run_time: datetime | None = None) -> DataFrame:
    parse, build = _TABLES[table]
    return _build(table, build, parse(documents), run_time)


def _build(
    table: str, build: Callable[..., DataFrame], parsed: DataFrame, run_time: datetime | None
) -> DataFrame:
    if table in _STAMPED:
        if run_time is None:
            raise ValueError(f"{table} needs the time of the run")
        return build(parsed, run_time)
    return build(parsed)


# table -> job (documents[, run_time]) -> DataFrame
INGEST: dict[str, Callable[..., DataFrame]] = {t: partial(_ingest, t) for t in _TABLES}


@dataclass(frozen=True)
class Feed:
    """A feed's tables, with every kind of document parsed once for all of them."""

    name: str

    def tables(
        self,
        documents: DataFrame,
        run_time: datetime,
        keep: Callable[[str, DataFrame], DataFrame] = lambda name, parsed: parsed,
    ) -> dict[str, DataFrame]:
        """Table name to DataFrame.

        ``keep`` gets each kind of parsed documents once and returns what the
        tables are to be built from, for example after writing it out, so that
        no document is unpacked and parsed again for each table.
        """
        parsed: dict[Parser, DataFrame] = {}
        built = {}
        for table in FEEDS[self.name]:
            parse, build = _TABLES[table]
            if parse not in parsed:
                parsed[parse] = keep(parse.__name__, parse(documents))
            built[table] = _build(table, build, parsed[parse], run_time)
        return built


def feed(name: str) -> Feed:
    if name not in FEEDS:
        raise KeyError(f"no feed {name!r}; there are {sorted(FEEDS)}")
    return Feed(name)
