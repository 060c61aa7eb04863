"""Debate transcripts: XML documents with mixed text.

Spark's XML source has no way to keep ``<br/>`` and nested markup apart from
text, so a small parser runs on Arrow batches. It reads each document once and
leaves one nested row; the three tables are taken from that by Spark.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from rostrum.functions.nodes import fields

# The vocabulary of the transcripts.
_NS = "{http://schemas.assemblee-nationale.fr/referentiel}"
_SECTIONS = {"point", "ouvertureSeance", "clotureSeance", "suspensionSeance", "repriseSeance"}
_HEADER = {
    "uid": "uid",
    "seance_ref": "seanceRef",
    "session_ref": "sessionRef",
    "date_seance": "metadonnees/dateSeance",
    "date_seance_jour": "metadonnees/dateSeanceJour",
    "num_seance_jour": "metadonnees/numSeanceJour",
    "num_seance": "metadonnees/numSeance",
    "type_assemblee": "metadonnees/typeAssemblee",
    "legislature": "metadonnees/legislature",
    "session": "metadonnees/session",
    "etat": "metadonnees/etat",
    "diffusion": "metadonnees/diffusion",
    "version": "metadonnees/version",
}
_POINT = {
    "point_id": "id_syceron",
    "valeur_ptsodj": "valeur_ptsodj",
    "nivpoint": "nivpoint",
    "ordinal_prise": "ordinal_prise",
    "ordre_absolu_seance": "ordre_absolu_seance",
    "code_grammaire": "code_grammaire",
    "code_style": "code_style",
    "sommaire": "sommaire",
}
_SPEECH = {
    "intervention_id": "id_syceron",
    "ordre_absolu_seance": "ordre_absolu_seance",
    "ordinal_prise": "ordinal_prise",
    "code_grammaire": "code_grammaire",
    "code_style": "code_style",
    "code_parole": "code_parole",
    "roledebat": "roledebat",
}
_SPEAKER = {"orateur_nom": "nom", "orateur_id": "id", "orateur_qualite": "qualite"}

PARSED = T.StructType(
    [
        T.StructField("header", fields(*_HEADER)),
        T.StructField(
            "points",
            T.ArrayType(
                fields(
                    *_POINT,
                    "point_type",
                    "titre",
                    ("speeches", T.ArrayType(fields(*_SPEECH, *_SPEAKER, "texte"))),
                )
            ),
        ),
    ]
)
_DOCUMENTS_PER_BATCH = 32


def _path(steps: str) -> str:
    return "/".join(_NS + step for step in steps.split("/"))


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def node_text(root: ET.Element | None) -> str:
    """Text of mixed content: ``br`` is a line break, every element's text is stripped.

    Elements are visited in reverse document order, so children come first.
    """
    if root is None:
        return ""
    ready: dict[ET.Element, str] = {}
    for node in reversed(list(root.iter())):
        inner = "".join(ready.pop(child) + (child.tail or "") for child in node)
        broken = node is not root and _local(node.tag) == "br"
        ready[node] = "\n" if broken else ((node.text or "") + inner).strip()
    return ready[root]


def _leaf(node: ET.Element | None, steps: str) -> str | None:
    found = None if node is None else node.findtext(_path(steps))
    return (found or "").strip() or None


def _speech(paragraph: ET.Element) -> dict:
    speaker = paragraph.find(_path("orateurs/orateur"))
    return {
        **{column: paragraph.get(name) for column, name in _SPEECH.items()},
        **{column: _leaf(speaker, name) for column, name in _SPEAKER.items()},
        "texte": node_text(paragraph.find(_path("texte"))),
    }


def _point(section: ET.Element) -> dict:
    return {
        **{column: section.get(name) for column, name in _POINT.items()},
        "point_type": _local(section.tag),
        "titre": node_text(section.find(_path("texte"))),
        "speeches": [_speech(p) for p in section.findall(_path("paragraphe"))],
    }


def _transcript(xml: str) -> dict:
    root = ET.fromstring(xml)
    content = root.find(_path("contenu"))
    return {
        "header": {column: _leaf(root, steps) for column, steps in _HEADER.items()},
        "points": [
            _point(section)
            for section in (() if content is None else content)
            if _local(section.tag) in _SECTIONS
        ],
    }


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = to_arrow_schema(PARSED)
    for batch in batches:
        for first in range(0, batch.num_rows, _DOCUMENTS_PER_BATCH):
            bodies = batch.slice(first, _DOCUMENTS_PER_BATCH)["body"]
            parsed = [_transcript(body.as_py()) for body in bodies]
            yield pa.RecordBatch.from_pylist(parsed, schema=schema)


def parse_transcripts(documents: DataFrame) -> DataFrame:
    """One row ``(header, points)`` per document; one that is not XML fails the job."""
    return documents.select("body").mapInArrow(_parse, PARSED)


def mixed_text(xml: Column) -> Column:
    """:func:`node_text` of a column of XML elements; NULL gives ``''``."""

    @F.pandas_udf(T.StringType())
    def read(fragments: pd.Series) -> pd.Series:
        return fragments.map(lambda x: "" if x is None else node_text(ET.fromstring(x)))

    return read(xml)
