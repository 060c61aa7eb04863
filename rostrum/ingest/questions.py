"""Written questions feed. Any of its nodes may be a list, whose first object then counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.functions.coerce import to_date, to_str
from rostrum.functions.nodes import bind, fields, first_object, objects
from rostrum.ingest.parsing import parse_documents
from rostrum.schemas import shape

_QUESTION = fields(
    *("uid", "type", "identifiant", "indexationAN", "auteur", "minInt", "textesQuestion"),
    *("textesReponse", "minAttribs", "renouvellements"),
)


def parse_questions(documents: DataFrame) -> DataFrame:
    """``(uid, doc)``, questions without a key left out."""
    parsed = parse_documents(documents, "json/", "question", T.StringType())
    first = F.explode(F.array(first_object(F.col("doc"), _QUESTION))).alias("doc")
    return (
        parsed.select(first)
        .select(to_str(F.col("doc.uid")).alias("uid"), "doc")
        .where(F.col("uid").isNotNull())
    )


def _first(node: Column, *names: str) -> Column:
    return first_object(node, fields(*names))


def _text_of(node: Column, inner: str) -> Column:
    wrapped = _first(_first(node, inner)[inner], "texte", "infoJO")
    return bind(
        wrapped,
        lambda w: F.struct(
            w.texte.alias("texte"), _first(w.infoJO, "dateJO", "pageJO").alias("jo")
        ),
    )


def _author(node: Column) -> Column:
    return bind(
        _first(node, "identite", "groupe"),
        lambda a: F.struct(
            _first(a.identite, "acteurRef", "mandatRef").alias("person"),
            _first(a.groupe, "organeRef", "abrege", "developpe").alias("group"),
        ),
    )


def _index(node: Column) -> Column:
    return bind(
        _first(node, "rubrique", "teteAnalyse", "analyses"),
        lambda x: F.struct(
            x.rubrique.alias("rubrique"),
            x.teteAnalyse.alias("teteAnalyse"),
            _first(x.analyses, "analyse").analyse.alias("analyse"),
        ),
    )


def questions_ecrites(questions: DataFrame) -> DataFrame:
    q = F.col("doc")
    nodes = F.struct(
        q.type.alias("type"),
        _first(q.identifiant, "numero", "regime", "legislature").alias("id"),
        _index(q.indexationAN).alias("index"),
        _author(q.auteur).alias("author"),
        _first(q.minInt, "organeRef", "abrege", "developpe").alias("ministry"),
        _text_of(q.textesQuestion, "texteQuestion").alias("question"),
        _text_of(q.textesReponse, "texteReponse").alias("answer"),
    )
    # Opened once here; read column by column below.
    rows = questions.select("uid", F.explode(F.array(nodes)).alias("n"))
    n = F.col("n")
    return shape(
        rows,
        "questions_ecrites",
        numero=to_str(n.id.numero),
        regime=to_str(n.id.regime),
        legislature=to_str(n.id.legislature),
        type=to_str(n.type),
        rubrique=to_str(n.index.rubrique),
        tete_analyse=to_str(n.index.teteAnalyse),
        analyse=to_str(n.index.analyse),
        auteur_acteur_ref=to_str(n.author.person.acteurRef),
        auteur_mandat_ref=to_str(n.author.person.mandatRef),
        auteur_groupe_organe_ref=to_str(n.author.group.organeRef),
        auteur_groupe_abrege=to_str(n.author.group.abrege),
        auteur_groupe_developpe=to_str(n.author.group.developpe),
        min_int_organe_ref=to_str(n.ministry.organeRef),
        min_int_abrege=to_str(n.ministry.abrege),
        min_int_developpe=to_str(n.ministry.developpe),
        texte_question=to_str(n.question.texte),
        date_jo_question=to_date(n.question.jo.dateJO),
        page_jo_question=to_str(n.question.jo.pageJO),
        texte_reponse=to_str(n.answer.texte),
        date_jo_reponse=to_date(n.answer.jo.dateJO),
        page_jo_reponse=to_str(n.answer.jo.pageJO),
    )


def _each(questions: DataFrame, outer: str, inner: str, *names: str) -> DataFrame:
    """One row per object under ``outer``/``inner``."""
    members = objects(_first(F.col("doc")[outer], inner)[inner], fields(*names))
    return questions.select(F.col("uid").alias("question_uid"), F.explode(members).alias("m"))


def questions_ecrites_min_attribs(questions: DataFrame) -> DataFrame:
    rows = _each(questions, "minAttribs", "minAttrib", "infoJO", "denomination")
    journal = _first(F.col("m.infoJO"), "typeJO", "dateJO")
    ministry = _first(F.col("m.denomination"), "organeRef", "abrege", "developpe")
    opened = rows.select(
        "question_uid",
        F.explode(F.array(F.struct(journal.alias("jo"), ministry.alias("d")))).alias("n"),
    )
    n = F.col("n")
    return shape(
        opened,
        "questions_ecrites_min_attribs",
        type_jo=to_str(n.jo.typeJO),
        date_jo=to_date(n.jo.dateJO),
        organe_ref=to_str(n.d.organeRef),
        abrege=to_str(n.d.abrege),
        developpe=to_str(n.d.developpe),
    )


def questions_ecrites_renouvellements(questions: DataFrame) -> DataFrame:
    rows = _each(questions, "renouvellements", "renouvellement", "infoJO")
    journal = _first(F.col("m.infoJO"), "typeJO", "dateJO", "numJO")
    opened = rows.select("question_uid", F.explode(F.array(journal)).alias("jo"))
    jo = F.col("jo")
    return shape(
        opened,
        "questions_ecrites_renouvellements",
        type_jo=to_str(jo.typeJO),
        date_jo=to_date(jo.dateJO),
        num_jo=to_str(jo.numJO),
    )
