"""Debates feed: sittings, their sections and the speeches in them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.schemas import shape


def comptes_rendus(transcripts: DataFrame) -> DataFrame:
    return shape(transcripts.select("header.*"), "comptes_rendus")


def _points(transcripts: DataFrame) -> DataFrame:
    return transcripts.select(
        F.col("header.uid").alias("compte_rendu_uid"), F.explode("points").alias("p")
    )


def points_seance(transcripts: DataFrame) -> DataFrame:
    return shape(_points(transcripts).select("compte_rendu_uid", "p.*"), "points_seance")


def interventions(transcripts: DataFrame) -> DataFrame:
    return shape(
        _points(transcripts).select(
            "compte_rendu_uid",
            F.col("p.point_id").alias("point_id"),
            F.col("p.valeur_ptsodj").alias("point_valeur_ptsodj"),
            F.inline("p.speeches"),
        ),
        "interventions",
    )
