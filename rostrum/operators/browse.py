"""What a dashboard asks of the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Names of the stored tables of a database; views do not count."""
    return sorted(
        t.name
        for t in spark.catalog.listTables(database)
        if not t.isTemporary and t.tableType != "VIEW"
    )


def count_rows(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("row_count"))


def preview(table: DataFrame, limit: int = 20) -> DataFrame:
    return table.limit(limit)
